import pytest

from cellspark.llm.common import ship

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    ship(spark)
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows and ids, columns with clashing names."""
    passage = " ".join(f"word{i % 70}x{i}" for i in range(90))
    rows = [
        (1, passage, "en", "a", 5, "x"),
        (2, "Before it. " + passage + " After it.", "en", None, None, None),
        (3, None, None, "a", 1, "y"),
        (4, "", "de", "a", 1, "y"),
        (5, "  \t\n ", "de", "a", 1, "y"),
        (6, "One", None, "a", 1, "y"),
        (6, "One", None, "a", 1, "y"),
        (7, "éé " * 30000 + passage, "fr", "a", 1, "y"),
        (7, passage + " zz", "fr", "a", 1, "y"),
        (None, passage, "en", "a", 1, "y"),
        (None, "lonely text without company", "en", "a", 1, "y"),
        (8, "x" * 200, "es", "a", 1, "y"),
        (9, "ü" + "x" * 120, "es", "a", 1, "y"),
        (10, "12345 67890 --- !!!", "es", "a", 1, "y"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_words int, kept string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)
