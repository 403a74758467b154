"""Every pipeline stage against a brute-force version over its own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellspark.llm.queries import TOKENIZER

from .conftest import SF
from .test_decontaminate import expected as hits_of
from .test_near_dups import expected as near_copies_gone
from .test_packing import check as check_packing
from .test_repeats import words_expected


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    """Input and output of each stage, written and read again."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(
        spark.createDataFrame(
            [(9001, None, "en", "s", 0), (9002, "12 ... 34", "en", "s", 9), (9003, "", "en", "s", 0)],
            "doc_id long, text string, lang string, source string, n_chars long",
        )
    )
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        found[name] = (docs, spark.read.parquet(path))
        docs = found[name][1]
    return found


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()), key=lambda r: r[0])


def test_names_and_columns(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(outputs)
    for _, out in list(outputs.values())[:-1]:
        assert out.columns == corpus_pipeline.COLUMNS


def test_language_id(outputs):
    given, kept = outputs["language_id"]
    lost = {r.doc_id for r in given.collect()} - {r.doc_id for r in kept.collect()}
    assert lost == {9001, 9002, 9003}
    assert rows_of(given.filter(F.col("doc_id") < 9001)) == rows_of(kept)


def test_near_dedup(outputs):
    given, kept = outputs["simhash_near_dedup"]
    rows = rows_of(given)
    stay = near_copies_gone([(r[0], r[1]) for r in rows])
    assert sorted((str(r[0]), str(r[1])) for r in rows_of(kept)) == stay
    assert len(stay) < len(rows)
    assert set(rows_of(kept)) <= set(rows)


def test_substrings(outputs):
    given, kept = outputs["substring_dedup"]
    rows = rows_of(given)
    expected = []
    for row, (_, n, gone, text) in zip(rows, words_expected([(r[0], r[1]) for r in rows])):
        if gone and gone == n:
            continue
        expected.append((row[0], text, row[2], row[3], len(text)) if gone else row)
    assert rows_of(kept) == expected


def test_decontamination(spark, outputs):
    given, kept = outputs["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = rows_of(given)
    clean = [row for row, found in zip(rows, hits_of([(r[0], r[1]) for r in rows], items)) if not found[2]]
    assert rows_of(kept) == clean and len(clean) < len(rows)


def test_packing(outputs):
    given, placed = outputs["best_fit_packing"]
    used, bound = check_packing(placed.collect(), [(r.doc_id, r.text) for r in given.collect()], 4096)
    assert used <= bound + 1 and TOKENIZER


def test_run_gives_the_last_stage(spark, outputs):
    found = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(
        map(tuple, outputs["best_fit_packing"][1].select(columns).collect())
    )
