"""Wu-Manber search against every window."""

import re
from collections import Counter

import pytest

from cellspark.llm import decontaminate

from .conftest import SF


def tokens(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def expected(docs, items, window=10):
    patterns = {}
    for item, text in items:
        words = tokens(text)
        for at in range(max(1, len(words) - window + 1)) if words else ():
            patterns.setdefault(tuple(words[at : at + window]), set()).add("" if item is None else str(item))
    lengths = {len(p) for p in patterns}
    for doc, text in docs:
        words, hit, found = tokens(text), set(), set()
        for n in lengths:
            for at in range(len(words) - n + 1):
                if (key := tuple(words[at : at + n])) in patterns:
                    hit |= set(range(at, at + n))
                    found |= patterns[key]
        yield doc, len(words), tuple(sorted(hit)), tuple(sorted(found))


def got(df):
    return Counter(
        (r.doc_id, r.n_words, tuple(i for a, b in r.hits for i in range(a, b)), tuple(r["items"])) for r in df.collect()
    )


ITEMS = [
    (1, " ".join(f"word{i % 70}x{i}" for i in range(5, 25))),
    (2, "lonely TEXT"),
    (3, None),
    (4, "... --"),
    (None, "xéé one"),
    (5, "éé éé éé éé éé éé éé éé éé éé éé éé"),
    (5, "12345"),
    (6, "lonely text without company"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("part_words", [500_000, 40])
def test_odd(odd, items, part_words):
    """One set of tables, and the benchmark cut into parts."""
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = decontaminate.contamination(odd, items, carry=["lang", "n_words"], part_words=part_words)
    assert found.columns == ["doc_id", "lang", "n_words", "hits", "items"]
    assert got(found) == Counter(expected(rows, ITEMS))


def test_documents(spark, documents):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    found = decontaminate.contamination(documents, benchmark)
    assert got(found) == Counter(expected(rows, items))
    assert found.filter("size(hits) > 0").count() > 0


def test_empty(documents, nothing, items):
    assert decontaminate.contamination(nothing, items).count() == 0
    clean = decontaminate.contamination(documents, items.limit(0))
    assert clean.count() == documents.count() and clean.filter("size(hits) > 0").count() == 0


def test_shift_and_search():
    words = [b"%d" % (i % 7) for i in range(60)]
    patterns = {tuple(words[3:8]): {1}, (b"1", b"1", b"1", b"1", b"1"): {2}, tuple(words[5:10]): {3}}
    found = sorted((at, min(i)) for at, i in decontaminate.Patterns(5, patterns).search(words))
    brute = sorted(
        (at, min(patterns[tuple(words[at : at + 5])])) for at in range(56) if tuple(words[at : at + 5]) in patterns
    )
    assert found == brute
