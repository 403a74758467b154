"""Near-duplicates of the pipeline stage against brute-force Jaccard over all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from cellspark.llm import near_dups

from .conftest import SF


def brute_shingles(text, width=5):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def expected(rows):
    """Places of the rows that stay: the first by (id, nulls last) of each component."""
    sets = [brute_shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] == sets[j] or 9 * both >= 4 * (len(sets[i]) + len(sets[j])):
            root[find(i)] = find(j)
    best = {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)):
        best.setdefault(find(i), i)
    return sorted((str(rows[i][0]), str(rows[i][1])) for i in best.values())


def edited(rng, words, share):
    return [f"new{rng.randrange(10**9)}" if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def copies():
    """Copies with a changing share of edited words, under a template in a third of all texts."""
    rng = random.Random(3)
    template = [f"t{i}" for i in range(40)]
    rows = []
    for group in range(30):
        words = [f"w{rng.randrange(2000)}" for _ in range(rng.randint(20, 200))] + template * (group % 3 == 0)
        rows.append((len(rows), " ".join(words)))
        for k in range(6):
            rows.append((len(rows), " ".join(edited(rng, words, 0.005 * (k + 1)))))
        for _ in range(3):  # a chain that leaves the first text behind
            words = edited(rng, words, 0.012)
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("sample", "frequent", "listed"), [(16, 3, 10**6), (1, 2, 100), (10**9, 3, 10)])
def test_every_pair_at_the_threshold(spark, copies, sample, frequent, listed):
    """Whatever the order of shingles, all of brute force is found."""
    df = spark.createDataFrame(copies, "doc_id long, text string")
    found = near_dups.first_of_each(df, sample=sample, frequent=frequent, listed=listed).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in found) == expected(copies)
    assert 30 <= len(found) < len(copies) / 2


def test_stage_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = corpus_pipeline.near_dedup(spark, docs, SF)
    assert found.columns == corpus_pipeline.COLUMNS
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((str(r.doc_id), str(r.text)) for r in found.collect()) == expected(rows)


def test_rows_not_ids(spark):
    """Equal rows of one id leave one; a row does not go because another row of its id is a copy."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (1, a), (5, b), (5, a), (7, b), (None, c), (None, c), (9, None), (8, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r.doc_id), str(r.text)) for r in near_dups.first_of_each(df).collect())
    assert found == sorted([("1", a), ("5", b), ("None", c), ("8", " ")])


def test_empty(nothing):
    assert near_dups.first_of_each(nothing).count() == 0


@pytest.mark.parametrize(("block", "centres"), [(3, 8), (2048, 0), (3, 1)])
def test_blocks_and_centres(spark, copies, block, centres, monkeypatch):
    """Neither the cut of a crowded cell into blocks nor the centres change what is found."""
    monkeypatch.setattr(near_dups, "BLOCK", block)
    monkeypatch.setattr(near_dups, "_centred", lambda similar, given=near_dups._centred: given(similar, centres))
    df = spark.createDataFrame(copies, "doc_id long, text string")
    found = near_dups.first_of_each(df).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in found) == expected(copies)


def test_very_long_text_and_clashing_columns(spark):
    """A text of 100000 words, its near copy, and columns that inner frames have too."""
    rng = random.Random(5)
    long = [f"w{rng.randrange(10**6)}" for _ in range(100_000)]
    rows = [(2, " ".join(edited(rng, long, 0.01)), "x", 1), (1, " ".join(long), "y", 2), (3, "short", "z", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, token string, label int")
    found = near_dups.first_of_each(df)
    assert found.columns == df.columns
    assert sorted((r.doc_id, r.token) for r in found.collect()) == [(1, "y"), (3, "z")]


def test_parities_bound_the_difference():
    """Folded to the narrower of two widths, parities never differ in more classes than the sets do in shingles."""
    rng = np.random.default_rng(4)
    for size, more in [(0, 3), (10, 0), (500, 30), (1000, 100), (5000, 900)]:
        one = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        two = np.unique(np.r_[one[more // 2 :], rng.integers(0, 1 << 63, more).astype(np.uint64)])
        wide = [near_dups._parities(x) for x in (one, two)]
        least = min(map(len, wide))
        differ = np.bitwise_count(np.bitwise_xor(*(near_dups._folded(x, least) for x in wide))).sum()
        assert differ <= len(np.setxor1d(one, two))
        assert least >= near_dups.CLASSES // 8


def test_rows_of_one_token_over_batches():
    import pyarrow as pa

    rows = np.array([1, 1, 2, 3, 3, 3, 3, 4])
    for size in (1, 2, 3, 8):
        batches = [pa.RecordBatch.from_arrays([pa.array(rows[i : i + size])], ["token"]) for i in range(0, len(rows), size)]
        found = [x for b in near_dups._shared(iter(batches)) for x in b.column(0).to_pylist()]
        assert found == [1, 1, 3, 3, 3, 3]
