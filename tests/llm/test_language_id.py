"""Kneser-Ney models: probabilities by the textbook, held-out accuracy, calibrated rejection."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cellspark.llm import language_id as li


def textbook(texts, order):
    """log2 probability of a symbol after a context, by the definition."""
    codes = [li.symbols(t, order).tolist() for t in texts]
    counts = {order: Counter(tuple(c[i : i + order]) for c in codes if c for i in range(len(c) - order + 1))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    symbols = len(counts[1]) + 1
    discount, total, kinds = {}, {}, {}
    for k, of_k in counts.items():
        n1, n2 = sum(c == 1 for c in of_k.values()), sum(c == 2 for c in of_k.values())
        discount[k] = min(0.95, n1 / (n1 + 2 * n2)) if n1 else 0.1
        total[k], kinds[k] = defaultdict(int), defaultdict(int)
        for g, c in of_k.items():
            total[k][g[:-1]] += c
            kinds[k][g[:-1]] += 1

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / symbols
        context = gram[:-1]
        if not total[k][context]:
            return p(gram[1:])
        own = max(counts[k][gram] - discount[k], 0) if counts[k][gram] else 0
        return own / total[k][context] + discount[k] * kinds[k][context] / total[k][context] * p(gram[1:])

    return lambda gram: math.log2(p(tuple(gram)))


@pytest.fixture(scope="module")
def small(spark):
    texts = {"aa": ["Anna banana, nab a ban!", "bana", "x"], "bb": ["zorro y zarro", "Zor? zár 12"]}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, v in texts.items() for t in v)]
    rows += [(90, None, "aa"), (91, "no label", None), (92, "123", "cc")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return texts, li.train(df)


def test_probabilities(small):
    texts, models = small
    assert models.languages == ["aa", "bb"]
    rng = np.random.default_rng(1)
    letters = [0, *map(ord, "abnzorxyáq")]
    grams = np.array([li.symbols("banana", 4)[i : i + 4] for i in range(7)] + rng.choice(letters, (200, 4)).tolist(), np.uint32)
    scores = li.gram_scores(models, grams)
    for column, lang in enumerate(models.languages):
        reference = textbook(texts[lang], 4)
        assert np.allclose(scores[:, column], [reference(g) for g in grams.tolist()], atol=1e-4)


def test_memory_of_scores_changes_nothing(small):
    _, models = small
    scorer = li._Scorer(models)
    codes = li.symbols("banana zorro", 4)
    windows = np.lib.stride_tricks.sliding_window_view(codes, 4)
    direct = li.gram_scores(models, windows).sum(axis=0)
    assert np.allclose(scorer.total(codes), direct, atol=1e-3) and np.allclose(scorer.total(codes), direct, atol=1e-3)


def test_arrays_are_sorted_and_bounded(small, spark):
    _, models = small
    for keys, values in models.grams + models.contexts:
        assert (np.diff(keys.astype(object)) > 0).all() and len(keys) == len(values)
    df = spark.createDataFrame([(1, "abcdefgh ijkl", "aa"), (2, "mnop qrst", "bb")], "doc_id long, text string, lang string")
    capped = li.train(df, entries=48)
    assert sum(len(k) for k, _ in capped.grams + capped.contexts) <= 48
    assert np.isfinite(li.gram_scores(capped, np.array([[0, 0, 0, 97], [1, 2, 3, 4]], np.uint32))).all()


def test_odd(odd, small):
    _, models = small
    found = {(r.doc_id, r.lang_pred, r.score == 0, r.rejected) for r in li.predict(odd, models, carry=["doc_id", "score"]).collect()}
    und = {i for i, lang, _, _ in found if lang == "und"}
    assert und == {3, 4, 5, 10}
    assert all((lang == "und") == zero for _, lang, zero, _ in found)
    assert all(rejected for _, lang, _, rejected in found if lang == "und")


def test_no_training_rows(odd, nothing):
    models = li.train(nothing)
    assert models.languages == []
    assert {r.lang_pred for r in li.predict(odd, models).collect()} == {"und"}
    assert li.predict(nothing, models).count() == 0


def test_held_out_accuracy_and_rejection(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    fold = li.in_fold(df.doc_id)
    models = li.train(df.filter(~fold))
    rows = li.predict(df.filter(fold), models, carry=["doc_id", "lang"]).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows) and len(rows) > 150
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert not any(r.rejected for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    noise = [(1, "qxzkj vbnmw qqzx jjkvw xzqk wvbx zzqj kxvw qzjx vkwq zxjq " * 3)]
    strange = li.predict(spark.createDataFrame(noise, "doc_id long, text string"), models).first()
    assert strange.rejected and strange.lang_pred in models.languages


def test_symbols():
    assert li.symbols("Ab, c!", 3).tolist() == li.symbols(" 1Ab  c", 3).tolist() == [0, 0, 97, 98, 0, 99, 0]
    assert not len(li.symbols("12 ...", 4)) and not len(li.symbols(None, 4))


def test_large_models_keep_every_gram(spark, odd):
    """A model over ``entries`` is joined instead of broadcast and gives the same results."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fold = li.in_fold(df.doc_id)
    whole, joined = li.train(df.filter(~fold)), li.train(df.filter(~fold), entries=100)
    assert joined.tables and not whole.tables
    assert joined.limits.keys() == whole.limits.keys()
    assert all(math.isclose(joined.limits[k], v, abs_tol=1e-4) for k, v in whole.limits.items())
    texts = df.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    columns = ["doc_id", "lang_pred", "letters", "rejected", "cross_entropy", "score"]
    a, b = (
        sorted((tuple(r) for r in li.predict(texts, m, carry=["doc_id"]).select(columns).collect()), key=str)
        for m in (whole, joined)
    )
    assert [r[:4] for r in a] == [r[:4] for r in b] and len(a) == texts.count()
    assert all(x[4] == y[4] or math.isclose(x[4], y[4], abs_tol=1e-4) for x, y in zip(a, b))
    assert all(math.isclose(x[5], y[5], abs_tol=1e-3) for x, y in zip(a, b))


def test_all_training_rows_calibrate(spark, documents):
    df = documents.filter("lang is not null and text is not null").select("doc_id", "text", "lang")
    models = li.train(df)
    worst = {}
    for r in li.predict(df, models).filter(f"letters >= {li.REJECT_LETTERS}").collect():
        worst[r.lang_pred] = max(worst.get(r.lang_pred, 0), r.cross_entropy)
    assert models.limits.keys() == worst.keys()
    assert all(math.isclose(models.limits[k], v + li.REJECT_MARGIN, abs_tol=1e-6) for k, v in worst.items())


def test_identify_scores_once(spark, documents, nothing):
    noise = spark.createDataFrame([(-5, "qzxv wkqj " * 20, None), (-6, None, "en"), (-7, "12", "en")], "doc_id long, text string, lang string")
    df = documents.select("doc_id", "text", "lang").unionByName(noise)
    fold = li.in_fold(li.F.col("doc_id"))
    models = li.train(df.filter(~fold))
    want = li.predict(df, models, carry=["doc_id"]).collect()
    got = li.identify(df, ~fold, carry=["doc_id"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and any(r.rejected for r in got)
    assert li.identify(nothing, carry=["doc_id"]).count() == 0
