"""Dual-tree search against all inner products."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellspark.llm import topk

from .conftest import SF


def expected(rows, step, k=10):
    sound = [
        (i, [math.floor(1024 * Fraction(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for q in sorted({i for i, _ in sound if i % step == 0}):
        own = next(v for i, v in sound if i == q)
        scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in sound if i != q)[:k]
        found += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(found)


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("blocks", [(1024, 4096), (2, 64)])
def test_embeddings(spark, blocks):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = topk.top_k(df, F.col("vec_id") % 100 == 0, query_block=blocks[0], data_block=blocks[1])
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert got(found) == expected(rows, 100)


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    rows += [(100 + i, [0.5, 0.25, -0.125, 0.0]) for i in range(60)]  # many copies: ties to the smaller id
    rows += [
        (200, None),
        (201, [None, 1.0, 1.0, 1.0]),
        (202, [float("nan"), 1.0, 1.0, 1.0]),
        (203, [float("inf"), 1.0, 1.0, 1.0]),
        (204, []),
        (205, [9.0, 9.0]),
        (206, [1e6, -1e6, 1e6, 1e6]),
        (None, [1.0, 1.0, 1.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as rank")
    found = topk.top_k(df.repartition(3), F.col("vec_id") % 20 == 0, data_block=30)
    assert got(found) == expected(rows, 20)


def test_vast_components(spark):
    """1024 times a finite component may overflow a double; the whole numbers do not."""
    rows = [(0, [1e306, 1.0]), (1, [1e-306, 2.0]), (2, [-1e306, 0.5]), (3, [0.0, 1e14]), (4, [0.0, -7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = [(q, r, i, max(-(2**63), min(2**63 - 1, s))) for q, r, i, s in expected(rows, 4)]
    assert got(topk.top_k(df, F.col("vec_id") % 4 == 0)) == want


def test_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [3.0])], "vec_id long, embedding array<float>")
    assert got(topk.top_k(df, F.col("vec_id") == 0)) == [(0, 1, 2, 3072 * 1024), (0, 2, 1, 2048 * 1024)]
    assert topk.top_k(df, F.col("vec_id") == 7).count() == 0
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_cover_tree_covers_and_prunes():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(loc=c, size=(100, 3)) for c in (0, 50, -80)])
    tree = topk.CoverTree(points, leaf=8)
    assert sorted(tree.order_of.tolist()) == list(range(300))
    for node, (a, b) in enumerate(tree.span):
        away = np.sqrt(((points[tree.order_of[a:b]] - points[tree.centre[node]]) ** 2).sum(axis=1))
        assert away.max() <= tree.radius[node] + 1e-9
        for i, one in enumerate(tree.children[node]):
            for two in tree.children[node][:i]:
                gap = np.linalg.norm(points[tree.centre[one]] - points[tree.centre[two]])
                assert gap > tree.radius[node] / 2
