"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are dealt into blocks of bounded size, and each block of queries and each block of candidates is
indexed by a cover tree: a node's points lie within its covering radius of its centre, and its children's
centres are further apart than half the level's radius. Every pair of a query block and a candidate block
is searched by itself: a pair of nodes is left out if even the closest points that the two radii allow,
``<cq, cr> + |cq| r + |cr| q + q r``, score below the worst kth score of the query node's queries. What
the pairs find (k rows for each query) is merged by rank.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellspark.llm.common import ship
from cellspark.plans.scale import materialize

K = 10
SCALE = 1024.0
QUERY_BLOCK = 1024
DATA_BLOCK = 2048
LEAF = 32
#: Candidates that a query leaf looks at between two prunings.
STEP = 256
#: Whole numbers up to here are exact in a double.
EXACT = float(1 << 53)
#: Components beyond this are compared one by one: their distances would overflow a double.
VAST = 1e140


class CoverTree:
    """Nodes in depth-first order over reordered points; children are lists of node numbers."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order: list[np.ndarray] = []
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.span: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        self._placed = 0
        points = points.astype(np.float64)
        if len(points):
            every = np.arange(len(points))
            self._grow(every, points, 0, self._distance(points, (points**2).sum(axis=1), 0), leaf)
        self.order_of = np.concatenate(self.order) if self.order else np.empty(0, np.int64)
        self.order = []
        self.place(points)

    def place(self, points: np.ndarray) -> None:
        """Put the nodes' centres into the coordinates of ``points`` (the same ones, maybe padded)."""
        self.centres = points[self.centre].astype(np.float64) if self.centre else points[:0].astype(np.float64)
        self.norms = np.sqrt((self.centres**2).sum(axis=1))
        self.radii = np.array(self.radius)

    def stored(self) -> bytes:
        self.centres = self.norms = None
        return pickle.dumps(self)

    @staticmethod
    def _distance(points: np.ndarray, squares: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(np.maximum(squares + squares[centre] - 2 * (points @ points[centre]), 0))

    def _grow(self, rows: np.ndarray, points: np.ndarray, centre: int, away: np.ndarray, leaf: int) -> int:
        """``points`` are those of ``rows``; ``centre`` counts among them."""
        node = len(self.centre)
        squares = (points**2).sum(axis=1)
        radius = float(away.max())
        if radius * radius <= 1e-12 * squares.max():  # equal points, up to rounding
            leaf = len(rows)
        self.centre.append(int(rows[centre]))
        self.radius.append(radius + 1e-9 * float(np.sqrt(squares.max())))
        self.children.append([])
        self.span.append((self._placed, self._placed + len(rows)))
        if len(rows) <= leaf:
            self.order.append(rows)
            self._placed += len(rows)
            return node
        # a net of half the radius: centres over that apart, every point within it of its centre
        free = np.ones(len(rows), bool)
        hub, parts = centre, []
        while True:
            near = free & (away <= radius / 2)
            near[hub] = True
            free &= ~near
            members = np.flatnonzero(near)
            parts.append((members, int(np.searchsorted(members, hub)), away[members]))
            if not free.any():
                break
            hub = int(np.argmax(free))
            away = self._distance(points, squares, hub)
        for members, hub, near_away in parts:
            child = self._grow(rows[members], points[members], hub, near_away, leaf)
            self.children[node].append(child)
        return node


class _Best:
    """The k best (score, id) of every query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores: list[np.ndarray] = [np.empty(0)] * n
        self.ids: list[np.ndarray] = [np.empty(0, np.int64)] * n
        self.worst = np.full(n, -np.inf)

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        better = scores >= self.worst[query]
        if not better.any():
            return
        scores = np.concatenate([self.scores[query], scores[better]])
        ids = np.concatenate([self.ids[query], ids[better]])
        if scores.dtype == object:
            order = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[: self.k], np.int64)
        else:
            order = np.lexsort((ids, -scores))[: self.k]
        self.scores[query], self.ids[query] = scores[order], ids[order]
        if len(order) == self.k:
            self.worst[query] = float(scores[order[-1]])


def dual_search(
    query_ids: np.ndarray,
    queries: np.ndarray,
    data_ids: np.ndarray,
    data: np.ndarray,
    k: int,
    trees: tuple[CoverTree, CoverTree] | None = None,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, ids, scores): the k best data rows of each query, its own id left out."""
    asked, held = trees or (CoverTree(queries), CoverTree(data))
    best = _Best(len(queries), k)
    if not len(queries) or not len(data):
        return

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        radius = asked.radii[q]
        product = held.centres[nodes] @ asked.centres[q]
        reach = asked.norms[q] * held.radii[nodes] + radius * (held.norms[nodes] + held.radii[nodes])
        bound = product + reach
        return bound + 1e-9 * np.abs(bound) + 1.0

    def visit(q: int, nodes: np.ndarray) -> None:
        rows = asked.order_of[slice(*asked.span[q])]
        worst = best.worst[rows].min()
        bound = bounds(q, nodes)
        keep = bound >= worst
        nodes, bound = nodes[keep], bound[keep]
        # open data nodes until they are no wider than the query node
        while True:
            wide = [n for n in nodes if held.children[n] and held.radii[n] >= asked.radii[q]]
            if not wide:
                break
            opened = np.array([c for n in wide for c in held.children[n]])
            nodes = np.concatenate([np.setdiff1d(nodes, wide, assume_unique=True), opened])
            bound = bounds(q, nodes)
            keep = bound >= worst
            nodes, bound = nodes[keep], bound[keep]
        if asked.children[q]:
            for child in asked.children[q]:
                visit(child, nodes)
            return
        # both at the leaves: nodes with the highest bounds first
        nodes = nodes[np.argsort(-bound, kind="stable")]
        at = 0
        while at < len(nodes):
            take, size = [], 0
            while at < len(nodes) and size < STEP:
                a, b = held.span[nodes[at]]
                take.append(held.order_of[a:b])
                size += b - a
                at += 1
            found = np.concatenate(take)
            scores = queries[rows] @ data[found].T
            for row, own in zip(rows.tolist(), scores):
                other = data_ids[found] != query_ids[row]
                best.offer(row, own[other], data_ids[found][other])
            rest = nodes[at:]
            if len(rest):
                rest = rest[bounds(q, rest) >= best.worst[rows].min()]
                nodes, at = rest, 0

    visit(0, np.array([0]))
    for query in range(len(queries)):
        yield query, best.ids[query], best.scores[query]


def _pack(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(list(batches))
    ids = rows.column("id").to_numpy().astype(np.int64)
    vectors = rows.column("vector").to_pylist()
    width = max(map(len, vectors))
    matrix = np.zeros((len(vectors), width))
    for row, vector in zip(matrix, vectors):
        row[: len(vector)] = vector
    vast = np.abs(matrix).max(initial=0.0) > VAST
    tree = CoverTree(np.floor(SCALE * matrix[:0] if vast else SCALE * matrix)).stored()
    columns = [[key[0].as_py()], [width], [ids.tobytes()], [matrix.tobytes()], [tree]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "width", "ids", "matrix", "tree"])


def _blocks(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Packed and indexed blocks of about ``size`` vectors, written, and their number."""
    count = max(1, -(-rows.count() // size))
    # repeated rows have one hash; the vector's norm order does not matter, so they may share a block
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(count)))
    packed = dealt.groupBy("block").applyInArrow(_pack, "block long, width long, ids binary, matrix binary, tree binary")
    return materialize(packed), count


def _exact(values: np.ndarray, bound: float) -> np.ndarray:
    """floor(1024 * x) in a form whose inner products are exact: doubles if they are small enough."""
    if bound * bound * SCALE * SCALE * values.shape[1] < EXACT:
        return np.floor(SCALE * values)
    # a double from 2^53 on is whole, and 1024 times a smaller one is exact
    whole = [[int(x) * int(SCALE) if abs(x) >= EXACT else math.floor(SCALE * x) for x in row] for row in values.tolist()]
    return np.array(whole, dtype=object).reshape(values.shape)


def _one_by_one(query_ids, queries, ids, data, k):
    """What ``dual_search`` gives, without any bound."""
    for query, own in enumerate(queries):
        scored = sorted((-sum(map(mul, own, row)), i) for row, i in zip(data.tolist(), ids.tolist()) if i != query_ids[query])[:k]
        yield query, np.array([i for _, i in scored], np.int64), [-score for score, _ in scored]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                width = max(row["width"], row["q_width"], 1)
                sides, trees = [], []
                for prefix in ("q_", ""):
                    own = row[prefix + "width"]
                    ids = np.frombuffer(row[prefix + "ids"], np.int64)
                    matrix = np.zeros((len(ids), width))
                    matrix[:, :own] = np.frombuffer(row[prefix + "matrix"], np.float64).reshape(len(ids), own)
                    sides.append((ids, matrix))
                    trees.append(pickle.loads(row[prefix + "tree"]))
                bound = max([np.abs(m).max(initial=0.0) for _, m in sides])
                (query_ids, queries), (ids, data) = ((i, _exact(m, bound)) for i, m in sides)
                out: list[tuple[int, int, int]] = []
                if bound > VAST:
                    searched = _one_by_one(query_ids, queries.tolist(), ids, data, k)
                else:
                    for tree, (_, matrix) in zip(trees, sides):
                        tree.place(np.floor(SCALE * matrix))
                    searched = dual_search(query_ids, queries, ids, data, k, tuple(trees))
                for query, found, scores in searched:
                    limit = (1 << 63) - 1
                    scores = [max(-limit - 1, min(limit, int(s))) for s in scores]
                    out += zip([int(query_ids[query])] * len(found), found.tolist(), scores)
                columns = list(zip(*out)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
                )

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    query_block: int = QUERY_BLOCK,
    data_block: int = DATA_BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query.

    Components become floor(1024 * x). Queries are the rows where ``is_query`` holds, candidates all rows
    with another id. Ties go to the smaller id. Rows with a null id, a null vector, or a null or
    non-finite component take no part. A shorter vector counts as padded with zeros. Rows with equal ids
    are candidates each, and the queries among them have one ranking together. Scores beyond 64 bits are clipped. Other columns are left out.
    """
    ship(vectors.sparkSession)
    vector = F.col(vector_col).cast("array<double>")
    # a null component makes the test null, which drops the row
    sound = F.forall(vector, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.filter(F.col(id_col).isNotNull() & sound)
    data = usable.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))
    asked = usable.filter(is_query).select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).distinct()
    held, _ = _blocks(data, data_block)
    queries, count = _blocks(asked, query_block)
    named = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("block", "width", "ids", "matrix", "tree")])
    # the stated query set against all rows, block by block
    paired = held.withColumn("q_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
    pairs = paired.join(named, "q_block").repartition(F.col("block"), F.col("q_block"))
    found = pairs.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
