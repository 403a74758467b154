"""SimHash near-dedup by multi-index hashing.

Fingerprints are compared through an index over segments: if two 64-bit fingerprints differ in at most
``distance`` bits, then in one of ``m`` segments they differ in at most ``distance // m``. With
``distance = q * m + a`` the first ``a + 1`` segments are searched with radius ``q`` and the others with
radius ``q - 1`` (no search with radius -1), which still finds every pair. For 4 bits and three segments
that is radius 1 twice and equality once.

A fingerprint is stored in its own table cell of each segment and looks into the cells of the small
Hamming ball around it. Of two cells the one that is smaller as a number looks into the other, so a pair
meets once. What meets in a cell is verified on all 64 bits. Cells where nothing is stored hold no pair.

Distinct fingerprints go through the index, each with the smallest id of its documents. Cells with one
entry are dropped after a count. A cell with very many entries (a large group of near copies) is cut into
blocks, and pairs of blocks are tasks of their own. A cell never gives all its pairs: it gives links
that connect the same fingerprints as all its pairs would. Components of links are found with
large-star and small-star rounds over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import ship
from cellspark.plans.scale import materialize

DISTANCE = 4
SHINGLE = 4
SEGMENTS = 3
#: Entries of a table cell that one task compares with each other.
CELL_BLOCK = 2048
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_STEP = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits that are set in over half of the shingles' XXH64 (seed 42), as an unsigned number.

    Words are runs of bytes that are not ASCII white space; A-Z are lower-cased. Fewer words than a
    shingle are one shingle, no word gives 0. Repeated shingles count each time.
    """
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _STEP):
        pairs = zip(starts[at : at + _STEP].tolist(), ends[at : at + _STEP].tolist())
        hashes = np.array([digest(joined[a:b], 42) for a, b in pairs], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """id_col, fp (the fingerprint's bits as a signed long); one row per input row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [id_col, "fp"])

    columns = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("_text"))
    return columns.mapInArrow(run, f"`{id_col}` long, fp long")


def segment_plan(distance: int, segments: int) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of each segment that has to be searched."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    q, a = divmod(distance, segments)
    radii = [q if i <= a else q - 1 for i in range(segments)]
    return [(lo, hi - lo, r) for lo, hi, r in zip(cuts, cuts[1:], radii) if r >= 0]


def _cells(distance: int, segments: int):
    plan = segment_plan(distance, segments)
    flips = [
        [sum(1 << b for b in bits) for r in range(1, radius + 1) for bits in combinations(range(width), r)]
        for _, width, radius in plan
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 4096):
                here = fps[at : at + 4096]
                for number, ((low, width, _), masks) in enumerate(zip(plan, flips)):
                    own = (here >> np.uint64(low)) & np.uint64((1 << width) - 1)
                    cells, entries, stored = [own], [here], len(own)
                    for mask in masks:
                        near = own ^ np.uint64(mask)
                        up = near > own
                        cells.append(near[up])
                        entries.append(here[up])
                    cell = np.concatenate(cells).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(cell), number, np.int32)),
                            pa.array(cell),
                            pa.array(np.concatenate(entries).view(np.int64)),
                            pa.array((np.arange(len(cell)) < stored).astype(np.int8)),
                        ],
                        ["segment", "cell", "fp", "stored"],
                    )

    return run


def _forest(left: np.ndarray, right: np.ndarray | None, distance: int) -> list[tuple[int, int]]:
    """Links that connect what all pairs within ``distance`` would connect.

    With ``right`` only pairs of one entry of each are compared.
    """
    nodes = left if right is None else np.concatenate([left, right])
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    others, shift = (left, 0) if right is None else (right, len(left))
    for i, value in enumerate(left):
        begin = i + 1 if right is None else 0
        near = np.flatnonzero(np.bitwise_count(others[begin:] ^ value) <= distance) + begin + shift
        for j in near.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def _verify(distance: int):
    """Sorted rows (segment, cell, one, two, side, fp) to links; a task holds one group at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: np.ndarray | None = None

        def close(rows: np.ndarray) -> list[tuple[int, int]]:
            key = rows[:, :4]
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
            found = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if b - a == 1:
                    continue
                fps, side = rows[a:b, 5].view(np.uint64), rows[a:b, 4]
                if rows[a, 2] == rows[a, 3]:
                    if b - a == 2:
                        if int(fps[0] ^ fps[1]).bit_count() <= distance:
                            found.append((int(fps[0]), int(fps[1])))
                        continue
                    found += _forest(fps, None, distance)
                else:
                    found += _forest(fps[side == 0], fps[side == 1], distance)
            return found

        def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
            pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], ["a", "b"]
            )

        for batch in batches:
            rows = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)
            rows = rows if pending is None else np.concatenate([pending, rows])
            if not len(rows):
                continue
            # the last group may go on in the next batch
            same = (rows[:, :4] == rows[-1, :4]).all(axis=1)
            cut = len(rows) - int(np.argmin(same[::-1])) if not same.all() else 0
            pending = rows[cut:]
            if cut:
                yield out(close(np.ascontiguousarray(rows[:cut])))
        if pending is not None:
            yield out(close(np.ascontiguousarray(pending)))

    return run


def near_links(
    fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, cell_block: int = CELL_BLOCK
) -> DataFrame:
    """a, b: links that connect the distinct fingerprints (column fp) within ``distance`` bits.

    Every two fingerprints within the distance are connected by the links, directly or through others.
    """
    ship(fps.sparkSession)
    cells = materialize(fps.select("fp").mapInArrow(_cells(distance, segments), "segment int, cell long, fp long, stored byte"))
    counts = cells.groupBy("segment", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("stored").alias("any"))
    counts = counts.filter("n > 1 and any = 1").drop("any")
    blocks = F.ceil(F.col("n") / F.lit(cell_block)).cast("int")
    crowded = cells.join(counts, ["segment", "cell"]).withColumn("blocks", blocks)
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    paired = crowded.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    rows = paired.select(
        "segment",
        "cell",
        F.least("own", "other").alias("one"),
        F.greatest("own", "other").alias("two"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "fp",
    )
    group = ["segment", "cell", "one", "two"]
    dealt = rows.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(_verify(distance), "a long, b long").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root: the smallest node reachable, for every node that has a link.

    Rounds of large-star and small-star over a written edge table, until a round changes nothing. A
    node's neighbours are never gathered: a round takes minima per node and joins them back.
    """
    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        # large star: larger neighbours are linked with the smallest of the neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours, and the node itself, are linked with the smallest of them
        down = large.filter("u <> v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        edges = materialize(small)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = tuple(state)
    raise RuntimeError("components did not settle")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
) -> DataFrame:
    """id_col, fingerprint (16 hex digits), component_id: one row per input row.

    ``component_id`` is the smallest id of the documents reachable over links of at most ``distance``
    differing bits. Null and empty texts have fingerprint zero and are linked like any other. A null id
    takes part but names a component only if all ids in it are null (then it is null). Rows with equal
    ids stay separate rows. All other columns are left out. ``segments`` near 64 / log2(number of
    documents) keeps table cells small; the result does not depend on it.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, shingle))
    texts = marked.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = components(near_links(texts, distance, segments))
    named = texts.join(roots, texts.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    owner = named.join(smallest, "root").select("fp", "component_id")
    return marked.join(owner, "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
