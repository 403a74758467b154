"""Near-duplicates by the real Jaccard similarity of word shingles, every pair at or over the threshold.

Multi-index hashing comes first: SimHash fingerprints of the shingle sets are linked within a few bits, the linked
sets are verified on their texts, and what holds is one component already. A 64-bit SimHash of two texts with
Jaccard 0.8 differs in about ten bits, and in up to 17, so that index alone misses pairs. The rest comes from prefix
filtering, which misses none: with all shingles in one fixed order, two sets of Jaccard ``t`` or more share one of
their first ``size - ceil(t * size) + 1`` shingles, and the first one they share leaves enough shingles after it on
both sides. The order puts shingles last that are frequent in a sample of texts. It decides only how crowded the
cells (the entries with one prefix shingle) are: any order finds the same pairs. Equal shingle sets are one entry.

Sets differ in at least as many shingles as the parities of their hash classes do. A set has as many classes as
shingles, rounded up to a power of two, so the bound stays sharp for long texts; of two sets the wider parities are
folded. Entries carry the narrowest form into the cells, which compare them there; pairs that pass are compared in
full width, and only texts of pairs that pass that move.

Cells of one component need no work. In the others each entry is first held against a centre: the entry nearest to
the cell's majority of parities, and for entries that cannot be similar to it a next one, a few times. Only what is still
apart after that is compared pair by pair. A crowded cell is cut into blocks and pairs of blocks are groups of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import ship
from cellspark.llm.simhash import _LOWER, components, near_links
from cellspark.plans.scale import lookup_join, materialize, settle

SHINGLE = 5
#: Jaccard of linked texts, at least, as a fraction.
SIMILAR = (4, 5)
#: One text in so many is sampled for the order, shingles in so many sampled texts are frequent, and so many at most.
SAMPLE, FREQUENT, LISTED = 16, 3, 1_000_000
#: Parts into which the pairs of one text are dealt.
SALTS = 64
#: Fewest hash classes of shingles whose parities are compared, a power of two.
CLASSES = 512
#: Bits in which fingerprints differ at most, and the index's segments.
DISTANCE, SEGMENTS = 4, 3
#: Entries of a cell that are compared in one group, and centres of a group before its pairs are compared.
BLOCK, CENTRES = 2048, 8


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 (seed 42) of runs of ``width`` words; fewer words are one shingle, none give none.

    Words are runs of bytes that are not ASCII white space; A-Z are lower-cased.
    """
    words = text.translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64))


def prefix_size(size: int, similar: tuple[int, int] = SIMILAR) -> int:
    """How many first shingles of a set have one in common with every similar set."""
    n, d = similar
    return size - -(-n * size // d) + 1 if size else 0


def _frequent(texts: DataFrame, width: int, sample: int, frequent: int, listed: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py() or b"", width) for t in batch.column(0).cast(pa.binary())]
            if found:
                keys, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["token", "n"])

    some = texts.filter(F.pmod(F.xxhash64("_text"), F.lit(sample)) == 0).select("_text")
    counts = some.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    counts = materialize(counts.filter(F.col("n") >= frequent))
    left, least = listed, frequent
    for n, tokens in sorted(map(tuple, counts.groupBy("n").count().collect()), reverse=True):
        left -= tokens
        if left < 0:
            least = n + 1
            break
    table = counts.filter(F.col("n") >= least).select("token").toArrow()
    return np.sort(table.column(0).to_numpy().view(np.uint64))


def _parities(found: np.ndarray) -> np.ndarray:
    """Whether each of the hash classes of the set holds an odd number of shingles, packed to bytes."""
    classes = max(CLASSES, 1 << max(len(found) - 1, 0).bit_length())
    odd = np.bincount((found & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(bool))


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Parities of the classes modulo ``size`` bytes of them."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def _fingerprint(found: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(found), 1 << 16):
        part = found[at : at + (1 << 16)].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(found)).tobytes(), "big")


def _mark(frequent, width: int, similar: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = frequent.value
        for batch in batches:
            keys, sizes, bits, folds, fps, prefixes = [], [], [], [], [], []
            for text in batch.column(batch.num_columns - 1).cast(pa.binary()):
                found = shingles(text.as_py() or b"", width)
                keys.append(xxhash.xxh64_intdigest(found.tobytes(), 7))
                sizes.append(len(found))
                parities = _parities(found)
                bits.append(parities.tobytes())
                folds.append(_folded(parities, CLASSES // 8).tobytes())
                fps.append(_fingerprint(found))
                if len(late) and len(found):
                    is_late = late[np.minimum(np.searchsorted(late, found), len(late) - 1)] == found
                    found = np.concatenate([found[~is_late], found[is_late]])
                prefixes.append(found[: prefix_size(len(found), similar)].tobytes())
            own = [
                pa.array(np.array(keys, np.uint64).view(np.int64)),
                pa.array(sizes, pa.int64()),
                pa.array(bits, pa.binary()),
                pa.array(folds, pa.binary()),
                pa.array(np.array(fps, np.uint64).view(np.int64)),
                pa.array(prefixes, pa.binary()),
            ]
            names = batch.schema.names[:-1] + ["_key", "_size", "_bits", "_fold", "_fp", "_prefix"]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + own, names)

    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, size, prefix to a row (token, key, size, place) per shingle of the prefix."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            prefixes = [np.frombuffer(p, np.int64) for p in batch.column(2).to_pylist()]
            lengths = np.array([len(p) for p in prefixes], np.int64)
            if not lengths.sum():
                continue
            place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            columns = [
                np.concatenate(prefixes),
                np.repeat(batch.column(0).to_numpy(), lengths),
                np.repeat(batch.column(1).to_numpy(), lengths),
                place,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "key", "size", "place"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first column, without those whose first column no other row has.

    Only the last row of a batch waits for the next one, however long a group is.
    """
    waiting, names = None, []
    ahead = None  # the first column of the row before the waiting one
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
        if waiting is not None:
            rows = np.concatenate([waiting, rows])
        token = rows[:, 0]
        same = token[1:] == token[:-1]
        keep = np.r_[ahead is not None and token[0] == ahead, same][:-1] | same
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in rows[:-1][keep].T], names)
        ahead = token[-2] if len(token) > 1 else ahead
        waiting = rows[-1:]
    if waiting is not None and ahead is not None and waiting[0, 0] == ahead:
        yield pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in waiting.T], names)


def _may(rows: np.ndarray, bits: np.ndarray, i: int, others: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """Those of ``others`` that are in another component than row ``i`` and can be similar to it."""
    n, d = similar
    size, place, label = rows[:, 4], rows[:, 5], rows[:, 6]
    j = others[label[others] != label[i]]
    # the shingle of the cell is the first that both share
    j = j[(n + d) * np.minimum(size[i] - place[i], size[j] - place[j]) >= n * (size[j] + size[i])]
    differ = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
    return j[(n + d) * differ <= (d - n) * (size[j] + size[i])]


def _paired(rows: np.ndarray, i: int, j: np.ndarray) -> np.ndarray:
    return np.stack([np.full(len(j), rows[i, 3]), rows[j, 3]], axis=1)


def _centred(similar: tuple[int, int], centres: int = CENTRES):
    """Pairs of each entry and a centre of its group that it can be similar to; at most one pair per entry."""

    def work(rows: np.ndarray, bits: np.ndarray) -> Iterator[np.ndarray]:
        left = np.arange(len(rows))
        for _ in range(centres):
            if len(left) < 2:
                return
            odd = np.zeros(CLASSES, np.int64)
            for at in range(0, len(left), 4096):
                odd += np.unpackbits(bits[left[at : at + 4096]].view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
            most = np.packbits(odd * 2 > len(left)).view(np.uint64)
            far = np.bitwise_count(bits[left] ^ most).sum(axis=1, dtype=np.int64)
            centre = left[np.lexsort((rows[left, 3], far))[0]]
            found = _may(rows, bits, centre, left, similar)
            if len(found):
                yield _paired(rows, centre, found)
            left = np.setdiff1d(left, np.r_[found, centre], assume_unique=True)
            left = left[rows[left, 6] != rows[centre, 6]]

    return work


def _apart(similar: tuple[int, int]):
    """All pairs of a group that are in different components and can be similar.

    Rows of side 1 are held against side 0 where the group is a pair of blocks, else all with all.
    """

    def work(rows: np.ndarray, bits: np.ndarray) -> Iterator[np.ndarray]:
        left, right = (np.flatnonzero(rows[:, 7] == side) for side in (0, 1))
        between = rows[0, 1] != rows[0, 2]
        for at, i in enumerate(left):
            found = _may(rows, bits, i, right if between else left[at + 1 :], similar)
            if len(found):
                yield _paired(rows, i, found)

    return work


def _groups(work: Callable[[np.ndarray, np.ndarray], Iterator[np.ndarray]]):
    """Runs ``work`` on the groups (token, one, two) of sorted rows, one at a time, and gives the pairs a < b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[np.ndarray, np.ndarray]] = []
        out: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            pairs = np.concatenate(out)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], ["a", "b"])

        def close() -> Iterator[pa.RecordBatch]:
            rows, bits = (np.concatenate(part) for part in zip(*pending))
            pending.clear()
            if len(rows) < 2 or (rows[:, 6] == rows[0, 6]).all():
                return
            for pairs in work(rows, bits):
                out.append(pairs)
                if len(out) >= 256:
                    yield flush()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy() for c in batch.columns[:-1]], axis=1)
            bits = np.frombuffer(b"".join(batch.column("fold").to_pylist()), np.uint64).reshape(len(rows), -1)
            starts = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
            for at, end in zip(starts.tolist(), [*starts[1:].tolist(), len(rows)]):
                if pending and (pending[-1][0][-1, :3] != rows[at, :3]).any():
                    yield from close()
                pending.append((rows[at:end], bits[at:end]))
        if pending:
            yield from close()
        if out:
            yield flush()

    return run


def _possible(similar: tuple[int, int]):
    n, d = similar

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = (batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()).tolist()
            good = []
            for one, two, size in zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), sizes):
                least = min(len(one), len(two))
                pair = (_folded(np.frombuffer(x, np.uint8), least) for x in (one, two))
                differ = int(np.bitwise_count(np.bitwise_xor(*pair)).sum(dtype=np.int64))
                good.append((n + d) * differ <= (d - n) * size)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _similar(width: int, similar: tuple[int, int]):
    """Rows (a, part, b, text) sorted by them, a's own text first (no b), to the pairs (a, b) of similar sets."""
    n, d = similar

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            pairs = []
            columns = (batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("text").cast(pa.binary()))
            for a, b, text in zip(*columns):
                found = shingles(text.as_py() or b"", width)
                if b is None:
                    own = found
                    continue
                both = len(np.intersect1d(own, found, assume_unique=True))
                if (n + d) * both >= n * (len(own) + len(found)):
                    pairs.append((a, b))
            one, two = zip(*pairs) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], ["a", "b"])

    return run


def _beside(pairs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Size and parities of both keys of each pair, as name_a and name_b; a key in many pairs is dealt in parts."""
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("a", "b"), F.lit(SALTS)))
    for side in ("a", "b"):
        own = firsts.select(F.col("_key").alias(side), *[F.col(f"_{n}").alias(f"{n}_{side}") for n in ("size", "bits")])
        dealt = dealt.join(dealt.select(side, "part").distinct().join(own, side), [side, "part"])
    return dealt.select("a", "b", "size_a", "size_b", "bits_a", "bits_b")


def _verified(pairs: DataFrame, firsts: DataFrame, texts: DataFrame, width: int, similar: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of similar sets. ``firsts`` has a row per set, ``texts`` are the text of each _row.

    A text moves once per pair as b, and once per part of its pairs as a.
    """
    pair = "a long, b long"
    pairs = materialize(pairs.distinct())
    near = _beside(pairs, firsts).mapInArrow(_possible(similar), pair)
    near = materialize(near.withColumn("part", F.pmod(F.xxhash64("a", "b"), F.lit(SALTS))))
    need = near.select(F.col("a").alias("_key"), "a", "part", F.lit(None).cast("long").alias("b")).distinct()
    need = need.unionByName(near.select(F.col("b").alias("_key"), "a", "part", "b"))
    need = materialize(need.join(firsts, "_key").select(F.col("first._row").alias("_row"), "a", "part", "b"))
    # only texts of these pairs move; nulls come first in ascending order
    rows = lookup_join(texts, need, ["_row"], "inner").select("a", "part", "b", "text")
    beside = rows.repartition("a", "part").sortWithinPartitions("a", "part", "b")
    return beside.mapInArrow(_similar(width, similar), pair)


def _close(firsts: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets whose fingerprints are linked by multi-index hashing, one set for each fingerprint."""
    counts = firsts.groupBy(F.col("_fp").alias("fp")).agg(F.min("_key").alias("rep"), F.count(F.lit(1)).alias("n"))
    fps = materialize(counts)
    links = near_links(fps, DISTANCE, SEGMENTS)
    for side in ("a", "b"):
        links = links.join(fps.select(F.col("fp").alias(side), F.col("rep").alias(f"rep_{side}")), side)
    between = links.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"))
    sets = firsts.select(F.col("_fp").alias("fp"), "_key")
    inside = lookup_join(sets, fps.filter("n > 1").select("fp", "rep"), ["fp"], "inner").filter("rep <> _key")
    return between.unionByName(inside.select(F.col("rep").alias("a"), F.col("_key").alias("b")))


def _crowded(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """token, n, open (several components) of the cells with more than ``BLOCK`` entries."""
    counts = cells.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    crowded = materialize(counts.filter(F.col("n") > BLOCK))
    entries = lookup_join(cells.select("token", "key"), crowded, ["token"], "inner").join(labels, "key", "left")
    label = F.coalesce("label", "key")
    seen = entries.groupBy("token", "n").agg(F.min(label).alias("low"), F.max(label).alias("high"))
    return materialize(seen.select("token", "n", (F.col("low") < F.col("high")).alias("open")))


def _found(cells: DataFrame, firsts: DataFrame, roots: DataFrame, between: bool, work) -> DataFrame:
    """Pairs (a, b) that ``work`` finds in the blocks of the cells, or in all pairs of blocks.

    ``roots`` name the components so far. Cells of one component give nothing; crowded ones do not move for that.
    """
    labels = roots.select(F.col("node").alias("key"), F.col("root").alias("label"))
    folds = firsts.select(F.col("_key").alias("key"), F.col("_fold").alias("fold")).join(labels, "key", "left")
    rows = cells.join(folds.withColumn("label", F.coalesce("label", "key")), "key")
    rows = lookup_join(rows, _crowded(cells, labels), ["token"], "left").filter("open is null or open")
    blocks = F.coalesce(F.ceil(F.col("n") / F.lit(BLOCK)), F.lit(1)).cast("long")
    dealt = rows.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("key", F.lit(7)), F.col("blocks")))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", others if between else F.col("own"))
    group = ["token", "one", "two"]
    rows = dealt.select(
        "token",
        F.least("own", "other").alias("one"),
        F.greatest("own", "other").alias("two"),
        "key",
        "size",
        "place",
        "label",
        (F.col("own") > F.col("other")).cast("long").alias("side"),
        "fold",
    )
    return rows.repartition(*group).sortWithinPartitions(*group, "key").mapInArrow(_groups(work), "a long, b long")


def first_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    similar: tuple[int, int] = SIMILAR,
    sample: int = SAMPLE,
    frequent: int = FREQUENT,
    listed: int = LISTED,
) -> DataFrame:
    """The rows of ``docs`` without near copies, all columns: of each component the row with the smallest id.

    Rows are linked if the Jaccard similarity of their shingle sets is at least ``similar``, or if the sets
    are equal (null, empty and blank texts have an empty one). Components are decided by row: of rows with
    equal ids in one component one stays, and a row does not go because another one of its id does. A null
    id is larger than any other.
    """
    spark = docs.sparkSession
    ship(spark)
    columns = docs.columns
    texts = docs.withColumn("_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    late = spark.sparkContext.broadcast(_frequent(texts, width, sample, frequent, listed))
    given = texts.withColumn("_row", F.monotonically_increasing_id()).select(*columns, "_row", "_text")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    own = "_row long, _key long, _size long, _bits binary, _fold binary, _fp long, _prefix binary"
    marked = materialize(given.mapInArrow(_mark(late, width, similar), ", ".join([*kinds, own])))
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "_row")
    same = [F.any_value(c).alias(c) for c in ("_size", "_bits", "_fold", "_fp")]
    firsts = materialize(marked.groupBy("_key").agg(F.min(order).alias("first"), *same))
    text = marked.select("_row", F.col(text_col).cast("string").alias("text"))

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, firsts, text, width, similar)

    def shared() -> DataFrame:
        rows = firsts.select(F.col("first._row").alias("_row"))
        prefixes = marked.select("_row", "_key", "_size", "_prefix").join(rows, "_row", "left_semi")
        cell = "token long, key long, size long, place long"
        tokens = prefixes.select("_key", "_size", "_prefix").mapInArrow(_tokens, cell)
        return tokens.repartition("token").sortWithinPartitions("token").mapInArrow(_shared, cell)

    links = settle(spark, lambda: verified(_close(firsts)))
    roots = settle(spark, lambda: components(links))
    cells = materialize(shared())
    links = links.unionByName(settle(spark, lambda: verified(_found(cells, firsts, roots, False, _centred(similar)))))
    roots = settle(spark, lambda: components(links))
    links = links.unionByName(settle(spark, lambda: verified(_found(cells, firsts, roots, True, _apart(similar)))))
    named = firsts.join(components(links), F.col("_key") == F.col("node"), "left")
    kept = named.groupBy(F.coalesce("root", "_key").alias("root")).agg(F.min("first").alias("first"))
    return marked.join(kept.select(F.col("first._row").alias("_row")), "_row", "left_semi").select(*columns)
