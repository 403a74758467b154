"""Finding repeated windows in blocks of documents.

Suffix-array dedup and substring dedup ask the same first question: which fixed-length windows
(of bytes, or of words) occur in more than one document? A row per window would move many times the
input, so both work on *blocks* and *anchors*.

* A block is a packed row of about ``BLOCK_BYTES`` of text: document ids, lengths and the compressed
  texts. Blocks are written once, so a block number means the same documents in every later pass and
  after every retry, and bucketed by their number, so later joins with them move only the other side.
  The whole text is in a block; documents are never cut.
* Every window chooses one anchor: the shorter gram inside it with the smallest hash (the leftmost on
  ties). The choice depends on the window's content only, so equal windows choose equal anchors at
  equal offsets. One anchor serves a run of neighbouring windows, about one per (window - gram) / 2.
* ``repeated_anchors`` tells each block which of its anchors occur in another document. A block sends
  an anchor once, however often it occurs there, in 32 bits beside the partition number; a chance
  match of those bits only lets an anchor through that the exact step then drops.

Later steps judge the windows of surviving anchors exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import ship
from cellspark.plans.scale import checkpoint_root, materialize

BLOCK_BYTES = 2 << 20
#: Bytes of text whose anchors one group of the exchange holds.
GROUP_BYTES = 12 << 20
#: Window starts that are hashed at once.
CHUNK = 1 << 20
NO_ID = np.iinfo(np.int64).max

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def rolling_hash(symbols: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every run of ``length`` symbols, built from runs of powers of two."""
    total = len(symbols) - length + 1
    if total <= 0:
        return np.empty(0, np.uint64)
    power, size, factor = symbols, 1, _BASE
    out, done, left = None, 0, length
    while True:
        if left & 1:
            piece = power[done : done + total]
            out = piece if out is None else out * np.uint64(factor) + piece
            done += size
        left >>= 1
        if not left:
            return mix(out)
        power = power[:-size] * np.uint64(factor) + power[size:]
        size, factor = size * 2, factor * factor & _MASK


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values, size = np.minimum(values[:-size], values[size:]), size * 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(symbols: np.ndarray, bounds: np.ndarray, window: int, gram: int):
    """(hash, position, first, last): each anchor with the range of window starts that chose it.

    ``bounds`` are the documents' offsets in ``symbols``; no window crosses them.
    """
    n = len(symbols)
    edge = np.zeros(n + 1, np.int8)
    starts, ends = bounds[:-1], bounds[1:]
    full = ends > starts
    edge[np.maximum(ends - window + 1, starts)[full]] += 1
    edge[ends[full]] -= 1
    usable = np.cumsum(edge[:n], dtype=np.int8) == 0
    low = np.uint64((1 << 22) - 1)
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, n - window + 1, CHUNK):
        here = symbols[at : at + CHUNK + window - 1]
        grams = rolling_hash(BYTE_VALUES[here] if here.dtype == np.uint8 else here, gram)
        ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        chosen = (sliding_min(ranked, window - gram + 1) & low).astype(np.int64)
        start = np.flatnonzero(usable[at : at + len(chosen)])
        if not len(start):
            continue
        chosen = chosen[start]
        new = np.flatnonzero(np.r_[True, (np.diff(chosen) != 0) | (np.diff(start) != 1)])
        last = np.r_[new[1:] - 1, len(start) - 1]
        found.append((grams[chosen[new]], chosen[new] + at, start[new] + at, start[last] + at))
    if not found:
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    return tuple(np.concatenate(parts) for parts in zip(*found))


class Block:
    """A packed row, opened."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.null_id = np.frombuffer(row["null_ids"], np.bool_)
        self.bounds = np.concatenate([[0], np.cumsum(np.frombuffer(row["lengths"], np.int64))])
        self.text = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, int(self.bounds[-1])))

    def __len__(self) -> int:
        return len(self.ids)

    def document(self, i: int) -> bytes:
        return self.text[self.bounds[i] : self.bounds[i + 1]]

    def doc_id(self, i: int) -> int | None:
        return None if self.null_id[i] else int(self.ids[i])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, count = TaskContext.get().partitionId(), 0
    squeeze = zstandard.ZstdCompressor(level=3)
    ids: list[int | None] = []
    texts: list[bytes] = []
    rests: list[pa.RecordBatch] = []

    def block() -> pa.RecordBatch:
        nonlocal count
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rests[0].schema) as out:
            for rest in rests:
                out.write_batch(rest)
        row = {
            "block": (part << 32) + count,
            "size": sum(map(len, texts)),
            "ids": np.array([NO_ID if i is None else i for i in ids], np.int64).tobytes(),
            "null_ids": np.array([i is None for i in ids], np.bool_).tobytes(),
            "lengths": np.array([len(t) for t in texts], np.int64).tobytes(),
            "data": squeeze.compress(b"".join(texts)),
            "rest": sink.getvalue().to_pybytes(),
        }
        count += 1
        return pa.RecordBatch.from_pylist([row], schema=PACKED_ARROW)

    for batch in batches:
        rest = batch.select([n for n in batch.schema.names if n not in ("_id", "_text")])
        text = batch.column("_text").cast(pa.binary())
        begin, held = 0, sum(map(len, texts))
        for i, (doc, value) in enumerate(zip(batch.column("_id").to_pylist(), text)):
            data = value.as_py() or b""
            ids.append(doc)
            texts.append(data)
            held += len(data)
            if held >= BLOCK_BYTES:
                rests.append(rest.slice(begin, i + 1 - begin))
                yield block()
                ids, texts, rests, begin, held = [], [], [], i + 1, 0
        if begin < batch.num_rows:
            rests.append(rest.slice(begin))
    if ids:
        yield block()


PACKED = "block long, size long, ids binary, null_ids binary, lengths binary, data binary, rest binary"
PACKED_ARROW = pa.schema(
    [("block", pa.int64()), ("size", pa.int64())]
    + [(n, pa.binary()) for n in ("ids", "null_ids", "lengths", "data", "rest")]
)


def pack(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> tuple[DataFrame, int]:
    """The blocks of ``docs``, written, and the number of groups for exchanges between them.

    ``carry`` columns travel as they are and come back with ``unpack_rest``.
    """
    spark = docs.sparkSession
    ship(spark)
    columns = [F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")]
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    groups = max(4, -(-size // GROUP_BYTES))
    packed = docs.select(*columns, *carry, F.lit(0).alias("_row")).mapInArrow(_pack, PACKED)
    name = f"blocks_{uuid.uuid4().hex}"
    writer = packed.repartition(groups, "block").write.bucketBy(groups, "block").sortBy("block")
    writer.option("path", f"{checkpoint_root(spark)}/{name}").saveAsTable(name)
    blocks = spark.table(name)
    # the name was only needed to say how the files are bucketed; they stay, as the table is external
    spark.sql(f"DROP TABLE {name}")
    return blocks, groups


def unpack_rest(row: dict) -> pa.Table:
    with pa.ipc.open_stream(row["rest"]) as stream:
        return stream.read_all()


class Anchors:
    """The distinct anchors of a block, ordered by exchange group, and which of them are repeated."""

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, ids: np.ndarray, window: int, gram: int, groups: int):
        self.hash, self.position, self.first, self.last = anchors(symbols, bounds, window, gram)
        self.doc = np.searchsorted(bounds, self.position, "right") - 1
        self.doc_id = ids[self.doc]
        self.group = ((self.hash >> np.uint64(32)) % np.uint64(groups)).astype(np.uint64)
        key = (self.group << np.uint64(32)) | (self.hash & np.uint64(0xFFFFFFFF))
        self.keys, self.inverse = np.unique(key, return_inverse=True)
        low = np.full(len(self.keys), NO_ID)
        high = np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(low, self.inverse, self.doc_id)
        np.maximum.at(high, self.inverse, self.doc_id)
        self.local = low < high

    def by_group(self) -> Iterator[tuple[int, slice]]:
        owner = self.keys >> np.uint64(32)
        cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else []
        for a, b in zip(cuts, [*cuts[1:], len(owner)]):
            yield int(owner[a]), slice(int(a), int(b))

    def surviving(self, flags: list[dict] | None) -> np.ndarray:
        """Indexes of the anchor occurrences whose anchor is also in another document."""
        keep = self.local.copy()
        sent = dict(self.by_group())
        for flag in flags or []:
            at = sent[flag["part"]]
            keep[at] |= np.unpackbits(np.frombuffer(flag["bits"], np.uint8), count=at.stop - at.start).astype(bool)
        return np.flatnonzero(keep[self.inverse])


def _shared(key: tuple, group: pa.Table) -> pa.Table:
    sent = [np.frombuffer(v.as_py(), np.uint32) for v in group.column("keys")]
    values, inverse, counts = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
    hit = counts[inverse] > 1
    cuts = np.cumsum([len(s) for s in sent])[:-1]
    bits = [np.packbits(h).tobytes() for h in np.split(hit, cuts)]
    return pa.table({"block": group.column("block"), "part": group.column("part"), "bits": pa.array(bits, pa.binary())})


def repeated_anchors(packed: DataFrame, make_anchors) -> DataFrame:
    """block, flags: for each block one bit per distinct anchor, set if another block has it too.

    ``make_anchors(block)`` builds the block's ``Anchors``. A group holds one 32-bit value per block
    and anchor, so even an anchor that is in every document is small: 4 bytes per block.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = make_anchors(Block(row))
                low = (found.keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                parts = list(found.by_group())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p for p, _ in parts], pa.int32()),
                        pa.array([row["block"]] * len(parts), pa.int64()),
                        pa.array([low[at].tobytes() for _, at in parts], pa.binary()),
                    ],
                    ["part", "block", "keys"],
                )

    sent = packed.mapInArrow(send, "part int, block long, keys binary")
    bits = sent.groupBy("part").applyInArrow(_shared, "block long, part int, bits binary")
    return materialize(bits.groupBy("block").agg(F.collect_list(F.struct("part", "bits")).alias("flags")))
