"""Suffix-array dedup: column-wise construction over the collection of reads.

Bytes of a document that lie in a ``window``-byte string which also starts in a document with a smaller
id are removed. Equal strings are found with a collection Burrows-Wheeler transform that is built column
by column: every round inserts one symbol of every document, from the right, and keeps the order of the
suffixes and the common prefixes of neighbours up to date.

Inserting whole corpora in lock-step would need as many rounds as the longest text has bytes. So the
collection is dealt out first (see ``blocks``): windows are grouped by their anchor, and each anchor that
several documents share gives one *read*, the stretch of text its windows cover (at most
2 * window - gram bytes). Equal windows are in reads of one group and at one offset from the anchor, so
the reads of a group are a collection of short documents, aligned at the anchor, which needs
2 * window - gram rounds and in which only suffixes of the same round can start equal windows. A round is
therefore one stable sort of the previous order by the inserted symbol, and its common prefix is one more
than the smallest common prefix between the two neighbours in the previous round.

Equal reads of one block are sent once, with their smallest document id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.llm.blocks import Anchors, Block, mix, pack, repeated_anchors, unpack_rest
from cellspark.plans.scale import materialize

WINDOW = 50
GRAM = 16
#: Never a byte of UTF-8 text.
PAD = 0xFF
#: Common prefixes are counted up to here, so that they fit one byte.
_CAP = np.uint8(250)


def column_wise(columns: np.ndarray, docs: np.ndarray, window: int, starts: int) -> np.ndarray:
    """For each read a bit mask: bit c is set if the window that starts in column c is also in a read
    of a smaller document.

    ``columns`` has a row per column and a read per entry, PAD where a read has no symbol. Windows start
    in the first ``starts`` columns.
    """
    width, n = columns.shape
    mask = np.zeros(n, np.uint64)
    if n < 2:
        return mask
    order = np.arange(n)
    prefix = np.zeros(n, np.uint8)  # common prefix with the neighbour before
    log = np.zeros(n + 1, np.int64)
    log[2:] = np.floor(np.log2(np.arange(2, n + 1))).astype(np.int64)
    for column in range(width - 1, -1, -1):
        symbols = columns[column]
        if (symbols == PAD).all():
            continue
        moved = np.argsort(symbols[order], kind="stable")
        new_order = order[moved]
        sorted_symbols = symbols[new_order]
        same = np.flatnonzero((sorted_symbols[1:] == sorted_symbols[:-1]) & (sorted_symbols[1:] != PAD)) + 1
        minima = [prefix]
        while (1 << len(minima)) <= n:
            half = 1 << (len(minima) - 1)
            level = minima[-1].copy()
            np.minimum(level[:-half], level[half:], out=level[:-half])
            minima.append(level)
        lookup = np.stack(minima)
        a, b = moved[same - 1] + 1, moved[same] + 1
        level = log[b - a]
        between = np.minimum(lookup[level, a], lookup[level, b - (1 << level)])
        prefix = np.zeros(n, np.uint8)
        prefix[same] = np.minimum(between, _CAP) + np.uint8(1)
        order = new_order
        if column < starts:
            joined = prefix >= window
            if joined.any():
                run = np.cumsum(~joined) - 1
                first = np.flatnonzero(~joined)
                ordered = docs[order]
                least = np.minimum.reduceat(ordered, first)
                later = order[ordered > least[run]]
                mask[later] |= np.uint64(1) << np.uint64(column)
    return mask


class _Reads:
    """The distinct reads of a block, ordered by exchange group."""

    def __init__(self, block: Block, found: Anchors, at: np.ndarray, window: int):
        self.at = at
        text = np.frombuffer(block.text, np.uint8)
        first, last, position = found.first[at], found.last[at], found.position[at]
        length = last + window - first
        # the read's identity inside the block: its anchor, its extent, and its bytes
        content = (block.text[a : a + n] for a, n in zip(first.tolist(), length.tolist()))
        names = np.fromiter(map(xxhash.xxh3_64_intdigest, content), np.uint64, len(at))
        names = mix(names ^ found.hash[at]) + (position - first).astype(np.uint64)
        order = np.lexsort((found.doc_id[at], names, found.group[at]))
        fresh = np.ones(len(at), bool)
        group, ordered = found.group[at][order], names[order]
        fresh[1:] = (ordered[1:] != ordered[:-1]) | (group[1:] != group[:-1])
        self.read_of = np.empty(len(at), np.int64)
        self.read_of[order] = np.cumsum(fresh) - 1
        self.one = order[fresh]  # the occurrence in the smallest document stands for the read
        self.group = found.group[at][self.one]
        self.doc_id = found.doc_id[at][self.one]
        self.left = (position - first)[self.one]
        self.length = length[self.one]
        self.first = first[self.one]
        self.text = text

    def by_group(self) -> Iterator[tuple[int, slice]]:
        cuts = np.flatnonzero(np.r_[True, self.group[1:] != self.group[:-1]]) if len(self.group) else []
        for a, b in zip(cuts, [*cuts[1:], len(self.group)]):
            yield int(self.group[a]), slice(int(a), int(b))


def _windows_of(row: dict, groups: int, window: int, gram: int) -> tuple[Block, Anchors, _Reads]:
    block = Block(row)
    found = Anchors(np.frombuffer(block.text, np.uint8), block.bounds, block.ids, window, gram, groups)
    return block, found, _Reads(block, found, found.surviving(row["flags"]), window)


def repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per input row: id_col, n_bytes, n_removed, spans, kept, and the ``carry`` columns.

    ``spans`` (array of struct<start, length>) are the maximal runs of removed bytes of the UTF-8 text,
    ``kept`` is the binary rest. A null text counts as empty. Equal ids are not smaller than each other;
    a null id is larger than any other. Texts shorter than ``window`` stay whole. Other columns are left
    out unless carried; a carried column named like a result column is left out too.
    At most ``window - gram + 1`` <= 64 windows share an anchor, whose starts fit one mask.
    """
    starts = window - gram + 1
    if starts > 64 or window > 250:
        raise ValueError("window - gram must be under 64 and window at most 250")
    own = [id_col, "n_bytes", "n_removed", "spans", "kept"]
    carry = [c for c in carry or [] if c not in own]
    packed, groups = pack(docs, id_col, text_col, carry)

    def make_anchors(block: Block) -> Anchors:
        return Anchors(np.frombuffer(block.text, np.uint8), block.bounds, block.ids, window, gram, groups)

    flagged = packed.join(repeated_anchors(packed, make_anchors), "block", "left")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for row in batch.to_pylist():
                block, _, reads = _windows_of(row, groups, window, gram)
                rows = [
                    {
                        "part": part,
                        "block": row["block"],
                        "docs": reads.doc_id[at].tobytes(),
                        "left": reads.left[at].astype(np.uint8).tobytes(),
                        "lengths": reads.length[at].astype(np.uint8).tobytes(),
                        "data": squeeze.compress(
                            b"".join(
                                block.text[a : a + n]
                                for a, n in zip(reads.first[at].tolist(), reads.length[at].tolist())
                            )
                        ),
                    }
                    for part, at in reads.by_group()
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=sent_arrow)

    sent_arrow = pa.schema(
        [("part", pa.int32()), ("block", pa.int64())] + [(n, pa.binary()) for n in ("docs", "left", "lengths", "data")]
    )
    sent = flagged.select("block", "ids", "null_ids", "lengths", "data", "flags").mapInArrow(
        send, "part int, block long, docs binary, left binary, lengths binary, data binary"
    )

    def build(key: tuple, group: pa.Table) -> pa.Table:
        opener = zstandard.ZstdDecompressor()
        lengths = [np.frombuffer(v.as_py(), np.uint8) for v in group.column("lengths")]
        size = np.concatenate(lengths).astype(np.int64)
        docs_of = np.concatenate([np.frombuffer(v.as_py(), np.int64) for v in group.column("docs")])
        left = np.concatenate([np.frombuffer(v.as_py(), np.uint8) for v in group.column("left")]).astype(np.int64)
        data = np.frombuffer(b"".join(opener.decompress(v.as_py()) for v in group.column("data")), np.uint8)
        begin = np.cumsum(size) - size
        width = starts - 1 + window
        columns = np.full((width, len(size)), PAD, np.uint8)
        for column in range(width):  # anchors stand in column starts - 1
            inside = column - (starts - 1) + left
            there = np.flatnonzero((inside >= 0) & (inside < size))
            columns[column, there] = data[begin[there] + inside[there]]
        mask = column_wise(columns, docs_of, window, starts)
        cuts = np.cumsum([len(n) for n in lengths])[:-1]
        masks = [m.tobytes() for m in np.split(mask, cuts)]
        return pa.table({"block": group.column("block"), "part": group.column("part"), "masks": pa.array(masks, pa.binary())})

    masks = (
        sent.groupBy("part")
        .applyInArrow(build, "block long, part int, masks binary")
        .groupBy("block")
        .agg(F.collect_list(F.struct("part", "masks")).alias("found"))
    )

    result = f"`{id_col}` long, n_bytes long, n_removed long, spans array<struct<start:int,length:int>>, kept binary"
    result = ", ".join([result, *(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema)])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, found, reads = _windows_of(row, groups, window, gram)
                mask = np.zeros(len(reads.one), np.uint64)
                sent_at = dict(reads.by_group())
                for one in row["found"] or []:
                    mask[sent_at[one["part"]]] = np.frombuffer(one["masks"], np.uint64)
                removed = _covered(found, reads, mask, starts, window, len(block.text))
                yield _result(block, removed, unpack_rest(row), own, carry)

    joined = flagged.join(materialize(masks), "block", "left")
    return joined.mapInArrow(remove, result)


def _covered(found: Anchors, reads: _Reads, mask: np.ndarray, starts: int, window: int, n: int) -> np.ndarray:
    """Which bytes of the block lie in a repeated window."""
    at = reads.at
    later = found.doc_id[at] > reads.doc_id[reads.read_of]
    left = found.position[at] - found.first[at]
    count = found.last[at] - found.first[at] + 1
    own = mask[reads.read_of]
    edge = np.zeros(n + 1, np.int32)
    for step in range(starts):
        # the window ``step`` bytes after the read's first one starts in column starts - 1 - left + step
        column = np.minimum(starts - 1 - left + step, 63).astype(np.uint64)
        hit = (step < count) & (later | ((own >> column) & np.uint64(1)).astype(bool))
        start = found.first[at][hit] + step
        np.add.at(edge, start, 1)
        np.add.at(edge, start + window, -1)
    return np.cumsum(edge[:n]) > 0


def _result(block: Block, removed: np.ndarray, rest: pa.Table, own: list[str], carry: list[str]) -> pa.RecordBatch:
    text = np.frombuffer(block.text, np.uint8)
    change = np.flatnonzero(np.diff(removed.astype(np.int8), prepend=0, append=0))
    # runs end where a document ends
    inner = block.bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(text))]
    split = inner[removed[inner] & removed[inner - 1]] if len(inner) else inner
    split = np.unique(split)
    begin = np.sort(np.concatenate([change[0::2], split]))
    end = np.sort(np.concatenate([change[1::2], split]))
    owner = np.searchsorted(block.bounds, begin, "right") - 1
    per_doc = np.searchsorted(owner, np.arange(len(block) + 1))
    size = np.diff(block.bounds)
    gone = np.concatenate([[0], np.cumsum(removed)])
    n_removed = gone[block.bounds[1:]] - gone[block.bounds[:-1]]
    kept = text[~removed].tobytes()
    offsets = block.bounds - gone[block.bounds]
    spans = pa.ListArray.from_arrays(
        pa.array(per_doc, pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(begin - block.bounds[owner], pa.int32()), pa.array(end - begin, pa.int32())], ["start", "length"]
        ),
    )
    arrays = [
        pa.array([block.doc_id(i) for i in range(len(block))], pa.int64()),
        pa.array(size, pa.int64()),
        pa.array(n_removed, pa.int64()),
        spans,
        pa.array([kept[a:b] for a, b in zip(offsets[:-1], offsets[1:])], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(
        arrays + [rest.column(c).combine_chunks() for c in carry], own + carry
    )
