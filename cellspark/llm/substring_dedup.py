"""Substring dedup by level-wise doubling.

Words that lie in a run of ``length`` words which also starts in a document with a smaller id are
removed. Windows are looked at level by level: those of half the length that occur in one document only are out at
once, the others are extended to twice that length, where those that are repeated again are what is
removed (a longer repeat removes nothing that these do not, so the doubling ends there). On the first
level only the window with the smallest hash in each run of ``length`` words stands for the run (see
``blocks``); every longer window is extended from the one it chose, so none is missed. Documents are blocks in the sense of ``blocks``; a window is
identified by 64 bits of its own hash and at least 32 of the hash it was extended from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.llm.blocks import Anchors, Block, pack, repeated_anchors, rolling_hash, unpack_rest
from cellspark.plans.scale import materialize

LENGTH = 50
#: Words whose hashes a worker remembers.
MEMORY = 1 << 18


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


class _Words:
    """The words of a block as hashes, with the documents' offsets among them."""

    def __init__(self, block: Block):
        hashes = _WordHashes()
        self.words = [block.document(i).split() for i in range(len(block))]
        self.bounds = np.concatenate([[0], np.cumsum([len(w) for w in self.words])]).astype(np.int64)
        self.hashes = np.fromiter(
            (hashes[w] for words in self.words for w in words), np.uint64, int(self.bounds[-1])
        )


class _Windows:
    """The distinct candidate windows of a block: those that extend a repeated shorter window."""

    def __init__(self, words: _Words, found: Anchors, at: np.ndarray, length: int):
        count = found.last[at] - found.first[at] + 1
        which = np.repeat(np.arange(len(at)), count)
        step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        self.start = found.first[at][which] + step
        hashes = rolling_hash(words.hashes, length) if len(self.start) else np.empty(0, np.uint64)
        key = hashes[self.start]
        group = found.group[at][which]
        parent = (found.hash[at][which] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        doc = found.doc_id[at][which]
        order = np.lexsort((doc, key, group))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (key[order][1:] != key[order][:-1]) | (group[order][1:] != group[order][:-1])
        self.window_of = np.empty(len(order), np.int64)
        self.window_of[order] = np.cumsum(fresh) - 1
        one = order[fresh]
        self.key, self.parent, self.doc_id, self.group = key[one], parent[one], doc[one], group[one]
        self.later = doc > self.doc_id[self.window_of]

    def by_group(self) -> Iterator[tuple[int, slice]]:
        cuts = np.flatnonzero(np.r_[True, self.group[1:] != self.group[:-1]]) if len(self.group) else []
        for a, b in zip(cuts, [*cuts[1:], len(self.group)]):
            yield int(self.group[a]), slice(int(a), int(b))


def _not_first(key: tuple, group: pa.Table) -> pa.Table:
    """One bit per window: it also starts in a smaller document of another block."""
    def column(name, kind):
        return [np.frombuffer(v.as_py(), kind) for v in group.column(name)]

    keys = column("keys", np.uint64)
    key, parent, doc = np.concatenate(keys), np.concatenate(column("parents", np.uint32)), np.concatenate(column("docs", np.int64))
    order = np.lexsort((doc, parent, key))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (key[order][1:] != key[order][:-1]) | (parent[order][1:] != parent[order][:-1])
    least = doc[order][fresh][np.cumsum(fresh) - 1]
    hit = np.empty(len(order), bool)
    hit[order] = doc[order] > least
    bits = [np.packbits(h).tobytes() for h in np.split(hit, np.cumsum([len(k) for k in keys])[:-1])]
    return pa.table({"block": group.column("block"), "part": group.column("part"), "bits": pa.array(bits, pa.binary())})


def repeated_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    carry: list[str] | None = None,
    as_is: bool = False,
) -> DataFrame:
    """One row per input row: id_col, n_words, n_removed, kept, and the ``carry`` columns.

    Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage
    return, unchanged. ``kept`` are the kept words joined by one space; with ``as_is`` a text that loses nothing
    stays as it is instead. A null text has no words. Equal
    ids are not smaller than each other; a null id is larger than any other. Texts of fewer than
    ``length`` words stay whole. Other columns are left out unless carried; a carried column named like a
    result column is left out too. ``length`` must be even.
    """
    if length % 2 or length < 4:
        raise ValueError("length must be even and at least 4")
    own = [id_col, "n_words", "n_removed", "kept"]
    carry = [c for c in carry or [] if c not in own]
    packed, groups = pack(docs, id_col, text_col, carry)
    short = length // 2

    def anchors_of(block: Block) -> tuple[_Words, Anchors]:
        words = _Words(block)
        return words, Anchors(words.hashes, words.bounds, block.ids, length, short, groups)

    flagged = packed.join(repeated_anchors(packed, lambda block: anchors_of(block)[1]), "block", "left")

    def extended(row: dict) -> tuple[Block, _Words, _Windows]:
        block = Block(row)
        words, found = anchors_of(block)
        return block, words, _Windows(words, found, found.surviving(row["flags"]), length)

    sent_arrow = pa.schema(
        [("part", pa.int32()), ("block", pa.int64())] + [(n, pa.binary()) for n in ("keys", "parents", "docs")]
    )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, windows = extended(row)
                rows = [
                    {
                        "part": part,
                        "block": row["block"],
                        "keys": windows.key[at].tobytes(),
                        "parents": windows.parent[at].tobytes(),
                        "docs": windows.doc_id[at].tobytes(),
                    }
                    for part, at in windows.by_group()
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=sent_arrow)

    sent = flagged.select("block", "ids", "null_ids", "lengths", "data", "flags").mapInArrow(
        send, "part int, block long, keys binary, parents binary, docs binary"
    )
    hits = (
        sent.groupBy("part")
        .applyInArrow(_not_first, "block long, part int, bits binary")
        .groupBy("block")
        .agg(F.collect_list(F.struct("part", "bits")).alias("found"))
    )

    result = f"`{id_col}` long, n_words long, n_removed long, kept string"
    result = ", ".join([result, *(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema)])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, words, windows = extended(row)
                hit = np.zeros(len(windows.key), bool)
                sent_at = dict(windows.by_group())
                for one in row["found"] or []:
                    at = sent_at[one["part"]]
                    hit[at] = np.unpackbits(np.frombuffer(one["bits"], np.uint8), count=at.stop - at.start).astype(bool)
                start = windows.start[windows.later | hit[windows.window_of]]
                n = len(words.hashes)
                edge = np.zeros(n + 1, np.int32)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + length, -1)
                keep = np.cumsum(edge[:n]) == 0
                gone = np.concatenate([[0], np.cumsum(~keep)])
                kept = []
                for i, own_words in enumerate(words.words):
                    a, b = words.bounds[i], words.bounds[i + 1]
                    if gone[a] != gone[b]:
                        own_words = [w for w, k in zip(own_words, keep[a:b].tolist()) if k]
                    elif as_is:
                        kept.append(block.document(i))
                        continue
                    kept.append(b" ".join(own_words))
                rest = unpack_rest(row)
                arrays = [
                    pa.array([block.doc_id(i) for i in range(len(block))], pa.int64()),
                    pa.array(np.diff(words.bounds), pa.int64()),
                    pa.array(gone[words.bounds[1:]] - gone[words.bounds[:-1]], pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(
                    arrays + [rest.column(c).combine_chunks() for c in carry], own + carry
                )

    return flagged.join(materialize(hits), "block", "left").mapInArrow(remove, result)
