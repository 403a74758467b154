"""Harmonic packing of documents into sequences of ``capacity`` tokens.

A piece of n tokens belongs to the class of the smallest k with k * n >= capacity: its length lies in
[capacity / k, capacity / (k - 1)). Each class has a sequence of its own, which is full with exactly k pieces;
what the last of them has beyond the capacity is cut off and, being shorter, goes on to its own class. Pieces of a
capacity or more (k = 1) fill sequences alone. So a sequence costs one cut at most and has no padding.

Workers pack independently: each fills the sequences of its own rows and at the end lays what its classes hold one
after the other, whole pieces first, into sequences whose sizes are powers of two, the ones a trainer does not pad.
There is no shuffle, and a worker holds less than a sequence for each class. Sequence ids carry the task's number,
so a task that is run again after a loss replaces its own sequences and no others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import ship

CAPACITY = 2048
END_ID = 1
#: Sequence ids of one task.
PER_TASK = 1 << 40


def byte_of_symbol() -> dict[str, int]:
    """Byte that each character of a byte-level vocabulary stands for: printable bytes are themselves, the others
    follow from 256 on in order (a fixed rule of such vocabularies)."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


# Fixed: how byte-level tokenizers cut text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevelIds:
    """Ids that a byte-level BPE tokenizer file gives.

    The file's vocabulary is loaded by ``tokenizers`` and run by ``tiktoken``, which merges by id, four times as
    fast with equal ids. Texts that it gives up on (very long runs of one kind) go to ``tokenizers`` itself, as
    do all texts if the file is of another kind.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer, decoders, models, pre_tokenizers

        self.slow = Tokenizer.from_file(path)
        self.fast = None
        added = {token.content: i for i, token in self.slow.get_added_tokens_decoder().items()}
        plain = isinstance(self.slow.model, models.BPE) and isinstance(self.slow.pre_tokenizer, pre_tokenizers.ByteLevel)
        if plain and self.slow.normalizer is None and isinstance(self.slow.decoder, decoders.ByteLevel):
            symbols = byte_of_symbol()
            vocabulary = self.slow.get_vocab(with_added_tokens=False)
            ranks = {bytes(symbols[c] for c in token): i for token, i in vocabulary.items() if token not in added}
            self.fast = tiktoken.Encoding("given", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added)

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
            except (ValueError, RuntimeError, RecursionError):
                pass
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


class Classes:
    """One worker's packing. ``place(piece, sequence, offset, length)`` is called for each final piece.

    A piece is (document, start, length); what is cut off keeps the document and a later start.
    """

    def __init__(self, capacity: int, place):
        self.capacity, self.place = capacity, place
        self.open: dict[int, list[tuple]] = {}
        self.sequence = 0

    def add(self, document, start: int, length: int) -> None:
        while length:
            k = -(-self.capacity // length)
            waiting = self.open.setdefault(k, [])
            if len(waiting) + 1 < k:
                waiting.append((document, start, length))
                return
            offset = 0
            for doc, at, n in waiting:
                self.place(doc, at, n, self.sequence, offset)
                offset += n
            waiting.clear()
            taken = self.capacity - offset
            self.place(document, start, taken, self.sequence, offset)
            self.sequence += 1
            start, length = start + taken, length - taken

    def finish(self) -> None:
        """Lay the rest into sequences of descending powers of two, all of them full."""
        rest = sorted((piece for waiting in self.open.values() for piece in waiting), key=lambda p: -p[2])
        self.open.clear()
        left = sum(n for _, _, n in rest)
        size = room = 0
        for doc, start, length in rest:
            while length:
                if not room:
                    size = room = min(self.capacity, 1 << (left.bit_length() - 1))
                taken = min(length, room)
                self.place(doc, start, taken, self.sequence, size - room)
                start, length, room, left = start + taken, length - taken, room - taken, left - taken
                self.sequence += not room


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset (and the ids, little-endian 32-bit numbers):
    one row per piece.

    ``capacity`` is a power of two. Every document ends with ``end_id``; a null or empty text is that id alone. Rows
    with equal or null ids are documents of their own, equal rows too. Long texts are one document of many pieces;
    a worker holds a text's ids until its last piece is placed. No document, no row. Other columns are left out.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    ship(docs.sparkSession)
    encoders: list[ByteLevelIds] = []
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 7 + [pa.binary()] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not encoders:
            encoders.append(ByteLevelIds(tokenizer))
        encode = encoders[0]
        first = TaskContext.get().partitionId() * PER_TASK
        end = np.array([end_id], "<u4")
        rows: list[tuple] = []

        def place(document, start, length, sequence, offset):
            doc, ids = document
            piece = ids[start : start + length].tobytes()
            rows.append((doc, start, length, zlib.crc32(piece), len(ids), first + sequence, offset, piece)[: len(names)])

        def placed():
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        classes = Classes(capacity, place)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate([encode(text.as_py() or ""), end])
                classes.add((doc, ids), 0, len(ids))
                if len(rows) >= 4096:
                    yield placed()
        classes.finish()
        if rows:
            yield placed()

    columns = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = (
        f"`{id_col}` long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
        + ", ids binary" * with_ids
    )
    return columns.mapInArrow(run, schema)
