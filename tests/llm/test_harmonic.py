"""Harmonic packing against the tokenizer itself and the laws of a packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellspark.llm import harmonic

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, wanted, capacity):
    """Every id of every document in one piece, sequences gapless and of a size that is not padded."""
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    found = defaultdict(list)
    for (doc, tokens), pieces in by_doc.items():
        pieces.sort(key=lambda r: (r.start, r.ids))
        found[doc].extend((r.start, r.ids) for r in pieces)
        assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0 for r in pieces)
    for doc, texts in wanted.items():
        starts = sum((r.start == 0 for (d, _), p in by_doc.items() if d == doc for r in p))
        assert starts == len(texts)
        assert sum(len(ids) for _, ids in found[doc]) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for start, ids in found[doc]:
                assert start == at
                at += len(ids) // 4
            assert b"".join(ids for _, ids in found[doc]) == texts[0]
    assert set(found) == set(wanted)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
    return sequences


def ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


def test_documents(documents, tokenizer):
    rows = harmonic.pack(documents, PATH, with_ids=True).collect()
    wanted = {r.doc_id: [ids(tokenizer, r.text)] for r in documents.collect()}
    sequences = check(rows, wanted, 2048)
    tokens = sum(len(t[0]) // 4 for t in wanted.values())
    assert sum(length for places in sequences.values() for _, length in places) == tokens
    # a cut a sequence at most
    assert len(rows) <= len(wanted) + len(sequences)


@pytest.mark.parametrize("capacity", [1, 2, 16, 512])
def test_odd_rows(odd, tokenizer, capacity):
    rows = harmonic.pack(odd, PATH, capacity=capacity, with_ids=True).collect()
    wanted = defaultdict(list)
    for r in odd.collect():
        wanted[r.doc_id].append(ids(tokenizer, r.text))
    check(rows, wanted, capacity)


def test_special_tokens_and_long_runs(spark, tokenizer):
    texts = ["a <|endoftext|> b<|endoftext|>", "\n" * 1_000_000, "x" * 50_000, "  it's\t\t'S 123 !? ", "日本語 𝒳"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = harmonic.pack(docs, PATH, with_ids=True).collect()
    check(rows, {i: [ids(tokenizer, t)] for i, t in enumerate(texts)}, 2048)


def test_classes_hold_a_fixed_count():
    rng = random.Random(5)
    placed = []
    classes = harmonic.Classes(64, lambda *piece: placed.append(piece))
    lengths = [rng.choice([1, 2, 3, 31, 32, 33, 63, 64, 65, 500, rng.randint(1, 200)]) for _ in range(3000)]
    for document, length in enumerate(lengths):
        classes.add(document, 0, length)
        assert sum(n for waiting in classes.open.values() for _, _, n in waiting) < 64 * len(classes.open) + 1
    whole = classes.sequence
    counts, last = defaultdict(int), {}
    for _, start, n, sequence, _ in placed:
        counts[sequence] += 1
        last.setdefault(sequence, n)
    # the first piece of a sequence is never the cut one, so it names the class
    assert all(counts[s] == -(-64 // last[s]) for s in range(whole) if counts[s] > 1)
    classes.finish()
    assert sum(n for _, _, n, _, _ in placed) == sum(lengths)


def test_empty_and_refused(nothing):
    assert harmonic.pack(nothing, PATH).count() == 0
    with pytest.raises(ValueError):
        harmonic.pack(nothing, PATH, capacity=1000)
