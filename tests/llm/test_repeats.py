"""Suffix-array dedup and substring dedup against brute force."""

import re
from collections import Counter

import numpy as np
import pytest

from cellspark.llm import blocks, substring_dedup, suffix_dedup

LAST = 1 << 62


def brute(rows, split, size):
    """(id, symbols, covered flags) per row: windows that also start in a smaller document."""
    first = {}
    for doc, text in rows:
        unit = split(text)
        for at in range(len(unit) - size + 1):
            key = tuple(unit[at : at + size])
            first[key] = min(first.get(key, LAST), LAST if doc is None else doc)
    for doc, text in rows:
        unit = split(text)
        flags = bytearray(len(unit))
        for at in range(len(unit) - size + 1):
            if first[tuple(unit[at : at + size])] < (LAST if doc is None else doc):
                flags[at : at + size] = b"\1" * size
        yield doc, unit, flags


def bytes_expected(rows, size=50):
    for doc, unit, flags in brute(rows, lambda t: (t or "").encode(), size):
        kept = bytes(b for b, f in zip(unit, flags) if not f)
        spans = tuple((m.start(), m.end() - m.start()) for m in re.finditer(b"\1+", bytes(flags)))
        yield doc, len(unit), sum(flags), spans, kept


def words_expected(rows, size=50):
    for doc, unit, flags in brute(rows, lambda t: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()), size):
        yield doc, len(unit), sum(flags), b" ".join(w for w, f in zip(unit, flags) if not f).decode()


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def got_bytes(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in df.collect())


def got_words(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect())


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_bytes(table, request):
    df = request.getfixturevalue(table)
    found = suffix_dedup.repeated_bytes(df)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    assert got_bytes(found) == Counter(bytes_expected(texts(df)))


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_words(table, request):
    df = request.getfixturevalue(table)
    assert got_words(substring_dedup.repeated_words(df)) == Counter(words_expected(texts(df)))


def test_short_windows_over_many_blocks(documents, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(blocks, "GROUP_BYTES", 30_000)
    rows = texts(documents)
    found = suffix_dedup.repeated_bytes(documents.repartition(5), window=24, gram=8)
    assert got_bytes(found) == Counter(bytes_expected(rows, 24))
    found = substring_dedup.repeated_words(documents.repartition(5), length=8)
    assert got_words(found) == Counter(words_expected(rows, 8))


def test_carried_columns_stay_with_their_rows(odd):
    found = substring_dedup.repeated_words(odd, carry=["lang", "source", "n_words"], as_is=True)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept", "lang", "source"]
    given = Counter((r.doc_id, r.lang, r.source) for r in odd.collect())
    assert Counter((r.doc_id, r.lang, r.source) for r in found.collect()) == given
    same = {r.text or "" for r in odd.collect()}
    assert all(r.kept in same for r in found.filter("n_removed = 0").collect())


def test_empty_tables(nothing):
    assert suffix_dedup.repeated_bytes(nothing).count() == 0
    assert substring_dedup.repeated_words(nothing).count() == 0


def test_chunks_do_not_change_anchors(monkeypatch):
    rng = np.random.default_rng(5)
    symbols = rng.integers(97, 100, 5000).astype(np.uint8)
    bounds = np.array([0, 30, 30, 2000, 5000])
    whole = blocks.anchors(symbols, bounds, 50, 16)
    starts = {s: h for h, _, a, b in zip(*whole) for s in range(a, b + 1)}
    assert sorted(starts) == [*range(30, 2000 - 49), *range(2000, 5000 - 49)]
    monkeypatch.setattr(blocks, "CHUNK", 333)
    cut = blocks.anchors(symbols, bounds, 50, 16)
    assert starts == {s: h for h, _, a, b in zip(*cut) for s in range(a, b + 1)}


def test_columns_equal_sorted_suffixes():
    rng = np.random.default_rng(3)
    width, n, window, starts = 14, 60, 8, 7
    columns = rng.integers(97, 99, (width, n)).astype(np.uint8)
    for read in range(n):  # pads at both ends
        columns[: rng.integers(0, 4), read] = suffix_dedup.PAD
        end = rng.integers(0, 4)
        columns[width - end :, read] = suffix_dedup.PAD
    docs = rng.integers(0, 40, n)
    mask = suffix_dedup.column_wise(columns, docs, window, starts)
    for start in range(starts):
        strings = [bytes(columns[start : start + window, r]) for r in range(n)]
        for r in range(n):
            sound = suffix_dedup.PAD not in strings[r]
            smaller = any(docs[o] < docs[r] and strings[o] == strings[r] for o in range(n))
            assert bool(int(mask[r]) >> start & 1) == (sound and smaller)
