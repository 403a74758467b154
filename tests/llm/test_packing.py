"""Best-fit packing: every piece in one place, ids as the tokenizer gives them, few sequences."""

import itertools
import json
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cellspark.llm import packing
from cellspark.llm.harmonic import byte_of_symbol
from cellspark.llm.queries import TOKENIZER

IDS, TOKENS = packing._Ids(TOKENIZER), Tokenizer.from_file(TOKENIZER)


def check(spark_rows, docs, capacity):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = []
    for doc, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for number, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            expected.append((doc, number, start, len(part), zlib.crc32(part.tobytes())))
    rows = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in spark_rows]
    assert sorted(rows, key=str) == sorted(expected, key=str)
    for _, group in itertools.groupby(sorted(spark_rows, key=lambda r: (r.sequence_id, r.offset)), lambda r: r.sequence_id):
        end = 0
        for r in group:
            assert r.offset == end
            end += r.length
        assert end <= capacity
    return len({r.sequence_id for r in spark_rows}), -(-sum(r.length for r in spark_rows) // capacity)


@pytest.mark.parametrize(("table", "capacity"), [("documents", 4096), ("documents", 300), ("odd", 4096)])
def test_pack(table, capacity, request):
    df = request.getfixturevalue(table)
    found = packing.pack(df, TOKENIZER, capacity=capacity).collect()
    used, bound = check(found, [(r.doc_id, r.text) for r in df.collect()], capacity)
    assert used <= bound + 2


def test_ids_come_along(odd):
    for r in packing.pack(odd, TOKENIZER, with_ids=True).collect():
        assert len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32


def test_empty(nothing):
    assert packing.pack(nothing, TOKENIZER).count() == 0


def test_words_give_the_ids_of_the_text():
    texts = ["Don't  stop\tnow\r\nor ever end", "é ́x İ ΣΣ", "a" * 500, "<|endoftext|> x", "a <|endoftext|> b"]
    texts += ["x<|endoftext|><|startoftext|>Y, <|ENDOFTEXT|>", "<|endoftext|>", "don<|endoftext|>'t <|endof\ntext|>"]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert packing._Ids(TOKENIZER).encode(texts) == expected


def test_a_known_kind_of_file_needs_no_tokenizer_for_latin_words():
    """Every token's own string, and words of all parts: the same ids from the merges alone."""
    tokens = [t.removesuffix("</w>") for t in TOKENS.get_vocab(with_added_tokens=False)]
    symbols = byte_of_symbol()
    words = [bytes(symbols[c] for c in t).decode("latin-1") for t in tokens] + ["a's", "it've5\u00bc%%%", "B\u00aa\u00b2x\u00d7"]
    texts = [" ".join(words[at : at + 500]) for at in range(0, len(words), 500)]
    ids = packing._Ids(TOKENIZER)
    latin = [" ".join(w for w in t.split(" ") if packing.LATIN.fullmatch(w)) for t in texts]
    found = ids.encode(latin)
    assert "tokenizer" not in vars(ids)
    for some, of in ((found, latin), (ids.encode(texts), texts)):
        assert some == [np.array(TOKENS.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in of]


def test_another_kind_of_file_goes_through_the_tokenizer(tmp_path):
    given = json.loads(TOKENS.to_str())
    given["normalizer"]["normalizers"].pop(0)
    (tmp_path / "other.json").write_text(json.dumps(given))
    texts = ["Don't  stop\tnow, 12\u00bc", "<|endoftext|> na\u00efve%%% x"]
    other = packing._Ids(str(tmp_path / "other.json"))
    assert other.fast is None and other.encode(texts) == IDS.encode(texts)


def test_words_of_the_documents(documents, monkeypatch):
    """Also when the memory of words overflows again and again."""
    monkeypatch.setattr(packing, "MEMORY", 3000)
    texts = [r.text for r in documents.collect()]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    ids = packing._Ids(TOKENIZER)
    assert [x for at in range(0, len(texts), 9) for x in ids.encode(texts[at : at + 9])] == expected


@given(st.lists(st.text(st.sampled_from("aB é́.,!?'s1Σσ İı\u212b\u00a0\n|ñ"), max_size=30), max_size=6))
@settings(max_examples=200, deadline=None)
def test_any_text(texts):
    assert IDS.encode(texts) == [np.array(TOKENS.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_filling_is_best():
    rng = random.Random(4)
    for _ in range(200):
        counts = {rng.randint(1, 20): rng.randint(1, 3) for _ in range(5)}
        room = rng.randint(1, 40)
        pool = [n for n, c in counts.items() for _ in range(c)]
        best = max(
            sum(s) for k in range(len(pool) + 1) for s in itertools.combinations(pool, k) if sum(s) <= room
        )
        found = packing.best_filling(sorted(counts), counts, room)
        assert sum(found) == best and all(found.count(n) <= counts[n] for n in found)


def test_many_small_pieces_need_no_deep_recursion():
    plan = packing.fillings({1: 5000, 3: 4000, 4095: 2}, 4096)
    used = {}
    for times, lengths in plan:
        assert sum(lengths) <= 4096
        for n in lengths:
            used[n] = used.get(n, 0) + times
    assert used == {1: 5000, 3: 4000, 4095: 2}
    assert sum(times for times, _ in plan) == 7


def fewest(pieces, capacity):
    """Sequences that are needed, by trying every place of every piece."""
    pieces = sorted(pieces, reverse=True)
    best = len(pieces)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(pieces):
            best = len(rooms)
            return
        for at, room in enumerate(rooms):
            if room >= pieces[i] and room not in rooms[:at]:
                place(i + 1, [*rooms[:at], room - pieces[i], *rooms[at + 1 :]])
        place(i + 1, [*rooms, capacity - pieces[i]])

    place(0, [])
    return best


def test_a_plan_goes_back_on_its_first_filling():
    lengths = [59, 56, 45, 42, 38, 30, 25, 24, 24, 23, 21, 10]
    plan = packing.fillings({n: lengths.count(n) for n in lengths}, 100)
    assert sum(times for times, _ in plan) == 4
    assert sorted(n for times, lot in plan for n in lot * times) == sorted(lengths)


def test_plans_are_as_short_as_any():
    rng = random.Random(6)
    searched = 0
    for _ in range(400):
        capacity = rng.choice([30, 100])
        pool = [rng.randint(1, capacity) for _ in range(rng.randint(1, 6))]
        pieces = [rng.choice(pool) if rng.random() < 0.4 else rng.randint(capacity // 8, capacity // 2) for _ in range(10)]
        histogram = {n: pieces.count(n) for n in pieces}
        plan = packing.fillings(histogram, capacity)
        assert sorted(n for times, lot in plan for n in lot * times) == sorted(pieces)
        assert all(sum(lot) <= capacity for _, lot in plan)
        least = fewest(pieces, capacity)
        assert packing.least_sequences(histogram, capacity) <= least == sum(times for times, _ in plan)
        searched += least < sum(times for times, _ in packing.fillings(histogram, capacity, 0, 0))
    assert searched > 3


def test_undominated_fillings():
    """Of all fillings, those that no swap of a longer piece for pieces inside improves."""
    rng = random.Random(7)
    for _ in range(200):
        counts = {rng.randint(1, 20): rng.randint(1, 2) for _ in range(5)}
        room = rng.randint(1, 40)
        found = packing.undominated(sorted(counts), counts, room, room)
        expected = []
        pool = sorted(n for n, c in counts.items() for _ in range(c))
        subsets = {s for k in range(len(pool) + 1) for s in itertools.combinations(pool, k) if sum(s) <= room}
        for s in subsets:
            inside = {t for k in range(len(s) + 1) for t in itertools.combinations(s, k)}
            outside = [n for n in counts if counts[n] > s.count(n)]
            worse = any(
                sum(t) <= n <= sum(t) + room - sum(s) and (n > sum(t) or len(t) > 1) for t in inside for n in outside
            )
            if not worse:
                expected.append(sorted(s, reverse=True))
        assert sorted(found) == sorted(expected)
        assert [sum(f) for f in found] == sorted((sum(f) for f in found), reverse=True)
