"""Packing documents into sequences of at most ``capacity`` tokens by bin completion.

Every document is its token ids and an end id. Only documents over the capacity are cut, into full
pieces and a rest. Which lengths share a sequence is decided on the histogram of piece lengths, which has
at most ``capacity`` entries however many documents there are; pieces of one length are alike.

Plain best fit over the histogram is the first incumbent, least-waste fillings around the largest remaining length
the second. If neither is at the lower bound, a depth-first search branches over the undominated fillings around the
largest remaining length, each as often as the counts allow or once. A filling is dominated if a piece outside can take the
place of pieces inside that are no longer together, within the room left. A branch is left if its waste together with
what is placed already cannot give fewer sequences than the incumbent. The search ends at the lower bound, or after
``nodes`` looks with the best incumbent so far.

The plan is rows (length, ranks from, sequences from, offset). Pieces are numbered inside their length in
buckets, so a length that a third of all documents have is spread over many tasks.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellspark.llm.common import ship
from cellspark.llm.harmonic import byte_of_symbol
from cellspark.plans.scale import materialize

CAPACITY = 4096
END_ID = 1
#: Branches that are looked at for one sequence.
BRANCHES = 4000
#: Fillings and lengths that are looked at in the search over whole plans, all its nodes together.
NODES = 100_000
#: Pieces of one length that are numbered in one window, about.
SHARE = 1_000_000
#: Plans of at most so many lengths remember the counts they have been at.
REMEMBERED = 64
#: Distinct words of a generation whose ids a worker remembers, and the longest word that is remembered.
MEMORY = 300_000
LONGEST = 64
#: Texts whose words are in memory at once.
TEXTS = 128
#: Marks that end a word; each is a token of its own after letters.
MARKS = ".,;:!?"
#: Words whose parts are known without the tokenizer: no white space inside, equal after normalization but for case.
LATIN = re.compile("[!-~\u00a1-\u00ac\u00ae-\u00ff]+")
#: Their parts, in lower case: letters, single digits and fractions, all else.
_LETTERS, _NUMBERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")
#: How tokenizer files of that kind prepare a text.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


class _Ids(dict):
    """Words to their token ids as little-endian 32-bit numbers.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words;
    those of a word of letters and one mark are those of the two. Words are remembered in two generations,
    so that memory is bounded and frequent words stay.
    """

    def __init__(self, path: str):
        super().__init__({"": b""})
        self.older: dict[str, bytes] = {}
        self.path = path
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self.fast = _merger(given)
        # words are ordinary text; where a text has an added token's string, it is cut before
        self.added = {token["content"]: token["id"] for token in given.get("added_tokens") or ()}
        self.cut = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})") if self.added else None
        vocabulary = given["model"]["vocab"] if self.fast else self.tokenizer.get_vocab()
        suffix = given["model"].get("end_of_word_suffix")
        self.last = np.zeros(max([*vocabulary.values(), *self.added.values()]) + 1, bool)
        if suffix:
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    @cached_property
    def tokenizer(self):
        """Loaded for the first word that ``fast`` does not take."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as the tokenizer gives them."""
        if not any(token in t for t in texts for token in self.added):
            return self._encode(texts)
        cut = [self.cut.split(t) for t in texts]
        ids = iter(self._encode([part for parts in cut for part in parts[::2]]))
        whole = []
        for parts in cut:
            # every other part is an added token
            tokens = [np.array([self.added[t]], "<u4").tobytes() for t in parts[1::2]]
            whole.append(next(ids) + b"".join(token + next(ids) for token in tokens))
        return whole

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [_latin_lower(t).replace("\n", " ").split(" ") for t in texts]
        known = [list(map(self.get, words)) for words in split]
        new = {
            w for words, ids in zip(split, known) if None in ids for w, found in zip(words, ids) if found is None
        }
        if len(self) + 2 * len(new) > MEMORY:
            self.older = dict(self)
            self.clear()
            self[""] = b""
        learned = self._learn(new) if new else {}
        for words, ids in zip(split, known):
            if None in ids:
                ids[:] = [learned[w] if found is None else found for w, found in zip(words, ids)]
        return [b"".join(ids) for ids in known]

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """Ids of the new words; those that are not too long are remembered."""
        ids_of: dict[str, bytes] = {}
        if self.fast:
            if self.older:
                ids_of = {w: ids for w in new if (ids := self.older.get(w))}
                new = new.difference(ids_of)
            latin = [w for w in new if len(w) <= LONGEST and (w.isascii() and w.isalpha() or LATIN.fullmatch(w))]
            for at in range(0, len(latin), 1024):
                self._merge(latin[at : at + 1024], ids_of)
            new = new.difference(latin) if len(latin) < len(new) else ()
        marked = [w for w in new if w[-1] in MARKS and _letters(w[:-1])]
        whole = set(new).difference(marked)
        whole.update([w[:-1] for w in marked], [w[-1] for w in marked])
        plain, other = [], []
        for word in whole:
            known = self.get(word) or self.older.get(word)
            if known:
                ids_of[word] = known
            else:
                (plain if len(word) <= LONGEST and _letters(word) else other).append(word)
        for at in range(0, len(plain), 1000):
            part = plain[at : at + 1000]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            if not self._cut(ids, part, np.arange(len(part)), ids_of):  # not a word each after all
                other += part
        for at in range(0, len(other), 1000):
            part = other[at : at + 1000]
            for word, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                ids_of[word] = np.array(found.ids, "<u4").tobytes()
        for word in marked:
            ids_of[word] = ids_of[word[:-1]] + ids_of[word[-1]]
        self.update((w, ids) for w, ids in ids_of.items() if len(w) <= LONGEST)
        return ids_of

    def _merge(self, words: list[str], ids_of: dict[str, bytes]) -> None:
        """Adds the ids of words of ``LATIN``."""
        parts = [[w.lower()] if w.isalpha() else PARTS.findall(w.lower()) for w in words]
        text = " ".join(itertools.chain.from_iterable(parts)) + " "
        ids = self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")
        if not self._cut(ids, words, np.cumsum([*map(len, parts)]) - 1, ids_of):
            raise ValueError("the parts of the words are not those of their ids")

    def _cut(self, ids: np.ndarray, words: list[str], last: np.ndarray, ids_of: dict[str, bytes]) -> bool:
        """Adds each word's share of ``ids``; ``last`` numbers its last part. False if there are more or fewer parts."""
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != last[-1] + 1:
            return False
        data, begin = ids.tobytes(), 0
        for word, end in zip(words, (4 * ends[last]).tolist()):
            ids_of[word] = data[begin:end]
            begin = end
        return True


def _merger(given: dict):
    """A file's vocabulary in ``tiktoken``, for parts that a space follows; None if the file is of another kind.

    Merges are by id there, so a merge's id has to grow with its place. A space, which no part holds, stands for the
    end of a word: with the last byte it is a token whose id is before those of all merges.
    """
    model, suffix = given["model"], given["model"].get("end_of_word_suffix")
    if given.get("normalizer") != NORMALIZER or given.get("pre_tokenizer") != PRE_TOKENIZER:
        return None
    if model.get("type") != "BPE" or not suffix:
        return None
    if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
        return None
    symbols, vocabulary = byte_of_symbol(), model["vocab"]
    plain = str.maketrans({c: chr(b) for c, b in symbols.items()})
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if sorted(vocabulary.values()) != list(range(2 * len(symbols) + len(pairs))):
        return None
    if any(vocabulary.get(a + b) != i for i, (a, b) in enumerate(pairs, 2 * len(symbols))):
        return None
    if any(vocabulary.get(c + end, len(vocabulary)) >= 2 * len(symbols) for c in symbols for end in ("", suffix)):
        return None

    import tiktoken

    ranks = {}
    for token, i in vocabulary.items():
        inside = token.removesuffix(suffix)
        raw = inside.translate(plain).encode("latin-1")
        if b" " not in raw:
            ranks[raw + b" " * (inside != token)] = i
    return tiktoken.Encoding("given", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})


def _letters(word: str) -> bool:
    """One token run of letters, also after lower-casing (which can split off a mark)."""
    return word.isalpha() and (word.isascii() or word.lower().isalpha())


def _latin_lower(text: str) -> str:
    """Lower case where that is exactly what the tokenizer does first; else the text."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text.lower()


def pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """id_col, piece, start, length, ids_crc32 (and ids as little-endian 32-bit numbers) per piece."""
    ship(docs.sparkSession)
    state: list[_Ids] = []
    names = [id_col, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.append(_Ids(tokenizer))
        end = np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                rows: list[list] = [[] for _ in names]
                for doc, ids in zip(batch.column(0).to_pylist(), state[0].encode(texts)):
                    ids += end
                    for number, start in enumerate(range(0, len(ids), capacity * 4)):
                        piece = ids[start : start + capacity * 4]
                        row = (doc, number, start // 4, len(piece) // 4, zlib.crc32(piece), piece)
                        for column, value in zip(rows, row):
                            column.append(value)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names)

    columns = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = f"`{id_col}` long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return columns.mapInArrow(run, schema)


def best_filling(lengths: list[int], counts: dict[int, int], room: int, branches: int = BRANCHES) -> list[int]:
    """Lengths (largest first, repeats allowed up to their counts) that fill ``room`` with least waste.

    ``lengths`` ascend and have counts over zero. Exact unless more than ``branches`` are looked at.
    """
    best: list[tuple[int, int]] = []
    waste, at = room, len(lengths)
    # the first incumbent is best fit: the largest length that fits, again and again
    while (at := bisect_right(lengths, waste, 0, at)) > 0:
        length = lengths[at - 1]
        take = min(counts[length], waste // length)
        best.append((length, take))
        waste -= take * length
        at -= 1
    if waste and branches:
        seen = 0
        in_all = [0]  # what the first k lengths can fill at most
        for length in lengths[: bisect_right(lengths, room)]:
            in_all.append(in_all[-1] + min(counts[length], room // length) * length)

        def extend(rest: int, at: int, chosen: list[tuple[int, int]]) -> None:
            nonlocal waste, best, seen
            if rest < waste:
                waste, best = rest, list(chosen)
            for k in range(bisect_right(lengths, rest, 0, at), 0, -1):
                if not waste or seen >= branches or rest - in_all[k] >= waste:
                    return
                length = lengths[k - 1]
                for take in range(min(counts[length], rest // length), 0, -1):
                    seen += 1
                    extend(rest - take * length, k - 1, [*chosen, (length, take)])

        extend(room, len(in_all) - 1, [])
    return [length for length, take in best for _ in range(take)]


def undominated(
    lengths: list[int], counts: dict[int, int], room: int, most_waste: int, branches: int = BRANCHES
) -> list[list[int]]:
    """Fillings of ``room`` that waste at most ``most_waste`` and that no other one dominates, least waste first.

    ``lengths`` ascend and have counts over zero. All of them unless more than ``branches`` are looked at.
    """
    return _undominated(lengths, counts, room, most_waste, branches)[0]


def _undominated(
    lengths: list[int], counts: dict[int, int], room: int, most_waste: int, branches: int
) -> tuple[list[list[int]], int]:
    found: list[tuple[int, list[tuple[int, int]]]] = []
    fitting = lengths[: bisect_right(lengths, room)]
    in_all = [0]  # what the first k lengths can fill at most
    for length in fitting:
        in_all.append(in_all[-1] + min(counts[length], room // length) * length)
    seen = 0
    there = 0  # bit n: there is a piece of length n
    for n in fitting:
        there |= 1 << n

    def extend(rest: int, at: int, chosen: list[tuple[int, int]]) -> None:
        nonlocal seen
        outside = there
        for n, take in chosen:
            outside ^= (counts[n] == take) << n
        if rest <= most_waste and not _dominated(outside, rest, chosen):
            found.append((rest, chosen))
        for k in range(bisect_right(fitting, rest, 0, at), 0, -1):
            if seen >= branches or rest - in_all[k] > most_waste:
                return
            length = fitting[k - 1]
            for take in range(min(counts[length], rest // length), 0, -1):
                seen += 1
                extend(rest - take * length, k - 1, [*chosen, (length, take)])

    extend(room, len(fitting), [])
    found.sort(key=lambda f: (f[0], [(-n, -take) for n, take in f[1]]))
    return [[n for n, take in chosen for _ in range(take)] for _, chosen in found], seen


def _dominated(outside: int, rest: int, chosen: list[tuple[int, int]]) -> bool:
    """Whether a piece outside can replace pieces inside (or none) whose sum it exceeds by at most ``rest``.

    Bit n of ``outside`` tells whether a piece of length n is left.
    """
    if outside & ((2 << rest) - 2):
        return True  # it fits beside them
    # bit t: pieces inside sum to t; all sums, and those of two pieces or more
    sums, several = 1, 0
    for n, take in chosen:
        for _ in range(take):
            several |= (several << n) | ((sums & ~1) << n)
            sums |= sums << n
    reach, width = sums << 1, 1  # a longer piece by 1 to ``rest``
    while width < rest:
        step = min(width, rest - width)
        reach |= reach << step
        width += step
    return bool(outside & several) or bool(rest and outside & reach)


def least_sequences(histogram: dict[int, int], capacity: int) -> int:
    """No plan takes fewer: all tokens, or pieces longer than a limit that cannot share, and what they leave no room for."""
    lengths = sorted(n for n, c in histogram.items() if c > 0)
    number, tokens = [0], [0]  # of the pieces of the first k lengths
    for n in lengths:
        number.append(number[-1] + histogram[n])
        tokens.append(tokens[-1] + histogram[n] * n)
    half = bisect_right(lengths, capacity // 2)
    best = -(-tokens[-1] // capacity)
    for limit in {min(n, capacity - n) for n in lengths}:
        # pieces over capacity - limit stand without those of limit or more; those over half have one each
        alone, small = max(half, bisect_right(lengths, capacity - limit)), bisect_left(lengths, limit)
        room = (number[alone] - number[half]) * capacity - (tokens[alone] - tokens[half])
        rest = tokens[half] - tokens[min(small, half)]
        best = max(best, number[-1] - number[half] + max(0, -(-(rest - room) // capacity)))
    return best


def fillings(
    histogram: dict[int, int], capacity: int, branches: int = BRANCHES, nodes: int = NODES
) -> list[tuple[int, list[int]]]:
    """(times, lengths of one sequence) so that every piece is in one sequence."""

    def greedy(limit: int) -> list[tuple[int, list[int]]]:
        counts = {n: c for n, c in histogram.items() if c > 0}
        lengths = sorted(counts)
        plan = []
        while lengths:
            largest = lengths[-1]
            counts[largest] -= 1
            available = lengths if counts[largest] else lengths[:-1]
            chosen = best_filling(available, counts, capacity - largest, limit)
            counts[largest] += 1
            lot = [largest, *chosen]
            need = {n: lot.count(n) for n in set(lot)}
            times = min(counts[n] // m for n, m in need.items())
            for n, m in need.items():
                counts[n] -= m * times
            lengths = [n for n in lengths if counts[n]]
            plan.append((times, lot))
        return plan

    floor = least_sequences(histogram, capacity)
    plan = greedy(0)
    if _sequences(plan) > floor:
        plan = min(plan, greedy(branches), key=_sequences)
    if _sequences(plan) > floor:
        plan = _complete(histogram, capacity, plan, floor, branches, nodes)
    return plan


def _sequences(plan: list[tuple[int, list[int]]]) -> int:
    return sum(times for times, _ in plan)


def _complete(
    histogram: dict[int, int], capacity: int, plan: list[tuple[int, list[int]]], floor: int, branches: int, nodes: int
) -> list[tuple[int, list[int]]]:
    """Bin completion: the best plan that the search finds, or the given one if that is not beaten."""
    counts = {n: c for n, c in histogram.items() if c > 0}
    rest, used, best = sum(n * c for n, c in counts.items()), 0, _sequences(plan)
    reached: dict[tuple, int] = {}

    def moves() -> Iterator[tuple[int, list[int], dict[int, int]]]:
        """(times, lengths, number of each) of the next sequences, from the counts as they are now."""
        nonlocal nodes
        lengths = sorted(n for n, c in counts.items() if c)
        if len(lengths) <= REMEMBERED:
            state = tuple((n, counts[n]) for n in lengths)
            if reached.get(state, best) <= used:
                return
            reached[state] = used
        # what may still be wasted if a sequence is to be saved
        waste = (best - 1 - used) * capacity - rest
        if waste < 0:
            return
        largest = lengths[-1]
        left = {**counts, largest: counts[largest] - 1}
        available = lengths if left[largest] else lengths[:-1]
        some, seen = _undominated(available, left, capacity - largest, waste, min(branches, nodes))
        nodes -= seen + len(lengths)
        for chosen in some:
            lot = [largest, *chosen]
            need = {n: lot.count(n) for n in set(lot)}
            most = min(counts[n] // m for n, m in need.items())
            for times in {most: 0, 1: 0}:
                yield times, lot, need

    path: list[tuple[int, list[int], dict[int, int]]] = []
    levels = [moves()]
    while levels and nodes > 0 and best > floor:
        move = next(levels[-1], None)
        if move is None:
            levels.pop()
            if path:
                times, lot, need = path.pop()
                used, rest = used - times, rest + times * sum(lot)
                for n, m in need.items():
                    counts[n] += m * times
            continue
        times, lot, need = move
        path.append(move)
        used, rest = used + times, rest - times * sum(lot)
        for n, m in need.items():
            counts[n] -= m * times
        if not rest and used < best:
            best, plan = used, [(t, list(made)) for t, made, _ in path]
        levels.append(moves() if rest else iter(()))
    return plan


def _plan(capacity: int, branches: int, nodes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lot in batch.column(0).to_pylist():
                taken: dict[int, int] = {}
                rows: dict[int, list] = {}
                sequence = 0
                for times, lengths in fillings({e["length"]: e["n"] for e in lot or []}, capacity, branches, nodes):
                    offset = 0
                    for length in lengths:
                        rows.setdefault(length, []).append((taken.get(length, 0), sequence, offset))
                        taken[length] = taken.get(length, 0) + times
                        offset += length
                    sequence += times
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(rows), pa.int64())]
                    + [pa.array([[r[i] for r in v] for v in rows.values()], pa.list_(pa.int64())) for i in range(3)],
                    ["length", "ranks", "sequences", "offsets"],
                )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    branches: int = BRANCHES,
    nodes: int = NODES,
    with_ids: bool = False,
) -> DataFrame:
    """id_col, piece, start, length, ids_crc32, sequence_id, offset (and ids): one row per piece.

    A null or empty text is one piece, the end id alone. Rows with equal or null ids are documents of
    their own. No document, no row. All other columns are left out.
    """
    cut = materialize(pieces(docs, tokenizer, id_col, text_col, capacity, end_id, with_ids))
    histogram = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    whole = histogram.agg(F.collect_list(F.struct("length", "n")).alias("lot"))  # at most ``capacity`` entries
    plan = whole.mapInArrow(
        _plan(capacity, branches, nodes), "length long, ranks array<long>, sequences array<long>, offsets array<long>"
    )
    # a window holds about ``SHARE`` pieces of one length at most, however many there are
    shares = max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), cut.count() // SHARE)
    order = [id_col, "piece", "ids_crc32"]
    dealt = cut.withColumn("_share", F.pmod(F.xxhash64(*order), F.lit(shares)))
    sizes = dealt.groupBy("length", "_share").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_share").orderBy(*order)
    ranked = (
        dealt.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(offsets, ["length", "_share"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
    )
    # the plan has at most a row per length, and each filling uses up a length: its size has a bound
    placed = ranked.join(F.broadcast(plan), "length")
    at = F.size(F.filter("ranks", lambda r: r <= F.col("_rank"))) - 1
    return placed.select(
        id_col,
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequences")[at] + F.col("_rank") - F.col("ranks")[at]).alias("sequence_id"),
        F.col("offsets")[at].alias("offset"),
        *(["ids"] * with_ids),
    )
