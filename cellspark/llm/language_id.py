"""Language identification with interpolated Kneser-Ney character models.

A text becomes lower-case letters with one boundary symbol between words. For each language the grams of
``order`` symbols are counted over all labelled training rows, grouped per task before the shuffle; the
lower orders use continuation counts (how many different symbols precede a gram). Discounts come from the
counts of counts, and each gram's probability already has its lower orders interpolated.

The models of all languages are kept in sorted hash arrays: per order the sorted 64-bit hashes of the
grams beside a matrix of log probabilities (a column per language), and the same for the back-off weights
of contexts. A gram that a language has not stored backs off to its shorter form. A text goes to the
language with the lowest cross-entropy per symbol. Scores of grams are remembered per worker in a table of
fixed size.

Arrays of at most ``ENTRIES`` rows (over all languages and orders) are broadcast. A larger model stays in
written tables, whole: the distinct grams of the texts are joined with them, and the scores are summed per
text. No gram is dropped in either form, and both give the same scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.llm.blocks import mix, rolling_hash
from cellspark.llm.common import ship
from cellspark.plans.scale import lookup_join, materialize

ORDER = 4
#: Grams and contexts that are broadcast at most, over all languages and orders; a larger model is joined.
ENTRIES = 4_000_000
UNKNOWN = "und"
#: Texts with fewer letters are not rejected for their cross-entropy.
REJECT_LETTERS = 32
#: Share of the training rows of a language that may lie above its limit, and bits added to the limit.
REJECT_SHARE = 0.0005
REJECT_MARGIN = 2.0
_CHUNK = 1 << 20
#: Symbols that are scored at once.
_SCORED = 1 << 18
_NO_LETTER = 1e9

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Code point to its lower-case letter, 0 for what is no letter."""
    global _letters
    if _letters is None:
        _letters = np.zeros(0x110000, np.uint32)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                low = char.lower()
                _letters[code] = ord(low) if len(low) == 1 else code
    return _letters


def symbols(text: str | None, order: int) -> np.ndarray:
    """Letters as code points, 0 between words, at the end, and order - 1 times at the start."""
    if not text:
        return np.empty(0, np.uint32)
    codes = _letter_table()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    keep = codes != 0
    if not keep.any():
        return np.empty(0, np.uint32)
    keep[1:] |= codes[:-1] != 0  # the first non-letter after a letter is the boundary
    kept = codes[keep]
    end = np.zeros(1 if kept[-1] else 0, np.uint32)
    return np.concatenate([np.zeros(order - 1, np.uint32), kept, end])


def _hashes(codes: np.ndarray, order: int) -> np.ndarray:
    return rolling_hash(mix(codes.astype(np.uint64) + np.uint64(1)), order)


def _gram_text(codes: np.ndarray) -> list[str]:
    """Rows of code points as strings; the boundary is a space."""
    width = codes.shape[1]
    joined = np.where(codes == 0, 32, codes).astype("<u4").tobytes().decode("utf-32-le")
    return [joined[i : i + width] for i in range(0, len(joined), width)]


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}  # language -> [hashes, counts, grams as code points]
        waiting: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}

        def fold(lang: str) -> None:
            codes = np.concatenate(waiting.pop(lang))
            size[lang] = 0
            hashes = _hashes(codes, order)
            # grams that reach over the end of a text start in the padding of the next one
            ends = np.lib.stride_tricks.sliding_window_view(codes, order)
            inside = ~((ends[:, order - 1] == 0) & (ends[:, order - 2] == 0))
            at = np.flatnonzero(inside)
            found, first, counts = np.unique(hashes[at], return_index=True, return_counts=True)
            grams = ends[at[first]]
            if lang in held:
                old = held[lang]
                both, where = np.unique(np.concatenate([old[0], found]), return_inverse=True)
                total = np.bincount(where, np.concatenate([old[1], counts]), len(both)).astype(np.int64)
                names = np.empty((len(both), order), np.uint32)
                names[where] = np.concatenate([old[2], grams])
                held[lang] = [both, total, names]
            else:
                held[lang] = [found, counts, grams.copy()]

        def out(lang: str) -> pa.RecordBatch:
            _, counts, grams = held.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts)), pa.array(_gram_text(grams)), pa.array(counts, pa.int64())],
                ["lang", "gram", "n"],
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes = symbols(text.as_py(), order)
                for at in range(0, max(1, len(codes) - order + 1), _CHUNK) if len(codes) else ():
                    part = codes[at : at + _CHUNK + order - 1]
                    waiting.setdefault(lang, []).append(part)
                    size[lang] = size.get(lang, 0) + len(part)
                    if size[lang] >= _CHUNK:
                        fold(lang)
                        if len(held[lang][0]) > 500_000 or len(held) > 50:
                            yield out(lang)
        for lang in list(waiting):
            fold(lang)
        for lang in list(held):
            yield out(lang)

    return run


@dataclass
class Models:
    """Sorted hash arrays. ``grams[k]`` and ``contexts[k]`` are (hashes, matrix) of order k + 1.

    A model too large for arrays has empty ones and ``tables``: per order (gram, v) of grams and of contexts,
    where v is an array with an entry per language.
    """

    languages: list[str]
    order: int
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    base: np.ndarray  # log2 of the probability of any symbol, per language
    limits: dict[str, float] = field(default_factory=dict)
    tables: list[tuple[DataFrame, DataFrame]] | None = None


def _find(arrays: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, missing: float) -> np.ndarray:
    keys, values = arrays
    if not len(keys):
        return np.full((len(hashes), values.shape[1]), missing, np.float32)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where((keys[at] == hashes)[:, None], values[at], np.float32(missing))


def gram_scores(models: Models, codes: np.ndarray) -> np.ndarray:
    """log2 probability per language of the last symbol of each row of ``codes`` given the others."""
    spread = mix(codes.astype(np.uint64) + np.uint64(1))
    score = np.broadcast_to(models.base, (len(codes), len(models.languages))).astype(np.float32)
    for k in range(1, models.order + 1):
        own = _row_hash(spread[:, models.order - k :])
        weight = 0.0
        if k > 1:
            context = _row_hash(spread[:, models.order - k : -1])
            weight = _find(models.contexts[k - 2], context, 0.0)
        found = _find(models.grams[k - 1], own, np.nan)
        score = np.where(np.isnan(found), score + weight, found)
    return score


def _row_hash(spread: np.ndarray) -> np.ndarray:
    return rolling_hash(np.ascontiguousarray(spread).ravel(), spread.shape[1])[:: spread.shape[1]]


class _Scorer:
    def __init__(self, models: Models):
        self.models = models
        bits = 20
        while bits > 12 and (len(models.languages) << bits) > 1 << 23:
            bits -= 1
        self.shift = np.uint64(64 - bits)
        self.known = np.zeros(1 << bits, np.uint64)
        self.value = np.zeros((1 << bits, len(models.languages)), np.float32)

    def total(self, codes: np.ndarray) -> np.ndarray:
        """Sum of log2 probabilities per language."""
        order = self.models.order
        total = np.zeros(len(self.models.languages))
        for at in range(0, len(codes) - order + 1, _SCORED):
            part = codes[at : at + _SCORED + order - 1]
            hashes = _hashes(part, order)
            slots = (hashes >> self.shift).astype(np.int64)
            miss = np.flatnonzero(self.known[slots] != hashes)
            values = self.value[slots]
            if len(miss):
                _, first, where = np.unique(hashes[miss], return_index=True, return_inverse=True)
                at_new = miss[first]
                rows = np.lib.stride_tricks.sliding_window_view(part, order)[at_new]
                fresh = gram_scores(self.models, rows)
                values[miss] = fresh[where]
                self.known[slots[at_new]] = hashes[at_new]
                self.value[slots[at_new]] = fresh
            total += values.sum(axis=0, dtype=np.float64)
        return total


def _predict(models, order: int, text: str, carry: list[str], totals: str | None = None):
    state: list[_Scorer] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.append(_Scorer(models.value))
        scorer, known = state[0], models.value
        for batch in batches:
            names, scores, entropies, letters = [], [], [], []
            given = batch.column(totals).to_pylist() if totals else None
            for i, value in enumerate(batch.column(text)):
                codes = symbols(value.as_py(), order)
                count = int(np.count_nonzero(codes))
                letters.append(count)
                if not count or not known.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    entropies.append(None)
                    continue
                total = np.array(given[i]) if totals else scorer.total(codes)
                best = int(np.argmax(total))
                names.append(known.languages[best])
                scores.append(float(1 / np.exp2(np.maximum(total - total[best], -1000)).sum()))
                entropies.append(float(-total[best] / (len(codes) - order + 1)))
            rejected = [
                n == UNKNOWN or (c >= REJECT_LETTERS and e > known.limits.get(n, _NO_LETTER))
                for n, c, e in zip(names, letters, entropies)
            ]
            own = [
                pa.array(names, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array(entropies, pa.float64()),
                pa.array(letters, pa.int64()),
                pa.array(rejected, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in carry] + own, carry + OWN)

    return run


OWN = ["lang_pred", "score", "cross_entropy", "letters", "rejected"]


def predict(docs: DataFrame, models: Models, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns, lang_pred, score, cross_entropy, letters, rejected: one row per input row.

    ``lang_pred`` is "und" (score 0, rejected) if the text is null or has no letter, or if no language
    was learned. Otherwise it is the language with the lowest cross-entropy in bits per symbol (equal
    ones: the first in alphabetical order), ``score`` its share among the languages' likelihoods, and
    ``rejected`` says that the cross-entropy is above the language's calibrated limit. Carried columns
    named like a result column are left out. Only the text is used.
    """
    ship(docs.sparkSession)
    carry = [c for c in carry or [] if c not in OWN]
    shared = docs.sparkSession.sparkContext.broadcast(replace(models, tables=None))
    text = text_col if text_col in carry else "_text"
    source = docs.select(*[c for c in carry if c != text], F.col(text_col).cast("string").alias(text))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*carry).schema]
    own = ["lang_pred string", "score double", "cross_entropy double", "letters long", "rejected boolean"]
    totals = None
    if models.tables:
        totals = "_totals"
        source = materialize(source.withColumn("_row", F.monotonically_increasing_id()))
        source = source.join(_totals(source.select("_row", F.col(text).alias("_text")), models), "_row", "left")
    return source.mapInArrow(_predict(shared, models.order, text, carry, totals), ", ".join(kinds + own))


def _totals(texts: DataFrame, models: Models) -> DataFrame:
    """_row, _totals: sums of log2 probabilities per language, by joins with the tables of a large model."""
    order, count = models.order, len(models.languages)

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                codes = symbols(text.as_py(), order)
                for at in range(0, len(codes) - order + 1, _SCORED):
                    part = codes[at : at + _SCORED + order - 1]
                    _, first, n = np.unique(_hashes(part, order), return_index=True, return_counts=True)
                    grams = _gram_text(np.lib.stride_tricks.sliding_window_view(part, order)[first])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), row)), pa.array(grams), pa.array(n)], ["_row", "gram", "n"]
                    )

    grams = materialize(texts.mapInArrow(grams_of, "_row long, gram string, n long"))
    scored = grams.select("gram").distinct()
    score = lambda i: F.array(*[F.lit(float(b)) for b in models.base])[i]
    for k, (of_grams, of_contexts) in enumerate(models.tables, 1):
        own, before = F.substring("gram", order - k + 1, k), F.substring("gram", order - k + 1, k - 1)
        scored = scored.withColumn("_own", own).join(
            of_grams.select(F.col("gram").alias("_own"), F.col("v").alias(f"_p{k}")), "_own", "left"
        )
        if k > 1:
            scored = scored.withColumn("_before", before).join(
                of_contexts.select(F.col("gram").alias("_before"), F.col("v").alias(f"_w{k}")), "_before", "left"
            )
        score = _or_shorter(score, k)
    scores = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), score)
    scored = materialize(scored.select("gram", scores.alias("v")))
    joined = lookup_join(grams, scored, ["gram"], "inner")
    sums = [F.sum(F.col("n") * F.col("v")[i]) for i in range(count)]
    return joined.groupBy("_row").agg(F.array(*sums).alias("_totals"))


def _or_shorter(shorter, k: int):
    """Score of order k: that of the gram, or the weight of its context and the score of the shorter gram."""

    def score(i):
        weight = F.coalesce(F.col(f"_w{k}")[i], F.lit(0.0)) if k > 1 else F.lit(0.0)
        return F.coalesce(F.col(f"_p{k}")[i].cast("double"), weight + shorter(i))

    return score


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    entries: int = ENTRIES,
    calibrate: bool = True,
) -> Models:
    """Models and rejection limits from all rows with a text and a label.

    The limit of a language is the cross-entropy that ``REJECT_SHARE`` of the rows that go to it exceed,
    plus ``REJECT_MARGIN`` bits; a language without such rows has none. Without rows there are no
    languages. A model of more than ``entries`` grams and contexts is kept in tables instead of arrays.
    ``calibrate`` may be left out by who scores the training rows anyway, see ``identify``.
    """
    ship(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.filter("lang is not null and _text is not null")
    counted = rows.mapInArrow(_count(order), "lang string, gram string, n long")
    top = materialize(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    counts = {order: top}
    for k in range(order - 1, 0, -1):  # how many different symbols precede a gram
        longer = counts[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram"))
        counts[k] = longer.agg(F.count(F.lit(1)).alias("n"))
    languages = sorted(r["lang"] for r in top.select("lang").distinct().collect())
    if not languages:
        return Models([], order, [], [], np.zeros(0, np.float32))
    vocabulary = counts[1].groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("symbols"))
    base = vocabulary.select("lang", (1 / F.col("symbols")).alias("p"))
    tables: list[tuple] = []
    lower = base
    for k in range(1, order + 1):
        lower, context = _interpolate(counts[k], lower, k)
        lower = materialize(lower)
        tables.append((lower, materialize(context)))
    large = sum(t.count() for pair in tables for t in pair) > entries
    floor = {r["lang"]: r["p"] for r in base.collect()}
    models = Models(
        languages,
        order,
        [_array(None if large else gram, languages, "p") for gram, _ in tables],
        [_array(None if large else context, languages, "weight") for _, context in tables[1:]],
        np.log2(np.array([floor[lang] for lang in languages])).astype(np.float32),
    )
    # unseen symbols take the share of the first order that its discounts free
    free = {r["lang"]: r["weight"] for r in _interpolate(counts[1], base, 1)[1].collect()}
    models.base += np.log2(np.array([free[lang] for lang in languages])).astype(np.float32)
    if large:
        models.tables = [(_by_gram(g, languages, "p"), _by_gram(c, languages, "weight")) for g, c in tables]
    if calibrate:
        models.limits = rejection_limits(predict(labelled.filter(F.col(lang_col).isNotNull()), models, text_col))
    return models


def rejection_limits(scored: DataFrame) -> dict[str, float]:
    """Limit per predicted language, from the cross-entropies of all rows of ``scored``."""
    limits = (
        scored.filter(F.col("letters") >= REJECT_LETTERS)
        .groupBy("lang_pred")
        .agg(F.percentile_approx("cross_entropy", 1 - REJECT_SHARE, 10000).alias("limit"))
    )
    return {r["lang_pred"]: r["limit"] + REJECT_MARGIN for r in limits.collect()}


def identify(
    docs: DataFrame,
    learned: Column | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
    carry: list[str] | None = None,
) -> DataFrame:
    """``train`` on the labelled rows where ``learned`` holds (all without it), and ``predict`` for all rows.

    The training rows are scored once, with the others: their cross-entropies give the limits, and the limits
    then decide on all rows. The scored rows are written once to the shared folder.
    """
    carry = [c for c in carry or [] if c not in OWN]
    labelled = F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    learns = F.coalesce(labelled if learned is None else labelled & learned, F.lit(False))
    marked = docs.withColumn("_learned", learns)
    models = train(marked.filter("_learned"), text_col, lang_col, calibrate=False)
    scored = materialize(predict(marked, models, text_col, [*carry, "_learned"]))
    limits = rejection_limits(scored.filter("_learned"))
    above = F.lit(False)
    for lang, limit in limits.items():
        above = above | ((F.col("lang_pred") == lang) & (F.col("cross_entropy") > limit))
    rejected = (F.col("lang_pred") == UNKNOWN) | ((F.col("letters") >= REJECT_LETTERS) & above)
    return scored.withColumn("rejected", rejected).select(*carry, *OWN)


def _interpolate(counts: DataFrame, lower: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(lang, gram, n, p) of order k, and (lang, gram, n, weight) of its contexts."""
    of_counts = counts.groupBy("lang").agg(
        F.count(F.when(F.col("n") == 1, 1)).alias("n1"), F.count(F.when(F.col("n") == 2, 1)).alias("n2")
    )
    # absolute discount; where no gram is single, a small one keeps unseen symbols possible
    discount = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(F.lit(0.1))
    discounts = of_counts.select("lang", F.least(discount, F.lit(0.95)).alias("d"))
    split = counts.withColumn("context", F.substring("gram", 1, k - 1)).join(F.broadcast(discounts), "lang")
    contexts = split.groupBy("lang", "context").agg(
        F.sum("n").alias("total"), (F.first("d") * F.count(F.lit(1)) / F.sum("n")).alias("weight")
    )
    joined = split.join(contexts, ["lang", "context"])
    if k == 1:
        joined = joined.join(F.broadcast(lower.withColumnRenamed("p", "q")), "lang")
    else:
        shorter = lower.select("lang", F.col("gram").alias("rest"), F.col("p").alias("q"))
        joined = joined.withColumn("rest", F.substring("gram", 2, k - 1)).join(shorter, ["lang", "rest"])
    p = (F.col("n") - F.col("d")) / F.col("total") + F.col("weight") * F.col("q")
    return (
        joined.select("lang", "gram", "n", p.alias("p")),
        contexts.select("lang", F.col("context").alias("gram"), F.col("total").alias("n"), "weight"),
    )


def _by_gram(rows: DataFrame, languages: list[str], value: str) -> DataFrame:
    """gram, v: log2 values of all languages, null where a language has not stored the gram."""
    own = [F.max(F.when(F.col("lang") == lang, F.log2(value))).cast("float") for lang in languages]
    return materialize(rows.groupBy("gram").agg(F.array(*own).alias("v")))


def _array(rows: DataFrame | None, languages: list[str], value: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and log2 values of all rows."""
    if rows is None:
        return np.empty(0, np.uint64), np.empty((0, len(languages)), np.float32)
    found = rows.select("lang", "gram", F.log2(value).cast("float").alias("v")).toArrow()
    column = {lang: i for i, lang in enumerate(languages)}
    if not found.num_rows:
        return np.empty(0, np.uint64), np.empty((0, len(languages)), np.float32)
    grams = found.column("gram").to_pylist()
    width = len(grams[0])
    missing = np.float32(np.nan if value == "p" else 0.0)
    if not width:
        return np.empty(0, np.uint64), np.empty((0, len(languages)), np.float32)
    codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, width)
    hashes = _row_hash(mix(np.where(codes == 32, 0, codes).astype(np.uint64) + np.uint64(1)))
    keys, where = np.unique(hashes, return_inverse=True)
    matrix = np.full((len(keys), len(languages)), missing, np.float32)
    matrix[where, [column[x] for x in found.column("lang").to_pylist()]] = found.column("v").to_numpy()
    return keys, matrix


def in_fold(id_column, folds: int = 4, fold: int = 2):
    """crc32 of the id as text modulo ``folds`` is ``fold``; null for a null id."""
    return F.pmod(F.crc32(id_column.cast("string")), F.lit(folds)) == fold


def crc_fold(doc_id: int, folds: int = 4) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds
