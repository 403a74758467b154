"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``window`` consecutive words of the benchmark items (a shorter item is one
pattern). Patterns of one length share a table set: a shift table over blocks of two words tells how far
the search may jump, a hash of the last block selects the patterns that could end here, and comparing
their words confirms an occurrence. A block that is in no pattern jumps by the whole pattern length less
one, so most words of a clean text are never looked at.

The tables are held in every task, so the benchmark is cut into parts of at most ``part_words`` pattern
words each; every part searches all documents, and the findings of a document are merged.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import ship
from cellspark.plans.scale import materialize

WINDOW = 10
#: Pattern words whose tables a task holds at once: about 200 bytes each at worst.
PART_WORDS = 500_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Lower-cases A-Z and turns ASCII that is neither letter nor digit into spaces.
WORDS = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in _LOWER
)


def words_of(text: str | bytes | None) -> list[bytes]:
    data = (text or b"") if isinstance(text, bytes) or text is None else text.encode()
    return data.translate(WORDS).split()


class Patterns:
    """Wu-Manber tables for patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set[int]]):
        self.length = length
        self.block = min(2, length)
        self.longest_jump = length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = defaultdict(list)
        for words, items in patterns.items():
            for end in range(self.block, length + 1):
                block = words[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.longest_jump), length - end)
            self.bucket[hash(words[length - self.block :])].append((words, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[int]]]:
        """(first word, items) of every occurrence."""
        length, block, shift, jump = self.length, self.block, self.shift.get, self.longest_jump
        end, n = length, len(words)
        while end <= n:
            tail = tuple(words[end - block : end])
            step = shift(tail, jump)
            if step:
                end += step
                continue
            whole = tuple(words[end - length : end])
            for pattern, items in self.bucket.get(hash(tail), ()):
                if pattern == whole:
                    yield end - length, items
            end += 1


def windows_of(words: list[bytes], window: int) -> Iterator[tuple[bytes, ...]]:
    if words:
        for at in range(max(1, len(words) - window + 1)):
            yield tuple(words[at : at + window])


def build(items: list[tuple[int, str]], window: int) -> list[Patterns]:
    """Tables by pattern length; ``items`` are (number, text)."""
    by_length: dict[int, dict] = defaultdict(lambda: defaultdict(set))
    for number, text in items:
        for words in windows_of(words_of(text), window):
            by_length[len(words)][words].add(number)
    return [Patterns(length, patterns) for length, patterns in sorted(by_length.items())]


def _parts(benchmark: DataFrame, item_col: str, text_col: str, part_words: int, window: int) -> list[list]:
    """The items in parts whose tables fit a task. Read part by part, so that the driver holds one."""
    named = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.col(text_col).cast("string").alias("text"),
    ).filter("text is not null")
    # each word of an item starts at most one window
    cost = named.agg(F.sum((F.length("text") / 2 + 1) * window)).first()[0] or 0
    count = max(1, int(-(-cost // (part_words * window))))
    split = named.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(count)))
    return [split.filter(F.col("part") == p).select("item", "text") for p in range(count)]


def _search(window: int, tables, names: list[str], text: str, kept: list[str]):
    opened: list[list[Patterns]] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not opened:
            opened.append(build(list(enumerate(tables.value)), window))
        for batch in batches:
            counts, hits, items = [], [], []
            for value in batch.column(text).cast(pa.binary()):
                words = words_of(value.as_py())
                covered: list[list[int]] = []
                found: set[int] = set()
                for patterns in opened[0]:
                    for at, numbers in patterns.search(words):
                        covered.append([at, at + patterns.length])
                        found |= numbers
                counts.append(len(words))
                hits.append(union(covered))
                items.append(sorted({names[n] for n in found}))
            own = [
                pa.array(counts, pa.int64()),
                pa.array(hits, pa.list_(pa.list_(pa.int32()))),
                pa.array(items, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + own, kept + ["n_words", "hits", "items"]
            )

    return run


def union(spans: list[list[int]]) -> list[list[int]]:
    """Sorted disjoint spans that cover the same words."""
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return merged


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    part_words: int = PART_WORDS,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per input row: id_col, the ``carry`` columns, n_words, hits, items.

    ``hits`` are the disjoint [from, to) ranges of words that lie in an occurrence of a window, ``items``
    the ids (as text, each once, sorted) of the items with occurring windows. Null and empty texts have
    no words and no hits; items without words have no windows; an item without an id counts as item "".
    An id that several items share is one item. A carried column named like a result column is left out.
    """
    spark = docs.sparkSession
    ship(spark)
    carry = [c for c in carry or [] if c not in (id_col, "n_words", "hits", "items")]
    text = text_col if text_col in (id_col, *carry) else "_text"
    plain = [c for c in (id_col, *carry) if c != text]
    columns = [*plain, F.col(text_col).cast("string").alias(text)]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(id_col, *carry).schema)
    schema = f"{kinds}, n_words long, hits array<array<int>>, items array<string>"
    parts = _parts(benchmark, item_col, item_text, part_words, window)
    found = []
    source = docs.select(*columns)
    if len(parts) > 1:  # several findings of a row are merged by its number, which must not change
        source = materialize(source.withColumn("_row", F.monotonically_increasing_id()))
        schema = f"{kinds}, _row long, n_words long, hits array<array<int>>, items array<string>"
    for part in parts:
        rows = part.collect()  # at most part_words words
        tables = spark.sparkContext.broadcast([r["text"] for r in rows])
        kept = [id_col, *carry, *(["_row"] if len(parts) > 1 else [])]
        found.append(source.mapInArrow(_search(window, tables, [r["item"] for r in rows], text, kept), schema))
    if len(found) == 1:
        return found[0]
    merged = found[0]
    for more in found[1:]:
        merged = merged.unionByName(more)
    grouped = merged.groupBy("_row").agg(
        *[F.first(c).alias(c) for c in (id_col, *carry)],
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),  # one list per part
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    schema = f"{kinds}, n_words long, hits array<array<int>>, items array<string>"
    return grouped.drop("_row").mapInArrow(_merge, schema)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits = [union(spans) for spans in batch.column("hits").to_pylist()]
        at = batch.schema.get_field_index("hits")
        yield batch.set_column(at, "hits", pa.array(hits, pa.list_(pa.list_(pa.int32()))))
