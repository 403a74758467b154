"""URL filters by a sort-merge range join.

A host's labels are reversed into a canonical key (``www.example.com`` becomes ``com/example/www/``; no host holds a slash), so a
host and all its subdomains are the keys that begin with the host's key: an interval. Rules and urls are
ranged by this key and each range is swept once in sorted order. The sweep keeps a stack of the rules
whose interval is open; intervals of prefixes are nested, so closing ones are on top. A url is judged
against the stack: of the rules whose path its own path begins with, the longest wins.

Ranges come from quantiles of a bounded sample (they only balance the work). A url's place also depends
on its path and id, so a hot host spreads over several ranges. A rule goes to every range its interval
meets; only a rule whose interval holds a boundary goes to more than one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.llm.common import lower_ascii, ship

SAMPLE = 4000
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Reversed labels, each followed by a slash, which no host holds; empty for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/"))
    )


def _place(bounds: list[str]):
    """Range numbers: of a url by its place, of a rule by its interval."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            places = batch.column("place").to_pylist()
            rule = batch.column("rule").to_pylist()
            take, ranges = [], []
            for i, (key, place) in enumerate(zip(keys, places)):
                if rule[i] is None:
                    first = last = bisect_right(bounds, place)
                else:
                    first, last = bisect_right(bounds, key), bisect_left(bounds, key + chr(0x10FFFF))
                for n in range(first, last + 1):
                    take.append(i)
                    ranges.append(n)
            picked = pa.Table.from_batches([batch]).take(pa.array(take, pa.int64()))
            yield from picked.append_column("range", pa.array(ranges, pa.int32())).to_batches()

    return run


def _sweep(default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, list[tuple]]] = []
        now = None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("range", "key", "path", "rule", "action")))
            keep, found, verdicts = [], [], []
            for i, (number, key, path, rule, action) in enumerate(rows):
                if number != now:
                    now, stack = number, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if rule is not None:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, []))
                    stack[-1][1].append((len(rule), path, rule, action))
                    continue
                best = None
                if key:
                    for depth, (_, rules) in enumerate(stack):
                        for length, prefix, name, verdict in rules:
                            if path.startswith(prefix) and (best is None or (length, depth) >= best[0]):
                                best = ((length, depth), name, verdict)
                keep.append(i)
                found.append(best[1] if best else None)
                verdicts.append(best[2] if best else default)
            picked = batch.take(pa.array(keep, pa.int64()))
            names = [n for n in picked.schema.names if n not in ("range", "key", "rule", "action", "place", "kind")]
            yield pa.RecordBatch.from_arrays(
                [picked.column(n) for n in names] + [pa.array(found, pa.string()), pa.array(verdicts, pa.string())],
                names + ["rule", "verdict"],
            )

    return run


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = DEFAULT,
    sample: int = SAMPLE,
) -> DataFrame:
    """id_col, host, path, rule, verdict: one row per input row.

    ``rules`` has host, path, action (allow or block). A rule fits its host and all subdomains if the
    url's path begins with the rule's path; the longest host and path together win, then the longer
    host, then the later rule in the order of (host, path, action). Without a fitting rule ``rule`` is
    null and the verdict is ``default``. A null url, or one without ``://``, has an empty host and path
    and fits no rule; so does an empty host. Rules with a null in them, or with an empty host or one with a
    slash, are none. Other
    columns are left out.
    """
    ship(pages.sparkSession)
    url = F.col(url_col)
    named = pages.select(F.col(id_col).cast("long").alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    salt = F.lpad(F.hex(F.xxhash64(id_col)), 16, "0")
    urls = named.select(
        F.lit(1).alias("kind"),
        host_key(F.col("host")).alias("key"),
        "path",
        id_col,
        "host",
        F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("action"),
    ).withColumn("place", F.concat("key", F.lit("\x01"), "path", F.lit("\x01"), salt))
    valid = rules.filter("host is not null and path is not null and action is not null and host <> '' and not contains(host, '/')").distinct()
    host = lower_ascii(F.col("host"))
    rows = valid.select(
        F.lit(0).alias("kind"),
        host_key(host).alias("key"),
        "path",
        F.lit(None).cast("long").alias(id_col),
        host.alias("host"),
        F.concat(host, "path").alias("rule"),
        "action",
        F.lit("").alias("place"),
    )
    # a sample by hash, about ``sample`` rows however many there are, balances the ranges
    every = max(1, pages.count() // sample)
    picked = urls.filter(F.pmod(F.xxhash64(F.lit(3), "place"), F.lit(every)) == 0).select("place").limit(4 * sample)
    places = sorted(r["place"] for r in picked.collect())
    ranges = max(1, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = sorted({places[len(places) * i // ranges] for i in range(1, ranges)}) if places else []
    columns = f"kind int, key string, path string, `{id_col}` long, host string, rule string, action string, place string"
    both = urls.unionByName(rows).mapInArrow(_place(bounds), f"{columns}, `range` int")
    order = ["range", "key", "kind", "path", "action"]
    dealt = both.repartition(len(bounds) + 1, "range").sortWithinPartitions(*order)
    result = f"path string, `{id_col}` long, host string, rule string, verdict string"
    return dealt.mapInArrow(_sweep(default), result).select(id_col, "host", "path", "rule", "verdict")
