"""Building blocks that keep plans safe at scale.

* ``materialize``: cut lineage with a table in the shared checkpoint folder; ``stage_tables`` removes them.
* ``lookup_join``: broadcast a side only after measuring it, shuffle both otherwise.
* ``number_rows``: 1..n numbering inside a group without sorting the group in one task.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

BROADCAST_BYTES = 128 * 1024 * 1024
SALTS = 32
#: A lookup's rows repeated for the salts may take so much; a larger lookup is not repeated at all.
REPEATED_BYTES = 4 * BROADCAST_BYTES

_local_roots: dict[str, str] = {}
_stage_paths: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder of the session; only a local master may fall back to a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="cellspark-")
    return _local_roots[app]


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back; ``compression`` if not the session's."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/stage-{uuid.uuid4().hex}"
    _stage_paths.append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stage_tables(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that ``materialize`` wrote inside the block, when it ends.

    Write or collect what you need before that: results that were not, can no longer be computed.
    """
    before = len(_stage_paths)
    try:
        yield
    finally:
        _drop_since(spark, before)


def _drop_since(spark: SparkSession, before: int) -> None:
    jvm = spark.sparkContext._jvm
    while len(_stage_paths) > before:
        path = jvm.org.apache.hadoop.fs.Path(_stage_paths.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settle(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """``materialize`` what ``make`` gives, and remove the tables that it wrote on the way."""
    before = len(_stage_paths)
    kept = materialize(make())
    own = _stage_paths.pop()
    _drop_since(spark, before)
    _stage_paths.append(own)
    return kept


@dataclass(frozen=True)
class Footprint:
    rows: int
    bytes: int


def _width(name: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(name)), F.lit(0)) + 16
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.length(F.to_json(F.struct(F.col(name)))) * 2 + 32
    return F.lit(16)


def footprint(df: DataFrame) -> Footprint:
    """Measured row count and an upper estimate of the in-memory size."""
    width = sum((_width(f.name, f.dataType) for f in df.schema.fields), F.lit(32))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return Footprint(row["n"], row["b"] or 0)


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    condition: Column | None = None,
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
    size: Footprint | None = None,
) -> DataFrame:
    """Join a row-level table with a lookup table.

    The lookup is measured first. Within ``max_bytes`` it is broadcast, so the big side is not
    shuffled. Beyond that both sides are shuffled on ``on`` and merged; Spark may not broadcast the
    lookup after all, as its own estimate is the size of compressed files. With a salt rows of one hot
    key spread over up to ``salts`` tasks, and each lookup row is repeated once per salt value. Only as
    many salts are used as keep the repeated lookup within ``REPEATED_BYTES``: a large one is shuffled
    once, without a salt, and adaptive execution splits the partitions of hot keys.
    The salt is a hash of the whole row, so rows need some column that tells them apart.
    ``condition`` is an extra predicate over non-key columns, which must be named differently.
    Joins that keep unmatched lookup rows are refused: a repeated lookup row would be kept once per salt.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a lookup join cannot be {how}")
    size = size or footprint(small)
    keys = list(on)
    left, right = big, small
    if size.bytes <= max_bytes:
        right = F.broadcast(right)
    else:
        salts = max(1, min(salts, REPEATED_BYTES // max(size.bytes, 1)))
    if size.bytes > max_bytes and salts > 1:
        spread = F.xxhash64(*[F.col(c) for c in big.columns])
        left = left.withColumn("_salt", F.pmod(spread, F.lit(salts)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys = keys + ["_salt"]
    if size.bytes > max_bytes:
        right = right.hint("merge")
    if condition is None:
        return left.join(right, keys, how).drop("_salt")
    renamed = right.select([F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in right.columns])
    predicate = condition
    for k in keys:
        predicate = predicate & (left[k] == renamed[f"_k_{k}"])
    joined = left.join(renamed, predicate, how)
    return joined.drop("_salt", *[f"_k_{k}" for k in keys])


def number_rows(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """Add ``name`` = 1..n inside each group, in the given total order.

    Rows are range-partitioned on (group, order), so a hot group is split over many tasks. Each range is sorted
    and its rows counted on as they are written, the range in the upper bits of the count. A group's rows are
    consecutive in a range, so their rank is the distance from the first; the row counts of earlier ranges (one
    small row per range and group) are added as an offset. As with any join on ``group``, null groups are left out.
    """
    order_names = [f"_o{i}" for i in range(len(order))]
    keyed = df.select("*", *[o.alias(n) for o, n in zip(order, order_names)])
    sort_cols = [F.col(c) for c in group + order_names]
    in_order = keyed.repartitionByRange(*sort_cols).sortWithinPartitions(*sort_cols).drop(*order_names)
    ranged = materialize(in_order.withColumn("_at", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33).cast("int"))
    sizes = ranged.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *group, "_range", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_offset")
    )
    numbered = ranged.join(materialize(offsets), group + ["_range"])
    return numbered.withColumn(name, (F.col("_at") + F.col("_offset")).cast("long")).drop("_range", "_at", "_offset")


def prefix_sums(df: DataFrame, group: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` (a long, not null) over the rows before this one in its group.

    The order has to be total. As in ``number_rows``, ranges sum their own rows and add the sums of earlier ranges.
    """
    order_names = [f"_o{i}" for i in range(len(order))]
    keyed = df.select("*", value.alias("_value"), *[o.alias(n) for o, n in zip(order, order_names)])
    sort_cols = [F.col(c) for c in group + order_names]
    ranged = materialize(keyed.repartitionByRange(*sort_cols).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy(*group, "_range").agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group, "_range").orderBy(*order_names).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_before", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return (
        summed.join(offsets, group + ["_range"])
        .withColumn(name, (F.col("_before") + F.col("_offset")).cast("long"))
        .drop("_range", "_before", "_offset", "_value", *order_names)
    )
