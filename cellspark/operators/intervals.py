"""Interval building blocks: bin clipping, union of intervals and the binned overlap join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellspark.plans.scale import Footprint, lookup_join


def bin_of(column, bin_size: int):
    return F.floor(column / F.lit(bin_size)).cast("long")


def clip_to_bins(df: DataFrame, start: str, end: str, bin_size: int) -> DataFrame:
    """Split each interval at bin borders: one row per touched bin, ``start``/``end`` clipped."""
    bins = F.sequence(bin_of(F.col(start), bin_size), bin_of(F.col(end), bin_size))
    spread = df.withColumn("bin", F.explode(bins))
    return spread.withColumn(start, F.greatest(F.col(start), F.col("bin") * bin_size)).withColumn(
        end, F.least(F.col(end), F.col("bin") * bin_size + (bin_size - 1))
    )


def binned_union(df: DataFrame, keys: list[str], bin_size: int) -> DataFrame:
    """Union of the intervals of each key, as disjoint pieces clipped to bins.

    Equal clipped pieces collapse before the sweep; a window partition is one key in one bin, so
    it holds at most the distinct (start, end) pairs of that bin.
    """
    pieces = clip_to_bins(df, "start", "end", bin_size).select(*keys, "bin", "start", "end").distinct()
    along = Window.partitionBy("bin", *keys).orderBy("start", "end")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("end").over(before)
    opened = F.when(reached.isNull() | (F.col("start") > reached + 1), 1).otherwise(0)
    islands = pieces.withColumn("_new", opened).withColumn(
        "_island", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        islands.groupBy(*keys, "bin", "_island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .drop("_island")
    )


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    bin_size: int,
    size: Footprint | None = None,
) -> DataFrame:
    """Inner join: pairs of rows whose [start, end] intervals overlap and whose ``keys`` agree.

    Both sides are repeated once per bin they touch and joined on (keys, bin); a pair is kept only
    in its first shared bin, so no duplicate removal is needed. Columns of ``right`` other than the
    keys get the prefix ``r_``. Only pairs that truly overlap are produced.
    """
    l_bins = left.withColumn(
        "bin", F.explode(F.sequence(bin_of(F.col("start"), bin_size), bin_of(F.col("end"), bin_size)))
    )
    r_named = right.select(*keys, *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys])
    r_bins = r_named.withColumn(
        "bin", F.explode(F.sequence(bin_of(F.col("r_start"), bin_size), bin_of(F.col("r_end"), bin_size)))
    )
    overlaps = (F.col("start") <= F.col("r_end")) & (F.col("r_start") <= F.col("end"))
    first_shared = bin_of(F.greatest("start", "r_start"), bin_size) == F.col("bin")
    # the number first: sorts then compare few of the texts
    joined = lookup_join(l_bins, r_bins, ["bin", *keys], "inner", condition=overlaps & first_shared, size=size)
    return joined.drop("bin")
