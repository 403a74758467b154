"""Alignments stored in genome order with an index that region reads use (O1).

``data`` is Parquet, range-partitioned and sorted by sample, chromosome and position, so a file holds one stretch of the
genome. ``index`` has a row for every file, sample, chromosome and window of ``WINDOW`` bases in which alignments start:
how many, the least start and the greatest end. A region read takes the files whose windows may reach the region, and
asks them for no start before the least of those windows, which lets the reader skip row groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.functions.alignments import reference_end

WINDOW = 1 << 14
#: Rows of a row group at most, so that ranges of a file can be skipped.
GROUP_BYTES = 8 << 20


def write_regions(alignments: DataFrame, path: str, window: int = WINDOW) -> None:
    """O1: store alignments (sample, read_name, chrom, pos, cigar and more) in genome order, and their index.

    Alignments without a chromosome or position are stored, first in their sample, but belong to no region.
    ``end``, the last base on the reference, is added.
    """
    spark = alignments.sparkSession
    placed = alignments.withColumn("end", F.greatest(F.col("pos"), reference_end(F.col("pos"), F.col("cigar"))))
    order = ["sample", "chrom", "pos"]
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order, "read_name")
    ranged.write.mode("overwrite").option("parquet.block.size", GROUP_BYTES).parquet(f"{path}/data")
    stored = spark.read.schema(placed.schema).parquet(f"{path}/data")
    index = (
        stored.filter("chrom is not null and pos is not null")
        .groupBy(F.col("_metadata.file_name").alias("file"), "sample", "chrom", F.floor(F.col("pos") / window).alias("window"))
        .agg(F.count(F.lit(1)).alias("alignments"), F.min("pos").alias("least"), F.max("end").alias("most"))
    )
    index.repartitionByRange("sample", "chrom", "window").sortWithinPartitions("sample", "chrom", "window").write.mode(
        "overwrite"
    ).parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def read_region(
    spark: SparkSession, path: str, chrom: str, first: int, last: int, samples: list[str] | None = None
) -> DataFrame:
    """Alignments that cover some base from ``first`` to ``last`` (or a gap between two of their blocks there).

    Only the names of the files to read pass through the driver.
    """
    windows = read_index(spark, path).filter((F.col("chrom") == chrom) & (F.col("least") <= last) & (F.col("most") >= first))
    if samples is not None:
        windows = windows.filter(F.col("sample").isin(samples))
    files = windows.groupBy("file").agg(F.min("least").alias("least")).collect()
    reader = spark.read.schema(spark.read.parquet(f"{path}/data").schema)
    if not files:
        return reader.parquet(f"{path}/data").limit(0)
    least = min(row["least"] for row in files)
    rows = reader.parquet(*[f"{path}/data/{row['file']}" for row in files]).filter(
        (F.col("chrom") == chrom) & F.col("pos").between(least, last) & (F.col("end") >= first)
    )
    return rows if samples is None else rows.filter(F.col("sample").isin(samples))


def coverage(spark: SparkSession, path: str) -> DataFrame:
    """``sample, chrom, window, alignments``: from the index alone."""
    return read_index(spark, path).groupBy("sample", "chrom", "window").agg(F.sum("alignments").alias("alignments"))
