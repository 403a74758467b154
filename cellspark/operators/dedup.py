"""Deduplication per cell and 5' position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.functions import alignments as al
from cellspark.functions import names


def dedup(alignments: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One alignment per (sample, chrom, strand, 5' position, cell barcode).

    The kept alignment has the highest MAPQ, then the lowest NH, then the first name. It is a
    minimum over a struct: copies collapse in each task before the shuffle, so a position with
    very many copies sends one row per task. ``keep`` names the columns the result needs; only they,
    the key and the ranking are shuffled.
    """
    keys = ["sample", "chrom"]
    ranked = ["mapq", "nh", "read_name"]
    wanted = [c for c in alignments.columns if keep is None or c in keep]
    # a gene comes first, so that full ties are broken alike whatever else is kept
    rest = sorted((c for c in wanted if c not in keys + ranked), key=lambda c: c != "xt")
    best = F.min(F.struct((-F.col("mapq")).alias("_mapq"), "nh", "read_name", *rest))
    picked = _keyed(alignments).groupBy("_five_prime", *keys, "_reverse", "_barcode").agg(best.alias("_best"))
    return picked.select(
        *[
            F.col(c) if c in keys else (-F.col("_best._mapq")).alias(c) if c == "mapq" else F.col(f"_best.{c}").alias(c)
            for c in wanted
        ]
    )


def _keyed(alignments: DataFrame) -> DataFrame:
    """Mapped alignments with the position and barcode parts of their deduplication key."""
    return (
        alignments.filter(~al.has_flag(F.col("flag"), al.FLAG_UNMAPPED))
        .withColumn("_reverse", al.has_flag(F.col("flag"), al.FLAG_REVERSE))
        .withColumn("_five_prime", al.five_prime(F.col("flag"), F.col("pos"), F.col("cigar")))
        .withColumn("_barcode", names.barcode_for_counting(F.col("read_name")))
    )


def dedup_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """Reads before and after per sample, and the share removed in percent (0 for no reads)."""
    reads_in = before.groupBy("sample").agg(F.count(F.lit(1)).alias("reads_before_deduplication"))
    reads_out = after.groupBy("sample").agg(F.count(F.lit(1)).alias("reads_after_deduplication"))
    joined = reads_in.join(reads_out, "sample", "left").withColumn(
        "reads_after_deduplication", F.coalesce("reads_after_deduplication", F.lit(0))
    )
    return with_saturation(joined)


def with_saturation(stats: DataFrame) -> DataFrame:
    before, after = F.col("reads_before_deduplication"), F.col("reads_after_deduplication")
    return stats.withColumn(
        "sequencing_saturation", F.when(before != 0, (F.lit(1) - after / before) * 100).otherwise(F.lit(0.0))
    )


def dedup_stats_single_pass(alignments: DataFrame) -> DataFrame:
    """A18 from one pass: copies are counted per deduplication key, then keys per sample."""
    keys = (
        _keyed(alignments)
        .groupBy("sample", "chrom", "_reverse", "_five_prime", "_barcode")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    stats = keys.groupBy("sample").agg(
        F.sum("_n").alias("reads_before_deduplication"), F.count(F.lit(1)).alias("reads_after_deduplication")
    )
    return with_saturation(stats)
