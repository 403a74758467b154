"""Per-position and per-length read profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.functions import sequences as sq

KINDS = ("R1 Pre-QC", "R2 Pre-QC", "R1 Post-QC")


def profiled_reads(qc: DataFrame) -> DataFrame:
    """Rows ``sample, kind, seq, qual``: raw R1, raw R2 and, for passing reads, trimmed R1."""
    variants = F.array(
        F.struct(F.lit(KINDS[0]).alias("kind"), F.col("r1_seq").alias("seq"), F.col("r1_qual").alias("qual")),
        F.struct(F.lit(KINDS[1]).alias("kind"), F.col("r2_seq").alias("seq"), F.col("r2_qual").alias("qual")),
        F.struct(F.lit(KINDS[2]).alias("kind"), F.col("out_seq").alias("seq"), F.col("out_qual").alias("qual")),
    )
    return qc.select("sample", F.inline(variants)).filter(F.col("seq").isNotNull())


def read_summary(reads: DataFrame) -> DataFrame:
    """Read and base totals per (sample, kind); one combining aggregation, no per-base rows."""
    sums = reads.groupBy("sample", "kind").agg(
        F.count(F.lit(1)).alias("total_reads"),
        F.sum(F.length("seq")).alias("_bases"),
        F.sum(sq.bases_at_least(F.col("qual"), 30)).alias("q30_bases"),
        F.sum(sq.gc_bases(F.col("seq"))).alias("_gc"),
    )

    def per_base(value: str):
        return F.when(F.col("_bases") > 0, F.col(value) / F.col("_bases")).otherwise(F.lit(0.0))

    return sums.select(
        "sample",
        "kind",
        "total_reads",
        "q30_bases",
        per_base("q30_bases").alias("q30_rate"),
        per_base("_gc").alias("gc_content"),
        (F.col("_bases") / F.col("total_reads")).alias("mean_length"),
    )


#: Positions that one row of the profile's aggregation holds side by side.
STRIDE = 15


def position_profile(reads: DataFrame) -> DataFrame:
    """Base, quality, GC and N sums per (sample, kind, position), in one pass.

    A read becomes a row per ``STRIDE`` positions, whose sums are columns, so there is no row per base.
    Rows are combined per task; the shuffle carries one row per task and stride.
    """
    last = F.floor((F.length("seq") - 1) / STRIDE).cast("int")
    cut = reads.filter(F.length("seq") > 0).select(
        "sample", "kind", "seq", "qual", F.explode(F.sequence(F.lit(0), last)).alias("_c")
    )
    begin = F.col("_c") * STRIDE + 1
    pieces = cut.select(
        "sample", "kind", "_c", *[F.substring(c, begin, F.lit(STRIDE)).alias(c) for c in ("seq", "qual")]
    )
    sums = []
    for i in range(1, STRIDE + 1):
        base, quality = F.substring("seq", i, 1), F.ascii(F.substring("qual", i, 1))
        sums += [
            F.count_if(base != "").alias(f"_bases{i}"),
            F.sum(F.when(base != "", quality - F.lit(sq.PHRED_OFFSET))).alias(f"_quality{i}"),
            F.count_if(base.isin("G", "C")).alias(f"_gc{i}"),
            F.count_if(base == "N").alias(f"_n{i}"),
        ]
    summed = pieces.groupBy("sample", "kind", "_c").agg(*sums)
    rows = [
        F.struct(
            (F.col("_c") * STRIDE + i).alias("position"),
            F.col(f"_bases{i}").alias("bases"),
            F.col(f"_quality{i}").alias("quality_sum"),
            F.col(f"_gc{i}").alias("gc"),
            F.col(f"_n{i}").alias("n"),
        )
        for i in range(1, STRIDE + 1)
    ]
    return summed.select("sample", "kind", F.inline(F.array(*rows))).filter("bases > 0")


def quality_curve(profile: DataFrame) -> DataFrame:
    """Mean Phred score per position."""
    return profile.select("sample", "kind", "position", (F.col("quality_sum") / F.col("bases")).alias("mean_quality"))


def gc_curve(profile: DataFrame) -> DataFrame:
    """Share of G and C per position."""
    return profile.select("sample", "kind", "position", (F.col("gc") / F.col("bases")).alias("gc_fraction"))


def n_curve(profile: DataFrame) -> DataFrame:
    """Share of N per position."""
    return profile.select("sample", "kind", "position", (F.col("n") / F.col("bases")).alias("n_fraction"))


def length_distribution(reads: DataFrame) -> DataFrame:
    """A10: number of reads per length."""
    return reads.groupBy("sample", "kind", F.length("seq").alias("length")).agg(F.count(F.lit(1)).alias("reads"))


def qc_summary_json(reads: DataFrame) -> DataFrame:
    """One JSON document per (sample, kind) with totals, curves and the length histogram.

    The collected arrays have one entry per read position or length.
    """
    profile = position_profile(reads)
    ordered = F.sort_array(F.collect_list(F.struct("position", "quality_sum", "gc", "n", "bases")))
    curves = profile.groupBy("sample", "kind").agg(ordered.alias("_p"))
    lengths = (
        length_distribution(reads)
        .groupBy("sample", "kind")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("length", "reads")))).alias("_l"))
    )
    joined = read_summary(reads).join(curves, ["sample", "kind"], "left").join(lengths, ["sample", "kind"], "left")

    def curve(field: str):
        return F.transform("_p", lambda p: p[field] / p["bases"])

    summary = F.struct(
        "total_reads", "q30_bases", "q30_rate", "gc_content", F.col("mean_length").alias("read1_mean_length")
    )
    detail = F.struct(
        F.struct(curve("quality_sum").alias("mean")).alias("quality_curves"),
        F.struct(curve("gc").alias("GC"), curve("n").alias("N")).alias("content_curves"),
        F.col("_l").alias("length_distribution"),
    )
    before = F.to_json(F.struct(F.struct(summary.alias("before_filtering")).alias("summary"),
                                detail.alias("read1_before_filtering")))
    after = F.to_json(F.struct(F.struct(summary.alias("after_filtering")).alias("summary"),
                               detail.alias("read1_after_filtering")))
    return joined.select(
        "sample", "kind", F.when(F.col("kind") == KINDS[2], after).otherwise(before).alias("document")
    )


def raw_reads_from_json(documents: DataFrame) -> DataFrame:
    """Total reads before filtering, read back from the raw R1 document."""
    path = "$.summary.before_filtering.total_reads"
    return documents.filter(F.col("kind") == KINDS[0]).select(
        "sample", F.get_json_object("document", path).cast("long").alias("raw_reads")
    )
