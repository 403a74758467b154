"""Read trimming and filtering cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.config import ReadQcConfig
from cellspark.functions import sequences as sq
from cellspark.functions.formatting import percent

# Cascade steps in order; a read that fails one is not looked at by the next.
STEPS = ("barcode", "sss", "polyx", "quality", "n", "polya")


def qc_reads(matched: DataFrame, cfg: ReadQcConfig = ReadQcConfig()) -> DataFrame:
    """P5-P10: trimmed read, the step that lost it (NULL if it passed) and the trim flags.

    Adds ``lost_at, sss, out_seq, out_qual, polyx_trimmed, polya_trimmed``. Everything is a
    row-local expression; no shuffle. Only lengths are carried from step to step: each step
    keeps a prefix of the read.
    """
    trimmed = matched.withColumn("_s1", F.substr("r1_seq", F.lit(cfg.sss_nmer + 1))).withColumn(
        "_q1", F.substr("r1_qual", F.lit(cfg.sss_nmer + 1))
    )
    short = F.lit(cfg.min_read_length)
    barcode_lost = F.col("barcode").isNull()
    sss_lost = F.length("_s1") < short

    step1 = trimmed.withColumn("_alive1", ~barcode_lost & ~sss_lost)
    step2 = step1.withColumn(
        "_len2", F.when(F.col("_alive1"), sq.polyx_keep(F.col("_s1"), cfg.polyx_min_run))
    )
    step2 = step2.withColumn("_s2", F.substring(F.col("_s1"), F.lit(1), F.col("_len2"))).withColumn(
        "_q2", F.substring(F.col("_q1"), F.lit(1), F.col("_len2"))
    )
    step3 = step2.withColumn("_alive2", F.col("_alive1") & (F.col("_len2") >= short))
    step3 = step3.withColumn(
        "_bad_quality",
        F.when(
            F.col("_alive2"),
            sq.low_quality(F.col("_q2"), cfg.min_quality, cfg.max_low_quality_percent),
        ),
    )
    step4 = step3.withColumn("_alive3", F.col("_alive2") & ~F.col("_bad_quality"))
    step4 = step4.withColumn(
        "_many_n", F.when(F.col("_alive3"), sq.n_bases(F.col("_s2")) > cfg.max_n_bases)
    )
    step5 = step4.withColumn("_alive4", F.col("_alive3") & ~F.col("_many_n"))
    step5 = step5.withColumn(
        "_polya", F.when(F.col("_alive4"), sq.polya_start(F.col("_s2"), cfg.polya_min_run, cfg.polya_cg_min_run))
    )
    step5 = step5.withColumn(
        "_len3", F.when(F.col("_polya") > 0, F.col("_polya") - 1).otherwise(F.col("_len2"))
    )
    too_short_at_end = F.col("_len3") <= short if cfg.polya_strict_length else F.col("_len3") < short
    lost_at = (
        F.when(barcode_lost, "barcode")
        .when(sss_lost, "sss")
        .when(F.col("_len2") < short, "polyx")
        .when(F.col("_bad_quality"), "quality")
        .when(F.col("_many_n"), "n")
        .when(too_short_at_end & ((F.col("_polya") > 0) | F.lit(cfg.polya_strict_length)), "polya")
    )
    # generator output: a filter on it is not pushed down, which would work out every step again in its condition
    steps = F.struct(lost_at.alias("lost_at"), "_alive1", "_len2", "_len3", (F.col("_polya") > 0).alias("_cut"))
    done = step5.select(*matched.columns, F.explode(F.array(steps)).alias("_steps")).select(*matched.columns, "_steps.*")
    passed = F.col("lost_at").isNull()
    start = F.lit(cfg.sss_nmer + 1)
    return done.select(
        *[c for c in matched.columns],
        "lost_at",
        F.when(F.col("_alive1"), F.substring("r1_seq", 1, cfg.sss_nmer)).alias("sss"),
        F.when(passed, F.substring(F.col("r1_seq"), start, F.col("_len3"))).alias("out_seq"),
        F.when(passed, F.substring(F.col("r1_qual"), start, F.col("_len3"))).alias("out_qual"),
        F.coalesce(F.col("_len2") < F.length("r1_seq") - cfg.sss_nmer, F.lit(False)).alias("polyx_trimmed"),
        F.coalesce(F.col("_cut"), F.lit(False)).alias("polya_trimmed"),
    )


def qc_cascade(qc: DataFrame, cfg: ReadQcConfig = ReadQcConfig()) -> DataFrame:
    """A5+A11: the cascade counters, one row per sample.

    Two combining aggregations: per (sample, output length), which has few rows, then per sample;
    the exact median is taken from the length histogram.
    """
    passed = F.col("lost_at").isNull()
    barcode_qual = F.substring("r2_qual", 1, cfg.barcode_length)

    def count(cond):
        return F.count_if(cond)

    lost = [count(F.col("lost_at") == s).alias(f"_lost_{s}") for s in STEPS]
    by_length = qc.groupBy("sample", F.length("out_seq").alias("_len")).agg(
        F.count(F.lit(1)).alias("raw_reads"),
        count(F.col("barcode_status") == "direct").alias("barcode_direct_match"),
        count(F.col("barcode_status") == "corrected").alias("barcode_corrected"),
        *lost,
        count("polyx_trimmed").alias("polyx_trimmed_terminal"),
        count("polya_trimmed").alias("polya_trimmed_internal"),
        F.sum(F.when(passed, sq.gc_bases(F.col("sss")))).alias("_sss_gc"),
        F.sum(F.when(passed, F.length("sss"))).alias("_sss_len"),
        F.sum(F.when(passed, sq.bases_at_least(F.col("out_qual"), cfg.high_quality))).alias("_r1_q30"),
        F.sum(F.when(passed, sq.bases_at_least(barcode_qual, cfg.high_quality))).alias("_bc_q30"),
        F.sum(F.when(passed, F.length(barcode_qual))).alias("_bc_len"),
    )
    summed = [
        c for c in by_length.columns if c not in ("sample", "_len")
    ]
    totals = by_length.groupBy("sample").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed],
        F.coalesce(F.sum(F.when(F.col("_len").isNotNull(), F.col("raw_reads"))), F.lit(0)).alias("reads_output"),
        F.coalesce(F.sum(F.col("_len") * F.col("raw_reads")), F.lit(0)).alias("_out_len"),
        F.percentile("_len", 0.5, F.when(F.col("_len").isNotNull(), F.col("raw_reads")).otherwise(0)).alias("_median"),
    )

    def ratio(num: str, den: str):
        return F.when(F.col(den) != 0, F.col(num) / F.col(den)).otherwise(F.lit(0.0))

    kept = F.col("raw_reads")
    retained = {}
    for s in STEPS:
        kept = kept - F.col(f"_lost_{s}")
        retained[s] = kept
    return totals.select(
        "sample",
        "raw_reads",
        "barcode_direct_match",
        "barcode_corrected",
        F.col("_lost_barcode").alias("barcode_failed"),
        retained["barcode"].alias("post_barcode_reads_retained"),
        F.col("_lost_sss").alias("too_short_after_sss"),
        retained["sss"].alias("post_sss_trim_reads_retained"),
        "polyx_trimmed_terminal",
        F.col("_lost_polyx").alias("polyx_too_short_after_trim"),
        retained["polyx"].alias("post_polyx_trim_reads_retained"),
        F.col("_lost_quality").alias("low_quality_reads"),
        retained["quality"].alias("post_quality_filter_reads_retained"),
        F.col("_lost_n").alias("too_many_n_reads"),
        retained["n"].alias("post_n_filter_reads_retained"),
        "polya_trimmed_internal",
        F.col("_lost_polya").alias("polya_too_short_after_trim"),
        retained["polya"].alias("post_polya_trim_reads_retained"),
        "reads_output",
        ratio("_out_len", "reads_output").alias("mean_read_length_post_QC"),
        F.coalesce("_median", F.lit(0.0)).alias("median_read_length_post_QC"),
        (ratio("_sss_gc", "_sss_len") * 100).alias("SSS_gc_perc"),
        ratio("_r1_q30", "_out_len").alias("R1_output_Q30_rate"),
        ratio("_bc_q30", "_bc_len").alias("R2_barcode_Q30_rate"),
    )


def derived_read_metrics(cascade: DataFrame) -> DataFrame:
    """Percentages derived from the cascade counters."""
    return cascade.select(
        "sample",
        percent(F.col("post_barcode_reads_retained"), F.col("raw_reads")).alias("valid_barcode_reads_perc"),
        percent(F.col("reads_output"), F.col("post_barcode_reads_retained")).alias("reads_post_qc_perc"),
        (F.col("R1_output_Q30_rate") * 100).alias("rna_q30_rate"),
        (F.col("R2_barcode_Q30_rate") * 100).alias("barcode_q30_rate"),
    )


def passed_reads(qc: DataFrame) -> DataFrame:
    return qc.filter(F.col("lost_at").isNull())


def failed_reads(qc: DataFrame) -> DataFrame:
    return qc.filter(F.col("lost_at").isNotNull())


def route_samples(samples: DataFrame, counts: DataFrame, value: str) -> DataFrame:
    """Every sample with its count, 0 when it has no rows, and ``has_reads``."""
    return (
        samples.select("sample")
        .distinct()
        .join(counts.select("sample", value), "sample", "left")
        .withColumn(value, F.coalesce(value, F.lit(0)))
        .withColumn("has_reads", F.col(value) > 0)
    )
