"""Barcode lists, corrections and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.config import ReadQcConfig
from cellspark.functions import names
from cellspark.plans.scale import BROADCAST_BYTES, footprint, lookup_join, materialize

REPLACEMENTS = ("N", "A", "C", "G", "T")


def hamming1_variants(whitelist: DataFrame) -> DataFrame:
    """A1: every one-substitution variant of every ``barcode`` row.

    Rows: ``barcode, variant, position`` (1-based); extra columns of the input are kept.
    """
    spread = whitelist.withColumn("position", F.explode(F.sequence(F.lit(1), F.length("barcode")))).withColumn(
        "_base", F.explode(F.array(*[F.lit(b) for b in REPLACEMENTS]))
    )
    original = F.substring(F.col("barcode"), F.col("position"), F.lit(1))
    return (
        spread.filter(original != F.col("_base"))
        .withColumn("variant", F.overlay("barcode", "_base", F.col("position"), F.lit(1)))
        .drop("_base")
    )


def variant_origins(whitelist: DataFrame) -> DataFrame:
    """Number of generating list rows per variant; the count is combined before the shuffle."""
    return (
        hamming1_variants(whitelist)
        .groupBy("variant")
        .agg(F.count(F.lit(1)).alias("n_origins"), F.min("barcode").alias("barcode"))
    )


def curate_corrections(whitelist: DataFrame) -> DataFrame:
    """Variants that exactly one list row generates, as ``variant, barcode``."""
    return variant_origins(whitelist).filter(F.col("n_origins") == 1).select("variant", "barcode")


def correction_list(whitelist: DataFrame) -> DataFrame:
    """A2: one row per list line with its safe variants in generation order.

    A line without safe variants keeps an empty list. The list of a barcode holds at most
    four variants per base, so the collected arrays have a fixed bound.
    """
    generated = F.create_map(*[F.lit(x) for i, b in enumerate(REPLACEMENTS) for x in (b, i)])
    changed = F.array_position(
        F.zip_with(F.split("barcode", ""), F.split("variant", ""), lambda a, b: a != b), True
    ).cast("int")
    placed = curate_corrections(whitelist).withColumn("_at", changed)
    placed = placed.withColumn("_nth", generated[F.substring(F.col("variant"), F.col("_at"), F.lit(1))])
    ordered = F.sort_array(F.collect_list(F.struct("_at", "_nth", "variant")))
    listed = placed.groupBy("barcode").agg(F.transform(ordered, lambda s: s["variant"]).alias("variants"))
    return whitelist.join(listed, "barcode", "left").withColumn(
        "variants", F.coalesce("variants", F.array().cast("array<string>"))
    )


def collisions(whitelist: DataFrame) -> DataFrame:
    """Variants generated by several list rows, one output row per (variant, origin).

    ``origin_count`` is the number of generating rows of the variant. Origins stay as rows, so
    no group is collected.
    """
    shared = variant_origins(whitelist).filter(F.col("n_origins") > 1).select("variant", "n_origins")
    return (
        hamming1_variants(whitelist)
        .join(shared, "variant")
        .select("variant", F.col("n_origins").alias("origin_count"), F.col("barcode").alias("origin"))
    )


def collision_stats(whitelist: DataFrame) -> DataFrame:
    """A3: the five totals of the curation report, one row."""
    variants = variant_origins(whitelist).agg(
        F.count_if(F.col("n_origins") > 1).alias("total_variants_removed"),
        F.count_if(F.col("n_origins") == 1).alias("total_safe_variants"),
    )
    lists = whitelist.join(curate_corrections(whitelist).select("barcode").distinct().withColumn("_ok", F.lit(True)),
                           "barcode", "left").agg(
        F.count(F.lit(1)).alias("total_barcodes"),
        F.count_if(F.col("_ok")).alias("barcodes_with_corrections"),
        F.count_if(F.col("_ok").isNull()).alias("barcodes_without_corrections"),
    )
    both = lists.withColumn("_one", F.lit(1)).join(variants.withColumn("_one", F.lit(1)), "_one")
    return both.select(
        "total_barcodes",
        "barcodes_with_corrections",
        "barcodes_without_corrections",
        "total_variants_removed",
        "total_safe_variants",
    )


def last_correction(corrections: DataFrame) -> DataFrame:
    """One barcode per variant; the last line of an uncurated list wins."""
    return corrections.groupBy("variant").agg(F.max_by("barcode", "row_no").alias("barcode"))


def barcode_lookup(whitelist: DataFrame, corrections: DataFrame) -> DataFrame:
    """J1+J2 as one table ``observed -> barcode``: exact barcodes first, then corrections."""
    exact = whitelist.select("barcode").distinct()
    corrected = corrections.join(exact.withColumnRenamed("barcode", "variant"), "variant", "left_anti")
    return exact.select(F.col("barcode").alias("observed"), "barcode").unionByName(
        corrected.select(F.col("variant").alias("observed"), "barcode")
    )


def extract_barcode(reads: DataFrame, cfg: ReadQcConfig = ReadQcConfig()) -> DataFrame:
    """``observed`` barcode of each read pair, NULL when the mate is too short."""
    return reads.withColumn("observed", names.barcode_from_r2(F.col("r2_seq"), cfg.barcode_length))


def _status(observed: str, barcode: str):
    return (
        F.when(F.col(observed).isNull(), "too_short")
        .when(F.col(barcode).isNull(), "failed")
        .when(F.col(observed) == F.col(barcode), "direct")
        .otherwise("corrected")
    )


def match_barcodes(
    reads: DataFrame, lookup: DataFrame, cfg: ReadQcConfig = ReadQcConfig(), max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """P1+J1+J2: add ``observed``, ``barcode`` and ``barcode_status``.

    A lookup within the broadcast bound is joined in one step without moving the reads. A larger one
    has about fifty corrections per barcode, so the exact barcodes are joined alone first. The barcodes
    they miss are reduced to distinct values, which find their corrections in a plain join, and that
    small result is joined back by its measured size. The correction list is never repeated.
    """
    observed = extract_barcode(reads, cfg)
    size = footprint(lookup)
    if size.bytes <= max_bytes:
        joined = lookup_join(observed, lookup, ["observed"], "left", size=size, max_bytes=max_bytes)
        return joined.withColumn("barcode_status", _status("observed", "barcode"))
    is_exact = F.col("observed") == F.col("barcode")
    exact, corrections = lookup.filter(is_exact), lookup.filter(~is_exact)
    matched = lookup_join(observed, exact, ["observed"], "left", max_bytes=max_bytes)
    missed = matched.filter(F.col("barcode").isNull() & F.col("observed").isNotNull()).select("observed").distinct()
    found = materialize(missed.join(corrections.withColumnRenamed("barcode", "_found"), "observed"))
    joined = lookup_join(matched, found, ["observed"], "left", max_bytes=max_bytes)
    whole = joined.withColumn("barcode", F.coalesce("barcode", "_found")).drop("_found")
    return whole.withColumn("barcode_status", _status("observed", "barcode"))


def tag_read_name(matched: DataFrame) -> DataFrame:
    """Header with the corrected barcode."""
    return matched.withColumn("header", names.tagged_header(F.col("header"), F.col("barcode")))


def barcode_stats(reads: DataFrame, lookup: DataFrame, cfg: ReadQcConfig = ReadQcConfig()) -> DataFrame:
    """A4: read counts per outcome.

    Reads are counted per observed barcode first; only the distinct barcodes reach the join, so
    one very frequent barcode costs one row.
    """
    observed = (
        extract_barcode(reads, cfg).groupBy("sample", "observed").agg(F.count(F.lit(1)).alias("n"))
    )
    outcome = observed.join(lookup, "observed", "left").withColumn("_s", _status("observed", "barcode"))

    def total(*wanted: str):
        return F.coalesce(F.sum(F.when(F.col("_s").isin(*wanted), F.col("n"))), F.lit(0))

    return outcome.groupBy("sample").agg(
        F.sum("n").alias("total"),
        total("direct", "corrected").alias("passed"),
        total("failed", "too_short").alias("failed"),
        total("direct").alias("direct_match"),
        total("corrected").alias("corrected"),
    )


def parse_barcode(df: DataFrame, name_col: str = "read_name", rule: str = "counting", length: int = 13) -> DataFrame:
    """Barcode from a tagged read name under one of the two rules."""
    if rule == "counting":
        return df.withColumn("barcode", names.barcode_for_counting(F.col(name_col)))
    return df.withColumn("barcode", names.barcode_for_categorizing(F.col(name_col), length))
