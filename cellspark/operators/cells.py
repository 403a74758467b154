"""Cell calling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellspark.config import CellConfig
from cellspark.plans.scale import lookup_join


def density(totals: DataFrame, group: list[str], value: str, cfg: CellConfig = CellConfig()) -> DataFrame:
    """Gaussian density of log10(count + 1) at equally spaced points, Scott bandwidth.

    Exact, not sampled. Barcodes are first reduced to a histogram of distinct counts: a group with
    N counts in all has at most sqrt(2N) distinct values. Each histogram row adds its weighted
    kernel to the fixed number of grid points, combined in each task. Groups with fewer than two
    distinct values have no density and give no rows. Rows: group, ``i`` (0-based), ``x``, ``d``.
    """
    points = cfg.density_points
    histogram = totals.groupBy(*group, F.col(value).alias("_c")).agg(F.count(F.lit(1)).alias("_m"))
    logged = histogram.withColumn("_x", F.log10(F.col("_c") + 1))
    moments = logged.groupBy(*group).agg(
        F.sum("_m").alias("_n"),
        F.sum(F.col("_m") * F.col("_x")).alias("_sx"),
        F.sum(F.col("_m") * F.col("_x") * F.col("_x")).alias("_sxx"),
        F.min("_x").alias("_lo"),
        F.max("_x").alias("_hi"),
    ).filter(F.col("_hi") > F.col("_lo"))
    n = F.col("_n")
    variance = (F.col("_sxx") - F.col("_sx") * F.col("_sx") / n) / (n - 1)
    shape = moments.select(
        *group, "_n", "_lo", "_hi", (F.pow(n.cast("double"), F.lit(-0.2)) * F.sqrt(variance)).alias("_h")
    )
    spread = logged.join(shape, group).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    at = F.col("_lo") + F.col("i") * ((F.col("_hi") - F.col("_lo")) / F.lit(points - 1))
    z = (at - F.col("_x")) / F.col("_h")
    kernel = F.col("_m") * F.exp(z * z * F.lit(-0.5))
    norm = n * F.col("_h") * F.sqrt(F.lit(2.0) * F.pi())
    return spread.groupBy(*group, "i").agg(
        F.min(at).alias("x"), F.sum(kernel / norm).alias("d")
    )


def _along(group: list[str]) -> Window:
    """Window over the grid of one density curve (a fixed number of rows)."""
    return Window.partitionBy(*group).orderBy("i")


def local_minima(curve: DataFrame, group: list[str], cfg: CellConfig = CellConfig()) -> DataFrame:
    """Strict interior minima at or above the minimum threshold."""
    w = _along(group)
    lower = (F.col("d") < F.lag("d").over(w)) & (F.col("d") < F.lead("d").over(w))
    return curve.withColumn("_min", lower).filter(
        F.col("_min") & (F.col("x") >= F.log10(F.lit(cfg.minimum_count_threshold + 1)))
    ).drop("_min")


def derivatives(curve: DataFrame, group: list[str]) -> DataFrame:
    """First and second differences of the density, placed at interior grid points.

    The point i+1 carries the first difference of (i, i+1) and the second of (i, i+1, i+2).
    """
    w = _along(group)
    slope = curve.withColumn("_dx", F.lead("x").over(w) - F.col("x")).withColumn(
        "_f", (F.lead("d").over(w) - F.col("d")) / F.col("_dx")
    )
    bent = slope.withColumn("_s", (F.lead("_f").over(w) - F.col("_f")) / F.col("_dx"))
    return (
        bent.withColumn("first_derivative", F.lag("_f").over(w))
        .withColumn("second_derivative", F.lag("_s").over(w))
        .filter(F.col("second_derivative").isNotNull())
        .drop("_dx", "_f", "_s")
    )


def inflections(curve: DataFrame, group: list[str], cfg: CellConfig = CellConfig()) -> DataFrame:
    """Sign changes of the second difference where the density is nearly flat."""
    w = _along(group)
    d2 = F.col("second_derivative")
    return (
        derivatives(curve, group)
        .withColumn("_turn", F.lag(d2).over(w) * d2 < 0)
        .filter(
            F.col("_turn")
            & (F.col("x") >= F.log10(F.lit(cfg.minimum_count_threshold + 1)))
            & (F.abs("first_derivative") < cfg.max_inflection_slope)
        )
        .drop("_turn")
    )


def select_threshold(
    groups: DataFrame,
    curve: DataFrame,
    group: list[str],
    manual: DataFrame | None = None,
    cfg: CellConfig = CellConfig(),
) -> DataFrame:
    """Count threshold per group row of ``groups``.

    Order of preference: a manual value (log10 scale, 0 counts as not given), the lowest minimum,
    the lowest inflection, the minimum count. A group without a density gets the minimum count.
    Rows: group, ``log_cutoff`` and ``threshold``.
    """
    floor = F.log10(F.lit(cfg.minimum_count_threshold + 1))
    minima = local_minima(curve, group, cfg).groupBy(*group).agg(F.min("x").alias("_minimum"))
    turns = inflections(curve, group, cfg).groupBy(*group).agg(F.min("x").alias("_turn"))
    has_curve = curve.select(*group).distinct().withColumn("_curve", F.lit(True))
    joined = groups.select(*group).distinct()
    for part in (has_curve, minima, turns):
        joined = joined.join(part, group, "left")
    if manual is not None:
        joined = joined.join(manual.select(*group, F.col("manual_threshold").alias("_manual")), group, "left")
    else:
        joined = joined.withColumn("_manual", F.lit(None).cast("double"))
    cutoff = F.coalesce(F.nullif(F.col("_manual"), F.lit(0.0)), F.col("_minimum"), F.col("_turn"), floor)
    default = F.lit(int(cfg.minimum_count_threshold)).cast("long")
    found = F.bround(F.pow(F.lit(10.0), cutoff) - 1, 0).cast("long")
    return joined.select(
        *group,
        F.when(F.col("_curve"), cutoff).alias("log_cutoff"),
        F.when(F.col("_curve"), found).otherwise(default).alias("threshold"),
    )


def thresholds_single(totals: DataFrame, manual: DataFrame | None = None, cfg: CellConfig = CellConfig()) -> DataFrame:
    """Threshold per sample from the total counts."""
    curve = density(totals, ["sample"], "total_counts", cfg)
    return select_threshold(totals, curve, ["sample"], manual, cfg)


def species_totals(totals: DataFrame) -> DataFrame:
    """Barcodes with a species majority, with that species' count; ties belong to neither."""
    h, m = F.col("hsap_counts"), F.col("mmus_counts")
    return totals.withColumn("species", F.when(h > m, "hsap").when(m > h, "mmus")).filter(
        F.col("species").isNotNull()
    ).select("sample", "barcode", "species", F.greatest(h, m).alias("species_counts"))


def thresholds_mixed(totals: DataFrame, manual: DataFrame | None = None, cfg: CellConfig = CellConfig()) -> DataFrame:
    """``hsap_threshold, mmus_threshold`` per sample.

    If either species has fewer than two distinct counts, both take the minimum count.
    ``manual`` rows: ``sample, species, manual_threshold``.
    """
    group = ["sample", "species"]
    pairs = totals.select("sample").distinct().select(
        "sample", F.explode(F.array(F.lit("hsap"), F.lit("mmus"))).alias("species")
    )
    curve = density(species_totals(totals), group, "species_counts", cfg)
    each = select_threshold(pairs, curve, group, manual, cfg)
    default = F.lit(int(cfg.minimum_count_threshold)).cast("long")
    complete = F.count("log_cutoff") == 2

    def of(species: str):
        value = F.max(F.when(F.col("species") == species, F.col("threshold")))
        return F.when(complete, value).otherwise(default)

    return each.groupBy("sample").agg(of("hsap").alias("hsap_threshold"), of("mmus").alias("mmus_threshold"))


def flag_cells_single(totals: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``is_single_cell`` where the total reaches the sample's threshold."""
    joined = lookup_join(totals, thresholds.select("sample", "threshold"), ["sample"], "inner")
    return joined.withColumn("is_single_cell", F.col("total_counts") >= F.col("threshold"))


def flag_cells_mixed(totals: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Called, single, human and mouse cell flags."""
    h, m = F.col("hsap_counts"), F.col("mmus_counts")
    big_h, big_m = F.col("hsap_threshold"), F.col("mmus_threshold")
    joined = lookup_join(
        totals, thresholds.select("sample", "hsap_threshold", "mmus_threshold"), ["sample"], "inner"
    )
    hsap = (h >= big_h) & (m <= big_m)
    single = hsap | ((h <= big_h) & (m >= big_m))
    return (
        joined.withColumn("is_called_cell", (h >= big_h) | (m >= big_m))
        .withColumn("is_single_cell", single)
        .withColumn("is_hsap_cell", hsap)
        .withColumn("is_mmus_cell", single & ~hsap)
    )


def barcode_type(flagged: DataFrame) -> DataFrame:
    """P25: multiplet, noise or single-cell label of mixed-species barcodes."""
    h, m = F.col("hsap_counts"), F.col("mmus_counts")
    big_h, big_m = F.col("hsap_threshold"), F.col("mmus_threshold")
    label = (
        F.when((h > big_h) & (m > big_m), "multiplet").when((h < big_h) & (m < big_m), "noise").otherwise("single-cell")
    )
    return flagged.withColumn("barcode_type", label)
