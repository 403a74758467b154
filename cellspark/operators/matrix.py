"""Sparse count table and its row and column annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellspark.config import AssignConfig, GenomeSpec
from cellspark.functions import names
from cellspark.plans.scale import lookup_join, number_rows


def events(deduplicated: DataFrame, cfg: AssignConfig = AssignConfig()) -> DataFrame:
    """P3+P15: (sample, barcode, gene_id) of each deduplicated annotated alignment."""
    return deduplicated.filter(F.col("xt").isNotNull()).select(
        "sample",
        names.barcode_for_counting(F.col("read_name")).alias("barcode"),
        names.gene_from_tag(F.col("xt"), cfg.strict_ids).alias("gene_id"),
    )


def count_matrix(event_rows: DataFrame, whitelist: DataFrame) -> DataFrame:
    """J3+A19: ``sample, barcode, gene_id, n`` for whitelisted barcodes.

    Events are counted first, with map-side combining; the whitelist join then sees one row per
    matrix entry instead of one per read. A barcode listed twice counts once.
    """
    counted = event_rows.groupBy("sample", "barcode", "gene_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(whitelist.select("barcode").distinct(), "barcode", "left_semi").select(
        "sample", "barcode", "gene_id", "n"
    )


def annotate_genes(features: DataFrame, genome: GenomeSpec) -> DataFrame:
    """Mitochondrial and species flags per gene."""
    chromosome = F.col("chromosome")
    if not genome.mixed_species:
        return features.withColumn("is_mito", chromosome == genome.mito_chromosome)
    hsap_mito = chromosome == genome.hsap_mito_chromosome
    mmus_mito = chromosome == genome.mmus_mito_chromosome
    return (
        features.withColumn("is_mito", hsap_mito | mmus_mito)
        .withColumn("is_mito_hsap", hsap_mito)
        .withColumn("is_mito_mmus", mmus_mito)
        .withColumn("is_hsap", F.startswith("gene_name", F.lit(genome.hsap_gene_prefix)))
        .withColumn("is_mmus", F.startswith("gene_name", F.lit(genome.mmus_gene_prefix)))
    )


def named_counts(counts: DataFrame, features: DataFrame) -> DataFrame:
    """Counts with gene name and chromosome; unknown ids keep NULLs."""
    return counts.join(features.select("gene_id", "gene_name", "chromosome"), "gene_id", "left")


def cell_totals(counts: DataFrame, genes: DataFrame | None = None) -> DataFrame:
    """Total (and with species flags, per-species) counts and genes per barcode."""
    if genes is None:
        return counts.groupBy("sample", "barcode").agg(
            F.sum("n").alias("total_counts"), F.count(F.lit(1)).alias("n_genes")
        )
    flagged = counts.join(genes.select("gene_id", "is_hsap", "is_mmus"), "gene_id", "left")
    return flagged.groupBy("sample", "barcode").agg(
        F.sum("n").alias("total_counts"),
        F.sum(F.when(F.col("is_hsap"), F.col("n")).otherwise(0)).alias("hsap_counts"),
        F.sum(F.when(F.col("is_mmus"), F.col("n")).otherwise(0)).alias("mmus_counts"),
        F.count(F.lit(1)).alias("n_genes"),
    )


def _gene_use(counts: DataFrame, features: DataFrame, samples: list[str] | None) -> DataFrame:
    """Every (sample, gene) with ``seen``; genes counted but missing from the table are kept too.

    ``samples`` are the names of the sample sheet; without them the names in ``counts`` are used.
    """
    if samples is None:
        samples = sorted(r["sample"] for r in counts.select("sample").distinct().collect())
    names_array = F.array(*[F.lit(s) for s in samples]).cast("array<string>")
    every = features.select(
        F.explode(names_array).alias("sample"), "gene_id", "gene_name", "chromosome", "row_no"
    )
    seen = counts.select("sample", "gene_id").distinct().withColumn("seen", F.lit(True))
    return every.join(seen, ["sample", "gene_id"], "full").withColumn("seen", F.coalesce("seen", F.lit(False)))


def zero_genes(counts: DataFrame, features: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """Genes of the table that a sample never counted."""
    return _gene_use(counts, features, samples).filter(~F.col("seen")).select(
        "sample", "gene_id", "gene_name", "chromosome", "row_no"
    )


def index_genes(counts: DataFrame, features: DataFrame, samples: list[str] | None = None) -> DataFrame:
    """Gene positions per sample: counted genes by id, then the others in file order."""
    order = [
        F.when(F.col("seen"), 0).otherwise(1),
        F.when(F.col("seen"), F.col("gene_id")).otherwise(F.lit("")),
        F.coalesce("row_no", F.lit(-1)),
    ]
    return number_rows(_gene_use(counts, features, samples), ["sample"], order, "gene_index")


def index_barcodes(totals: DataFrame) -> DataFrame:
    """Barcode positions per sample in barcode order."""
    return number_rows(totals, ["sample"], [F.col("barcode")], "barcode_index")


def unique_gene_names(indexed: DataFrame) -> DataFrame:
    """Make gene names unique per sample with suffixes -1, -2, ... in index order.

    The first gene of a name keeps it. The k-th duplicate takes the k-th positive number whose
    suffixed name is not already a gene name: with the taken numbers t1 < t2 < ... shifted to
    ti - i, that number is the position of k in the merged order of both. A window holds the genes of
    one name in one sample, which are at most the genes of the annotation. Only duplicates, usually
    few, are joined back.
    """
    group = ["sample", "_base"]
    named = indexed.withColumn("_base", F.coalesce("gene_name", "gene_id"))
    ranked = named.select(*group, "gene_index").withColumn(
        "_nth", F.row_number().over(Window.partitionBy(*group).orderBy("gene_index"))
    )
    duplicates = ranked.filter(F.col("_nth") > 1)
    wanted = duplicates.select(
        *group, (F.col("_nth") - 1).alias("_key"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"), "gene_index"
    )
    taken = (
        named.select(
            "sample",
            F.regexp_extract("_base", r"^(.*)-[1-9]\d*$", 1).alias("_base"),
            F.regexp_extract("_base", r"-([1-9]\d*)$", 1).try_cast("long").alias("_t"),
        )
        .filter(F.col("_t").isNotNull())
        .distinct()
    )
    place = F.row_number().over(Window.partitionBy(*group).orderBy("_t"))
    blocked = taken.select(
        *group, (F.col("_t") - place).alias("_key"), F.lit(1).alias("_kind"), F.col("_t").alias("_tie"),
        F.lit(None).cast("long").alias("gene_index"),
    )
    merged = Window.partitionBy(*group).orderBy("_key", "_kind", "_tie")
    suffixed = wanted.unionByName(blocked).withColumn("_suffix", F.row_number().over(merged)).filter("_kind = 0")
    return (
        named.join(suffixed.select("sample", "gene_index", "_suffix"), ["sample", "gene_index"], "left")
        .withColumn(
            "unique_name",
            F.when(F.col("_suffix").isNull(), F.col("_base")).otherwise(
                F.concat("_base", F.lit("-"), F.col("_suffix").cast("string"))
            ),
        )
        .drop("_base", "_suffix")
    )


def matrix_entries(counts: DataFrame, genes: DataFrame, barcodes: DataFrame) -> DataFrame:
    """1-based (gene_index, barcode_index, n) triples of the genes x barcodes matrix."""
    by_barcode = lookup_join(counts, barcodes.select("sample", "barcode", "barcode_index"), ["sample", "barcode"], "inner")
    by_both = lookup_join(by_barcode, genes.select("sample", "gene_id", "gene_index"), ["gene_id", "sample"], "inner")
    return by_both.select("sample", "gene_index", "barcode_index", "n")


def filter_matrix(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """Counts of single cells only; the gene table is left as it is."""
    kept = cells.filter(F.col("is_single_cell")).select("sample", "barcode")
    return counts.join(kept, ["sample", "barcode"], "left_semi")
