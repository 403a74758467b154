"""Gene annotation tables (P16-P18, A30-A31, W9, O3-O4, J10 regions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellspark.functions import names
from cellspark.operators.intervals import clip_to_bins

# The region groups of the read distribution table, in print order.
REGION_GROUPS = (
    "CDS_Exons",
    "5'UTR_Exons",
    "3'UTR_Exons",
    "Introns",
    "TSS_up_1kb",
    "TSS_up_5kb",
    "TSS_up_10kb",
    "TES_down_1kb",
    "TES_down_5kb",
    "TES_down_10kb",
)
FLANKS = (1000, 5000, 10000)
REGION_BIN = 4096


def gtf_attribute(attributes: Column, key: str) -> Column:
    """Value of ``key "value"`` in a GTF attribute string; NULL when absent."""
    return F.nullif(F.regexp_extract(attributes, rf'(?:^|[;\s]){key} "([^"]*)"', 1), F.lit(""))


def features(gtf: DataFrame) -> DataFrame:
    """One row per gene id, the first in file order.

    Combined per task before the shuffle, so a gene with very many lines stays cheap.
    """
    gene_id = names.strip_version(gtf_attribute(F.col("attributes"), "gene_id"))
    rows = gtf.select(
        gene_id.alias("gene_id"),
        gtf_attribute(F.col("attributes"), "gene_name").alias("_name"),
        names.first_seqname(F.col("seqname")).alias("chromosome"),
        "row_no",
    ).filter(F.col("gene_id").isNotNull())
    first = rows.groupBy("gene_id").agg(
        F.min(F.struct("row_no", names.name_or_id(F.col("_name"), F.col("gene_id")).alias("gene_name"), "chromosome")).alias("f")
    )
    return first.select("gene_id", "f.gene_name", "f.chromosome", "f.row_no")


def distinct_features(gtf: DataFrame) -> DataFrame:
    """Distinct (gene_id, gene_name, chromosome) rows of the feature table."""
    gene_id = names.strip_version(gtf_attribute(F.col("attributes"), "gene_id"))
    name = gtf_attribute(F.col("attributes"), "gene_name")
    return (
        gtf.select(
            gene_id.alias("gene_id"),
            names.name_or_id(name, gene_id).alias("gene_name"),
            names.first_seqname(F.col("seqname")).alias("chromosome"),
        )
        .filter(F.col("gene_id").isNotNull())
        .distinct()
    )


def gene_intervals(gtf: DataFrame, *kinds: str) -> DataFrame:
    """Rows ``gene_id, feature, chrom, strand, start, end`` of some feature types (raw gene ids)."""
    return gtf.filter(F.col("feature").isin(*kinds)).select(
        gtf_attribute(F.col("attributes"), "gene_id").alias("gene_id"),
        "feature",
        F.col("seqname").alias("chrom"),
        "strand",
        "start",
        "end",
    )


def gene_models(gtf: DataFrame) -> DataFrame:
    """One row per transcript with sorted exons and coding bounds.

    Exon order and the closing end follow the start-sorted exons; chromosome and strand come from
    the first exon line in the file; of several codon lines the last one counts. On the reverse
    strand the codons swap roles and move by two bases.
    """
    tagged = gtf.withColumn("transcript_id", gtf_attribute(F.col("attributes"), "transcript_id")).filter(
        F.col("transcript_id").isNotNull() & (F.col("seqname") != "")
    )
    is_exon = F.col("feature").isin("exon", "miRNA")
    exon = F.when(is_exon, F.struct("start", "row_no", "end"))
    head = F.when(is_exon, F.struct("row_no", F.col("seqname").alias("chrom"), "strand", "start"))
    start_codon = F.when(F.col("feature") == "start_codon", F.struct("row_no", F.col("start").alias("at")))
    stop_codon = F.when(F.col("feature") == "stop_codon", F.struct("row_no", F.col("end").alias("at")))
    grouped = (
        tagged.filter(is_exon | F.col("feature").isin("start_codon", "stop_codon"))
        .groupBy("transcript_id")
        .agg(
            F.min(head).alias("_head"),
            F.sort_array(F.collect_list(exon)).alias("_exons"),
            F.max(start_codon)["at"].alias("_start_codon"),
            F.max(stop_codon)["at"].alias("_stop_codon"),
        )
        .filter(F.size("_exons") > 0)
    )
    reverse = F.col("_head.strand") == "-"
    low = F.when(reverse, F.col("_stop_codon") - 2).otherwise(F.col("_start_codon"))
    high = F.when(reverse, F.col("_start_codon") + 2).otherwise(F.col("_stop_codon"))
    first = F.col("_exons")[0]["start"]
    last = F.element_at("_exons", -1)["end"]
    return grouped.select(
        "transcript_id",
        F.col("_head.chrom").alias("chrom"),
        F.col("_head.strand").alias("strand"),
        F.col("_head.start").alias("first_exon_start"),
        first.alias("start"),
        last.alias("end"),
        F.coalesce(low, first).alias("cds_start"),
        F.coalesce(high, last).alias("cds_end"),
        F.size("_exons").alias("exon_count"),
        F.transform("_exons", lambda e: e["end"] - e["start"] + 1).alias("block_sizes"),
        F.transform("_exons", lambda e: e["start"] - first).alias("block_starts"),
    )


def _region_intervals(models: DataFrame) -> DataFrame:
    """Raw intervals ``kind, chrom, start, end`` of every region kind before overlaps are resolved."""
    exon = F.explode(F.arrays_zip(F.col("block_starts").alias("o"), F.col("block_sizes").alias("n")))
    exons = models.select("chrom", "strand", "cds_start", "cds_end", F.col("start").alias("_t"), exon.alias("_x")).select(
        "chrom",
        "strand",
        "cds_start",
        "cds_end",
        (F.col("_t") + F.col("_x.o")).alias("s"),
        (F.col("_t") + F.col("_x.o") + F.col("_x.n") - 1).alias("e"),
    )
    forward = F.col("strand") != "-"
    before = F.struct(
        F.when(forward, "5'UTR_Exons").otherwise("3'UTR_Exons").alias("kind"),
        F.col("s").alias("start"),
        F.least(F.col("e"), F.col("cds_start") - 1).alias("end"),
    )
    after = F.struct(
        F.when(forward, "3'UTR_Exons").otherwise("5'UTR_Exons").alias("kind"),
        F.greatest(F.col("s"), F.col("cds_end") + 1).alias("start"),
        F.col("e").alias("end"),
    )
    coding = F.struct(
        F.lit("CDS_Exons").alias("kind"),
        F.greatest("s", "cds_start").alias("start"),
        F.least("e", "cds_end").alias("end"),
    )
    from_exons = exons.select("chrom", F.inline(F.array(coding, before, after)))

    gap_index = F.explode(F.sequence(F.lit(1), F.size("block_starts") - 1))
    gaps = models.filter(F.size("block_starts") > 1).withColumn("_i", gap_index)
    introns = gaps.select(
        "chrom",
        F.lit("Introns").alias("kind"),
        (F.col("start") + F.element_at("block_starts", F.col("_i")) + F.element_at("block_sizes", F.col("_i"))).alias("start"),
        (F.col("start") + F.element_at("block_starts", F.col("_i") + 1) - 1).alias("end"),
    )

    flanks = []
    for size in FLANKS:
        left = F.struct(
            F.when(forward, f"TSS_up_{size // 1000}kb").otherwise(f"TES_down_{size // 1000}kb").alias("kind"),
            F.greatest(F.col("start") - size, F.lit(1)).alias("start"),
            (F.col("start") - 1).alias("end"),
        )
        right = F.struct(
            F.when(forward, f"TES_down_{size // 1000}kb").otherwise(f"TSS_up_{size // 1000}kb").alias("kind"),
            (F.col("end") + 1).alias("start"),
            (F.col("end") + size).alias("end"),
        )
        flanks += [left, right]
    intergenic = models.select("chrom", F.inline(F.array(*flanks)))
    return (
        from_exons.unionByName(introns).unionByName(intergenic).filter(F.col("end") >= F.col("start"))
    )


def distribution_regions(models: DataFrame, bin_size: int = REGION_BIN) -> DataFrame:
    """Disjoint segments with the region groups they belong to.

    Intervals are clipped to fixed bins and swept inside each bin, so a window partition holds at
    most ``bin_size`` + 1 positions whatever the annotation looks like. CDS wins over UTR, UTR
    over introns, introns over the flanking windows; a segment can lie in both UTR kinds or in
    several flanking windows. Rows: ``chrom, bin, start, end, groups, ambiguous``.
    """
    clipped = clip_to_bins(_region_intervals(models), "start", "end", bin_size).select(
        "kind", "chrom", "bin", "start", "end"
    ).distinct()
    steps = clipped.select(
        "chrom",
        "bin",
        "kind",
        F.inline(
            F.array(
                F.struct(F.col("start").alias("at"), F.lit(1).alias("d")),
                F.struct((F.col("end") + 1).alias("at"), F.lit(-1).alias("d")),
            )
        ),
    )
    deltas = steps.groupBy("chrom", "bin", "at").agg(
        *[F.sum(F.when(F.col("kind") == g, F.col("d")).otherwise(0)).alias(f"d{i}") for i, g in enumerate(REGION_GROUPS)]
    )
    along = Window.partitionBy("chrom", "bin").orderBy("at")
    depth = [
        (F.sum(f"d{i}").over(along.rowsBetween(Window.unboundedPreceding, 0)) > 0).alias(f"in{i}")
        for i in range(len(REGION_GROUPS))
    ]
    swept = deltas.select(
        "chrom", "bin", F.col("at").alias("start"), (F.lead("at").over(along) - 1).alias("end"), *depth
    ).filter(F.col("end").isNotNull())
    covered = [F.col(f"in{i}") for i in range(len(REGION_GROUPS))]
    cds, utr5, utr3, intron = covered[:4]
    gene_body = cds | utr5 | utr3 | intron
    exclusive = [cds, utr5 & ~cds, utr3 & ~cds, intron & ~(cds | utr5 | utr3)] + [
        c & ~gene_body for c in covered[4:]
    ]
    groups = F.filter(
        F.array(*[F.when(c, F.lit(g)) for c, g in zip(exclusive, REGION_GROUPS)]), lambda g: g.isNotNull()
    )
    both_utr = exclusive[1] & exclusive[2]
    both_flanks = exclusive[6] & exclusive[9]
    return swept.select(
        "chrom", "bin", "start", "end", groups.alias("groups"), (both_utr | both_flanks).alias("ambiguous")
    ).filter(F.size("groups") > 0)
