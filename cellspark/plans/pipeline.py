"""End-to-end stages over all samples at once.

Between stages only tables that later steps read several times are written to the shared folder:
annotated alignments, the sparse counts, totals, thresholds and cells. Everything else stays lazy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.config import EngineConfig
from cellspark.operators import annotation, assign, barcodes, cells, dedup, matrix, metrics, reads_qc, report
from cellspark.plans.scale import materialize


@dataclass(frozen=True)
class MatrixTables:
    genes: DataFrame
    counts: DataFrame
    totals: DataFrame


@dataclass(frozen=True)
class CellTables:
    thresholds: DataFrame
    cells: DataFrame


def read_stage(reads: DataFrame, whitelist: DataFrame, corrections: DataFrame | None = None,
               cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """Read pairs to QC rows; corrections are curated from the whitelist unless given."""
    known = corrections if corrections is not None else barcodes.curate_corrections(whitelist)
    lookup = materialize(barcodes.barcode_lookup(whitelist, known))
    return reads_qc.qc_reads(barcodes.match_barcodes(reads, lookup, cfg.qc), cfg.qc)


# Alignment columns the stages use; sequences and qualities are never read.
ALIGNMENT_COLUMNS = ("sample", "read_name", "flag", "chrom", "pos", "mapq", "cigar", "nh", "hi", "nm")


def annotate_stage(alignments: DataFrame, gtf: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """Alignments to annotated alignments with their gene in ``xt``."""
    narrow = alignments.select(*ALIGNMENT_COLUMNS)
    return assign.annotate(narrow, assign.feature_index(gtf, cfg.assign), cfg.assign)


def matrix_stage(annotated: DataFrame, gtf: DataFrame, whitelist: DataFrame,
                 cfg: EngineConfig = EngineConfig()) -> MatrixTables:
    """Annotated alignments to sparse counts, gene flags and per-barcode totals."""
    genes = matrix.annotate_genes(annotation.features(gtf), cfg.genome)
    kept = matrix.events(dedup.dedup(annotated, keep=["sample", "read_name", "xt"]), cfg.assign)
    counts = materialize(matrix.count_matrix(kept, whitelist))
    totals = materialize(matrix.cell_totals(counts, genes if cfg.genome.mixed_species else None))
    return MatrixTables(genes, counts, totals)


def cell_stage(tables: MatrixTables, manual: DataFrame | None = None,
               cfg: EngineConfig = EngineConfig()) -> CellTables:
    """Thresholds and flagged barcodes."""
    if cfg.genome.mixed_species:
        thresholds = materialize(cells.thresholds_mixed(tables.totals, manual, cfg.cells))
        flagged = cells.barcode_type(cells.flag_cells_mixed(tables.totals, thresholds))
    else:
        thresholds = materialize(cells.thresholds_single(tables.totals, manual, cfg.cells))
        flagged = cells.flag_cells_single(tables.totals, thresholds)
    return CellTables(thresholds, materialize(flagged))


def distribution_stage(alignments: DataFrame, regions: DataFrame, stage: str, first: int,
                       samples: DataFrame | None = None) -> DataFrame:
    """Metric rows of one read-distribution stage."""
    tags = materialize(metrics.tag_counts(alignments, regions))
    totals = metrics.read_distribution_totals(tags, samples)
    percents = metrics.distribution_percent(metrics.read_distribution(tags, regions, samples), totals)
    return report.distribution_rows(percents, totals, stage, first)


def metrics_stage(qc: DataFrame, alignments: DataFrame, gtf: DataFrame, whitelist: DataFrame,
                  samples: DataFrame, manual: DataFrame | None = None,
                  cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """Every metric of every sample as one long table.

    ``samples`` decides which samples appear: one without reads or alignments gets zero rows.
    """
    mixed = cfg.genome.mixed_species
    cascade = materialize(_fill(samples, reads_qc.qc_cascade(qc, cfg.qc)))
    annotated = materialize(annotate_stage(alignments, gtf, cfg))
    tables = matrix_stage(annotated, gtf, whitelist, cfg)
    called = cell_stage(tables, manual, cfg)
    raw = cascade.select("sample", "raw_reads")
    categorized = metrics.categorize_reads(alignments, called.cells, raw, cfg.qc.barcode_length)
    in_out = _fill(samples, metrics.counts_in_out_cells(called.cells))
    per_cell = metrics.cell_metrics_mixed if mixed else metrics.cell_metrics_single
    cell_stats = per_cell(tables.counts, called.cells, tables.genes, raw)
    removed = _fill(samples, dedup.dedup_stats_single_pass(annotated))
    regions = materialize(annotation.distribution_regions(annotation.gene_models(gtf)))
    parts = [
        report.read_qc_rows(cascade, reads_qc.derived_read_metrics(cascade)),
        report.category_rows(categorized, in_out),
        report.cell_metric_rows(cell_stats, mixed),
        report.dedup_rows(removed),
        distribution_stage(alignments, regions, "raw", 600, samples),
        distribution_stage(annotated, regions, "annotated", 700, samples),
    ]
    if mixed:
        parts.append(report.multiplet_rows(_fill(samples, metrics.called_and_multiplets(called.cells))))
    return report.metrics_long(*parts)


def _fill(samples: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per sample of the sheet; a sample without rows gets zeros."""
    joined = samples.select("sample").distinct().join(stats, "sample", "left")
    return joined.select("sample", *[F.coalesce(c, F.lit(0)).alias(c) for c in stats.columns if c != "sample"])
