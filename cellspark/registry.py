"""One named query per operator over the bridged test tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.config import GENOMES, AssignConfig, CellConfig, EngineConfig
from cellspark.functions import alignments as al
from cellspark.functions import formatting, names, sequences
from cellspark.operators import (
    annotation,
    assign,
    barcodes,
    cells,
    dedup,
    intervals,
    matrix,
    metrics,
    profiles,
    reads_qc,
    report,
)
from cellspark.plans import bridge, pipeline
from cellspark.plans.scale import checkpoint_root, materialize
from cellspark.sources import fastq, readers, regions, sam, single_file, sparse, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The bridge packs a gene every 400 bases, so its annotation bins are narrow.
ASSIGN = AssignConfig(bin_size=512)
CELLS = CellConfig(minimum_count_threshold=20.0)
SINGLE = EngineConfig(assign=ASSIGN, cells=CELLS, genome=GENOMES["GRCh38"])
MIXED = EngineConfig(assign=ASSIGN, cells=CELLS, genome=GENOMES["mouse_human_mix"])
DIGITS = 6


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _round(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    """Samples of the sheet, and one more that has no rows anywhere."""
    listed = bridge.table(spark, sf, "lineitem").selectExpr(f"{bridge.SAMPLE} AS sample").distinct()
    return listed.withColumn("sample", F.explode(F.array("sample", F.lit("S9")))).distinct()


def _reads(spark, sf):
    return bridge.staged(spark, sf, "reads")


def _whitelist(spark, sf):
    return bridge.staged(spark, sf, "whitelist")


def _gtf(spark, sf, mixed=False):
    return bridge.staged(spark, sf, "gtf", mixed=mixed)


def _alignments(spark, sf, mixed=False, copies=False):
    rows = bridge.staged(spark, sf, "alignments", mixed=mixed, copies=copies)
    return rows.select(*pipeline.ALIGNMENT_COLUMNS)


# --- reads -----------------------------------------------------------------------------------

def _lookup(spark: SparkSession, sf: str) -> DataFrame:
    wl = _whitelist(spark, sf)
    return materialize(barcodes.barcode_lookup(wl, barcodes.curate_corrections(wl)))


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    return barcodes.match_barcodes(_reads(spark, sf), _lookup(spark, sf))


def _qc(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.read_stage(_reads(spark, sf), _whitelist(spark, sf))


@query
def hamming_variants(spark, sf):
    return barcodes.hamming1_variants(_whitelist(spark, sf)).select("barcode", "variant", "position")


@query
def curated_corrections(spark, sf):
    return barcodes.curate_corrections(_whitelist(spark, sf))


@query
def correction_list(spark, sf):
    rows = barcodes.correction_list(_whitelist(spark, sf))
    return rows.select("row_no", "barcode", F.concat_ws(",", "variants").alias("variants"))


@query
def collisions(spark, sf):
    return barcodes.collisions(_whitelist(spark, sf))


@query
def collision_stats(spark, sf):
    return barcodes.collision_stats(_whitelist(spark, sf))


@query
def last_correction(spark, sf):
    every = barcodes.hamming1_variants(_whitelist(spark, sf)).filter("variant <> barcode")
    return barcodes.last_correction(every)


@query
def extract_barcode(spark, sf):
    return barcodes.extract_barcode(_reads(spark, sf)).select("sample", "header", "observed")


@query
def match_barcodes(spark, sf):
    return _matched(spark, sf).select("sample", "header", "observed", "barcode", "barcode_status")


@query
def tag_read_name(spark, sf):
    kept = _matched(spark, sf).filter(F.col("barcode").isNotNull())
    return barcodes.tag_read_name(kept).select("sample", "header")


@query
def parse_barcode(spark, sf):
    rows = _alignments(spark, sf).select(
        "sample", "hi", F.when(F.col("nm") == 1, F.concat("read_name", F.lit("x"))).otherwise(F.col("read_name")).alias("read_name")
    )
    counted = barcodes.parse_barcode(rows, rule="counting").withColumnRenamed("barcode", "counting")
    return barcodes.parse_barcode(counted, rule="categorize").withColumnRenamed("barcode", "categorizing")


@query
def barcode_stats(spark, sf):
    return barcodes.barcode_stats(_reads(spark, sf), _lookup(spark, sf))


@query
def trim_steps(spark, sf):
    """P5-P10 each on the raw read, independent of the cascade."""
    s = F.col("r1_seq")
    return _reads(spark, sf).select(
        "sample",
        "header",
        F.substring(s, 9, 100).alias("sss_trimmed"),
        sequences.polyx_keep(s, 10).alias("polyx_keep"),
        sequences.polya_start(s, 15, 13).alias("polya_start"),
        sequences.low_quality(F.col("r1_qual"), 15, 40).alias("low_quality"),
        sequences.n_bases(s).alias("n_bases"),
        sequences.phred_sum(F.col("r1_qual")).alias("phred_sum"),
    )


@query
def qc_reads(spark, sf):
    return _qc(spark, sf).select(
        "sample", "header", "lost_at", "out_seq", "out_qual", "polyx_trimmed", "polya_trimmed"
    )


@query
def qc_cascade(spark, sf):
    return reads_qc.qc_cascade(_qc(spark, sf))


@query
def derived_read_metrics(spark, sf):
    return reads_qc.derived_read_metrics(reads_qc.qc_cascade(_qc(spark, sf)))


@query
def read_summary(spark, sf):
    return profiles.read_summary(profiles.profiled_reads(_qc(spark, sf)))


def _profile(spark, sf):
    return profiles.position_profile(profiles.profiled_reads(_qc(spark, sf)))


@query
def quality_curve(spark, sf):
    return profiles.quality_curve(_profile(spark, sf))


@query
def gc_curve(spark, sf):
    return profiles.gc_curve(_profile(spark, sf))


@query
def n_curve(spark, sf):
    return profiles.n_curve(_profile(spark, sf))


@query
def length_distribution(spark, sf):
    return profiles.length_distribution(profiles.profiled_reads(_qc(spark, sf)))


@query
def qc_json_documents(spark, sf):
    """S15 written and read back: fields of the JSON documents."""
    docs = profiles.qc_summary_json(profiles.profiled_reads(_qc(spark, sf)))
    part = F.when(F.col("kind") == "R1 Post-QC", "after").otherwise("before")

    def field(path: str):
        return F.coalesce(
            F.get_json_object("document", f"$.summary.before_filtering.{path}"),
            F.get_json_object("document", f"$.summary.after_filtering.{path}"),
        )

    def detail(path: str):
        return F.coalesce(
            F.get_json_object("document", f"$.read1_before_filtering.{path}"),
            F.get_json_object("document", f"$.read1_after_filtering.{path}"),
        )

    return docs.select(
        "sample",
        "kind",
        part.alias("part"),
        field("total_reads").cast("long").alias("total_reads"),
        field("q30_bases").cast("long").alias("q30_bases"),
        F.round(detail("quality_curves.mean[0]").cast("double"), 6).alias("first_quality"),
        F.round(detail("content_curves.GC[1]").cast("double"), 6).alias("second_gc"),
    )


# --- annotation ------------------------------------------------------------------------------

@query
def features(spark, sf):
    return annotation.features(_gtf(spark, sf)).select("gene_id", "gene_name", "chromosome")


@query
def distinct_features(spark, sf):
    return annotation.distinct_features(_gtf(spark, sf))


@query
def annotate_genes(spark, sf):
    genes = annotation.features(_gtf(spark, sf, True))
    return matrix.annotate_genes(genes, MIXED.genome).drop("row_no")


@query
def gene_models(spark, sf):
    models = annotation.gene_models(_gtf(spark, sf))
    return models.withColumn("block_sizes", F.concat_ws(",", F.transform("block_sizes", lambda b: b.cast("string")))).withColumn(
        "block_starts", F.concat_ws(",", F.transform("block_starts", lambda b: b.cast("string")))
    )


def _regions(spark, sf):
    return materialize(annotation.distribution_regions(annotation.gene_models(_gtf(spark, sf))))


@query
def region_bases(spark, sf):
    """Bases per region group after overlaps are resolved."""
    rows = _regions(spark, sf).select("chrom", F.explode("groups").alias("grp"), (F.col("end") - F.col("start") + 1).alias("n"))
    return rows.groupBy("chrom", "grp").agg(F.sum("n").alias("bases"))


# --- alignments ------------------------------------------------------------------------------

def _index(spark, sf, mixed=False):
    return assign.feature_index(_gtf(spark, sf, mixed), ASSIGN)


def _annotated(spark, sf, mixed=False, copies=False):
    cfg = MIXED if mixed else SINGLE
    return pipeline.annotate_stage(_alignments(spark, sf, mixed, copies), _gtf(spark, sf, mixed), cfg)


@query
def overlap_join(spark, sf):
    """J7 as pairs: alignment spans and transcripts on the same strand that share bases."""
    spans = _alignments(spark, sf).select(
        "sample", "read_name", "hi", "chrom", al.strand(F.col("flag")).alias("strand"), F.col("pos").alias("start"),
        al.reference_end(F.col("pos"), F.col("cigar")).alias("end"),
    )
    transcripts = annotation.gene_intervals(_gtf(spark, sf), "transcript")
    pairs = intervals.overlap_join(spans, transcripts, ["chrom", "strand"], 4096)
    shared = F.least("end", "r_end") - F.greatest("start", "r_start") + 1
    return pairs.select("sample", "read_name", "hi", F.col("r_gene_id").alias("gene_id"), shared.alias("shared"))


def _assigned(spark, sf, level):
    return assign.assign_features(_alignments(spark, sf), _index(spark, sf), level)


@query
def assign_transcripts(spark, sf):
    return _assigned(spark, sf, "transcript").select("sample", "read_name", "hi", "xs", "xn", "xt")


@query
def assign_exons(spark, sf):
    return _assigned(spark, sf, "exon").select("sample", "read_name", "hi", "xs", "xn", "xt")


ODD_CIGARS = ("40M", "5S35M", "20M2D20M", "10M3I27M", "8=2X30M", "*")


@query
def assign_odd_alignments(spark, sf):
    """A13 over clips, deletions, insertions, = and X, alignments without blocks, and equal rows."""
    cigar = F.element_at(F.array(*[F.lit(c) for c in ODD_CIGARS]), (F.col("pos") % len(ODD_CIGARS) + 1).cast("int"))
    rows = _alignments(spark, sf).withColumn("cigar", cigar)
    twice = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("pos") % 5 == 0, 2).otherwise(1)))).drop("copy")
    found = assign.assign_levels(twice, _index(spark, sf), ASSIGN)
    end = F.when(F.col("cigar") != "*", al.five_prime(F.col("flag"), F.col("pos"), F.col("cigar")))
    return found.select("sample", "read_name", "cigar", "tx_status", "tx_gene", "ex_status", "ex_gene", end.alias("five_prime"))


@query
def assignment_summary(spark, sf):
    return assign.assignment_summary(_assigned(spark, sf, "transcript"))


@query
def gene_assignment_counts(spark, sf):
    return assign.gene_assignment_counts(_assigned(spark, sf, "transcript"))


@query
def filter_umr(spark, sf):
    return assign.filter_umr(_alignments(spark, sf)).select("sample", "read_name", "flag", "chrom", "pos")


@query
def filter_multimapped(spark, sf):
    return assign.filter_multimapped(_alignments(spark, sf)).select("sample", "read_name", "hi", "chrom", "pos")


@query
def umr_tie_break(spark, sf):
    """Ambiguous unique alignments that one exon settles."""
    index = _index(spark, sf)
    first = assign.assign_features(assign.filter_umr(_alignments(spark, sf)), index, "transcript")
    second = assign.assign_features(assign.filter_ambiguous(first), index, "exon")
    return assign.filter_assigned(second).select("sample", "read_name", "xt")


def _resolve(spark, sf):
    multi = assign.filter_multimapped(_alignments(spark, sf))
    return assign.resolve_multimappers(assign.assign_features(multi, _index(spark, sf), "transcript"))


@query
def resolve_multimappers(spark, sf):
    return _resolve(spark, sf)[0].select("sample", "read_name", "nh", "hi", "chrom", "pos", "xt")


@query
def multimapper_tie_break(spark, sf):
    """Alignments that go on to the exon pass."""
    return _resolve(spark, sf)[1].select("sample", "read_name", "nh", "hi", "chrom", "pos")


@query
def annotated_alignments(spark, sf):
    return _annotated(spark, sf).select("sample", "read_name", "nh", "hi", "chrom", "pos", "xt")


@query
def count_alignments(spark, sf):
    return assign.count_alignments(_annotated(spark, sf))


@query
def dedup_alignments(spark, sf):
    kept = dedup.dedup(_annotated(spark, sf, copies=True))
    return kept.select("sample", "chrom", "pos", "read_name", "flag", "mapq", "xt")


@query
def dedup_stats(spark, sf):
    return _round(dedup.dedup_stats_single_pass(_annotated(spark, sf, copies=True)), "sequencing_saturation")


# --- matrix ----------------------------------------------------------------------------------

def _tables(spark, sf, cfg=SINGLE):
    mixed = cfg.genome.mixed_species
    return pipeline.matrix_stage(_annotated(spark, sf, mixed), _gtf(spark, sf, mixed), _whitelist(spark, sf), cfg)


@query
def events(spark, sf):
    return matrix.events(dedup.dedup(_annotated(spark, sf)))


@query
def count_matrix(spark, sf):
    return matrix.count_matrix(matrix.events(dedup.dedup(_annotated(spark, sf))), _whitelist(spark, sf))


@query
def named_counts(spark, sf):
    tables = _tables(spark, sf)
    return matrix.named_counts(tables.counts, tables.genes)


@query
def cell_totals(spark, sf):
    return _tables(spark, sf).totals


@query
def cell_totals_mixed(spark, sf):
    return _tables(spark, sf, MIXED).totals


@query
def zero_genes(spark, sf):
    tables = _tables(spark, sf)
    return matrix.zero_genes(tables.counts, tables.genes, bridge.sample_names(spark, sf)).select("sample", "gene_id", "gene_name")


@query
def index_genes(spark, sf):
    tables = _tables(spark, sf)
    return matrix.index_genes(tables.counts, tables.genes, bridge.sample_names(spark, sf)).select("sample", "gene_id", "gene_index")


@query
def index_barcodes(spark, sf):
    return matrix.index_barcodes(_tables(spark, sf).totals).select("sample", "barcode", "barcode_index")


@query
def unique_gene_names(spark, sf):
    tables = _tables(spark, sf)
    indexed = matrix.index_genes(tables.counts, tables.genes, bridge.sample_names(spark, sf))
    return matrix.unique_gene_names(indexed).select("sample", "gene_id", "unique_name")


@query
def matrix_entries(spark, sf):
    tables = _tables(spark, sf)
    genes = matrix.index_genes(tables.counts, tables.genes, bridge.sample_names(spark, sf))
    return matrix.matrix_entries(tables.counts, genes, matrix.index_barcodes(tables.totals))


@query
def filtered_matrix(spark, sf):
    tables = _tables(spark, sf)
    called = pipeline.cell_stage(tables, cfg=SINGLE)
    return matrix.filter_matrix(tables.counts, called.cells)


# --- cells -----------------------------------------------------------------------------------

def _curve(spark, sf):
    return cells.density(_tables(spark, sf).totals, ["sample"], "total_counts", SINGLE.cells)


@query
def density_curve(spark, sf):
    return _round(_curve(spark, sf), "x", "d")


@query
def local_minima(spark, sf):
    return _round(cells.local_minima(_curve(spark, sf), ["sample"], SINGLE.cells), "x", "d")


@query
def derivatives(spark, sf):
    rows = cells.derivatives(_curve(spark, sf), ["sample"]).select("sample", "i", "first_derivative", "second_derivative")
    return _round(rows, "first_derivative", "second_derivative", digits=4)


SHOULDER = "CASE WHEN u < 800 THEN 60 + a + b + d ELSE 150 + a * a * a div 50 + b END"


@query
def inflections(spark, sf):
    """W3 over counts with a long flat tail, where the density turns without falling much."""
    parts = bridge.table(spark, sf, "lineitem").selectExpr(
        f"{bridge.SAMPLE} AS sample", "(l_orderkey * 7919 + l_linenumber * 104729) % 1000 AS u",
        "l_partkey * 31 % 101 AS a", "l_suppkey * 17 % 97 AS b", "(l_orderkey * 13 + l_linenumber * 7) % 89 AS d",
    )
    curve = cells.density(parts.selectExpr("sample", f"{SHOULDER} AS total_counts"), ["sample"], "total_counts", SINGLE.cells)
    return _round(cells.inflections(curve, ["sample"], SINGLE.cells).select("sample", "i", "x"), "x")


@query
def thresholds(spark, sf):
    return _round(cells.thresholds_single(_tables(spark, sf).totals, None, SINGLE.cells), "log_cutoff")


@query
def thresholds_manual(spark, sf):
    """S0 has a manual threshold, S1 a zero one, which counts as not given."""
    manual = _samples(spark, sf).selectExpr(
        "sample", "CASE sample WHEN 'S0' THEN 2.4D WHEN 'S1' THEN 0D END AS manual_threshold"
    )
    return _round(cells.thresholds_single(_tables(spark, sf).totals, manual, SINGLE.cells), "log_cutoff")


@query
def thresholds_mixed(spark, sf):
    return cells.thresholds_mixed(_tables(spark, sf, MIXED).totals, None, MIXED.cells)


@query
def cells_single(spark, sf):
    called = pipeline.cell_stage(_tables(spark, sf), cfg=SINGLE).cells
    return called.select("sample", "barcode", "total_counts", "n_genes", "threshold", "is_single_cell")


@query
def cells_mixed(spark, sf):
    return pipeline.cell_stage(_tables(spark, sf, MIXED), cfg=MIXED).cells


# --- metrics ---------------------------------------------------------------------------------

def _raw_reads(spark, sf):
    counted = _reads(spark, sf).groupBy("sample").agg(F.count(F.lit(1)).alias("raw_reads"))
    return reads_qc.route_samples(_samples(spark, sf), counted, "raw_reads").drop("has_reads")


@query
def route_samples(spark, sf):
    counted = assign.filter_umr(_alignments(spark, sf)).groupBy("sample").agg(F.count(F.lit(1)).alias("umr"))
    return reads_qc.route_samples(_samples(spark, sf), counted, "umr")


@query
def categorize_reads(spark, sf):
    called = pipeline.cell_stage(_tables(spark, sf), cfg=SINGLE).cells
    return metrics.categorize_reads(_alignments(spark, sf), called, _raw_reads(spark, sf))


@query
def counts_in_out_cells(spark, sf):
    return metrics.counts_in_out_cells(pipeline.cell_stage(_tables(spark, sf), cfg=SINGLE).cells)


@query
def cell_metrics_single(spark, sf):
    tables = _tables(spark, sf)
    called = pipeline.cell_stage(tables, cfg=SINGLE).cells
    return metrics.cell_metrics_single(tables.counts, called, tables.genes, _raw_reads(spark, sf))


@query
def cell_metrics_mixed(spark, sf):
    tables = _tables(spark, sf, MIXED)
    called = pipeline.cell_stage(tables, cfg=MIXED).cells
    return metrics.cell_metrics_mixed(tables.counts, called, tables.genes, _raw_reads(spark, sf))


@query
def multiplets(spark, sf):
    return metrics.called_and_multiplets(pipeline.cell_stage(_tables(spark, sf, MIXED), cfg=MIXED).cells)


def _tags(spark, sf, regions):
    return materialize(metrics.tag_counts(_alignments(spark, sf), regions))


@query
def read_distribution(spark, sf):
    regions = _regions(spark, sf)
    return metrics.read_distribution(_tags(spark, sf, regions), regions)


@query
def read_distribution_totals(spark, sf):
    return metrics.read_distribution_totals(_tags(spark, sf, _regions(spark, sf)), _samples(spark, sf))


@query
def distribution_percent(spark, sf):
    regions = _regions(spark, sf)
    tags = _tags(spark, sf, regions)
    return metrics.distribution_percent(metrics.read_distribution(tags, regions), metrics.read_distribution_totals(tags))


# --- report ----------------------------------------------------------------------------------

def _metrics(spark, sf, cfg):
    mixed = cfg.genome.mixed_species
    return pipeline.metrics_stage(
        _qc(spark, sf), _alignments(spark, sf, mixed), _gtf(spark, sf, mixed),
        _whitelist(spark, sf), _samples(spark, sf), cfg=cfg,
    )


@query
def metrics_long(spark, sf):
    rows = _metrics(spark, sf, SINGLE).select("sample", "variable_name", "value", "is_integral", "classification")
    return _round(rows, "value")


@query
def metrics_long_mixed(spark, sf):
    rows = _metrics(spark, sf, MIXED).select("sample", "variable_name", "value", "is_integral", "classification")
    return _round(rows, "value")


def _read_metrics(spark, sf):
    """Read QC and cell metric rows without the alignment parts."""
    cascade = materialize(reads_qc.qc_cascade(_qc(spark, sf)))
    return report.read_qc_rows(cascade, reads_qc.derived_read_metrics(cascade))


def _key_rows(spark, sf):
    """Read QC and cell metric rows of all samples that have reads."""
    tables = _tables(spark, sf)
    called = pipeline.cell_stage(tables, cfg=SINGLE).cells
    rows = _read_metrics(spark, sf)
    raw = rows.filter(F.col("variable_name") == "reads_pre_qc").select(
        "sample", F.col("value").cast("long").alias("raw_reads")
    )
    stats = metrics.cell_metrics_single(tables.counts, called, tables.genes, raw)
    return report.metrics_long(rows, report.cell_metric_rows(stats, mixed=False))


@query
def metrics_pivot(spark, sf):
    names = sorted(r["sample"] for r in _samples(spark, sf).collect())
    wide = report.pivot_metrics(_metrics(spark, sf, SINGLE), names)
    return wide.drop("ord", "human_readable_name", "description")


@query
def cascade_proportions(spark, sf):
    return report.cascade_proportions(_read_metrics(spark, sf))


@query
def cascade_box(spark, sf):
    stats = report.cascade_box_stats(report.cascade_proportions(_read_metrics(spark, sf)))
    return _round(stats, "median", "mean", "sd", "q1", "q3", "lower_fence", "upper_fence")


@query
def sample_steps(spark, sf):
    return _round(report.sample_steps_long(_read_metrics(spark, sf)), "percent_of_input")


@query
def axis_ranges(spark, sf):
    return _round(report.axis_ranges(_key_rows(spark, sf)), "y_min", "y_max")


@query
def metric_n(spark, sf):
    return report.metric_n(_key_rows(spark, sf))


@query
def key_metric_labels(spark, sf):
    return report.key_metric_labels(_key_rows(spark, sf))


# --- formats ---------------------------------------------------------------------------------

@query
def format_values(spark, sf):
    """P27/P28 with values that lie between two decimals."""
    rows = bridge.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "CASE l_linenumber % 4 WHEN 0 THEN (l_orderkey % 4000) * 0.125D WHEN 1 THEN l_orderkey % 977 * 0.005D "
        "WHEN 2 THEN (l_partkey % 5000) * 50D ELSE -1D * (l_suppkey % 999) / 8D END AS v",
    )
    v = F.col("v")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        formatting.format_value(v, F.lit(False)).alias("value_text"),
        formatting.abbreviate(F.abs(v) * 997).alias("label"),
        formatting.round_exact(v, 2).alias("rounded"),
    )


@query
def gtf_lines(spark, sf):
    """S7 from text: comments and short lines among annotation lines."""
    fields = (
        "concat('chr', p_partkey % 4), 'x', 'transcript', p_partkey * 10, p_partkey * 10 + 99, '.', "
        "CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE '+' END, '.', concat('gene_id \"G', p_partkey, '\"; gene_name \"', p_name, '\";')"
    )
    lines = bridge.table(spark, sf, "part").selectExpr(
        "p_partkey AS row_no",
        f"CASE WHEN p_partkey % 7 = 0 THEN concat('#', p_name) WHEN p_partkey % 11 = 0 THEN concat_ws('\t', p_name, 'a', 'b') "
        f"ELSE concat_ws('\t', {fields}) END AS value",
    )
    return readers.gtf_rows(lines).select("seqname", "feature", "start", "end", "strand", "attributes", "row_no")


@query
def sam_lines(spark, sf):
    """S9 from text: header lines, and tags in two orders."""
    rows = _alignments(spark, sf)
    body = F.concat_ws("\t", "read_name", "flag", "chrom", "pos", "mapq", "cigar", F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.lit("IIII"))
    tags = [F.concat(F.lit(f"{t}:i:"), F.col(t.lower())) for t in ("NH", "HI")] + [F.concat(F.lit("nM:i:"), F.col("nm"))]
    line = F.when(F.col("nm") == 2, F.concat_ws("\t", body, *tags[::-1])).otherwise(F.concat_ws("\t", body, *tags))
    head = rows.select("sample", F.concat(F.lit("@SQ\tSN:"), F.col("chrom")).alias("value")).distinct()
    lines = rows.select("sample", line.alias("value")).unionByName(head)
    return readers.sam_rows(lines).select("sample", "read_name", "flag", "chrom", "pos", "mapq", "cigar", "seq", "nh", "hi", "nm")


@query
def bed12_lines(spark, sf):
    return writers.bed12_lines(annotation.gene_models(_gtf(spark, sf))).select("value")


@query
def correction_lines(spark, sf):
    """Lines of the list, read back as corrections."""
    lines = writers.correction_lines(barcodes.correction_list(_whitelist(spark, sf)))
    listed, corrections = readers.correction_rows(lines)
    return listed.join(corrections, ["barcode", "row_no"], "left").select("barcode", "variant", "row_no")


@query
def collision_lines(spark, sf):
    wl = _whitelist(spark, sf)
    return writers.collision_lines(barcodes.collisions(wl), barcodes.collision_stats(wl)).select("part", "value")


@query
def fastq_lines(spark, sf):
    """Records of the passing reads."""
    passed = _qc(spark, sf).filter(F.col("lost_at").isNull())
    tagged = passed.withColumn("header", names.tagged_header(F.col("header"), F.col("barcode")))
    return writers.fastq_lines(tagged, "header", "out_seq", "out_qual")


@query
def rejected_fastq_lines(spark, sf):
    """R1 and R2 records of the other reads."""
    failed = _qc(spark, sf).filter(F.col("lost_at").isNotNull())
    return writers.rejected_fastq_lines(failed)


@query
def matrix_lines(spark, sf):
    tables = _tables(spark, sf)
    genes = matrix.index_genes(tables.counts, tables.genes, bridge.sample_names(spark, sf))
    cols = matrix.index_barcodes(tables.totals)
    return writers.matrix_lines(matrix.matrix_entries(tables.counts, genes, cols), genes, cols)


# --- files written and read again -------------------------------------------------------------

def _folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return f"{checkpoint_root(spark)}/files-{uuid.uuid4().hex}"


@query
def fastq_lanes(spark, sf):
    """Reads as a block-gzip and a plain lane per sample, read in splits, lanes merged."""
    path = _folder(spark)
    lane = F.length("header") % 2 + 1
    reads = _reads(spark, sf).select("*", lane.cast("int").alias("lane"))
    sheet = []
    for number, ending in ((1, ".fastq.gz"), (2, ".fastq")):
        for mate in ("r1", "r2"):
            named = reads.filter(F.col("lane") == number).withColumn("file", F.concat("sample", F.lit(f"_L{number}_{mate}{ending}")))
            files = writers.write_fastq_files(named, "header", f"{mate}_seq", f"{mate}_qual", ["header"], path, number == 1)
            sheet += [(f.split("_L")[0], number, mate, f"{path}/{f}") for f in files]
    rows = spark.createDataFrame(sheet, "sample string, lane int, mate string, file string")
    lanes = rows.groupBy("sample", "lane").agg(
        *[F.max(F.when(F.col("mate") == m, F.col("file"))).alias(c) for m, c in (("r1", "fastq_1"), ("r2", "fastq_2"))]
    )
    found = fastq.read_fastq_pairs(spark, lanes, split_bytes=4 << 20, merged=True)
    return found.select("sample", "lane", "ord", "header", "r1_seq", "r1_qual", "r2_seq", "r2_qual")


@query
def file_line_ordinals(spark, sf):
    """Lines of several files, numbered without gaps from the first file's first to the last file's last."""
    path = _folder(spark)
    lines = _whitelist(spark, sf).select(
        F.concat(F.lit("list"), (F.col("row_no") % 3).cast("string"), F.lit(".txt")).alias("file"), F.col("barcode").alias("value"), "row_no"
    )
    single_file.write_files(lines, ["row_no"], path, packed=False)
    return readers.file_ordinals(spark.read.text(path).select("value", "_metadata")).select("value", "row_no")


def _matrix_parts(spark, sf):
    tables = _tables(spark, sf)
    genes = materialize(matrix.index_genes(tables.counts, tables.genes, bridge.sample_names(spark, sf)))
    cols = materialize(matrix.index_barcodes(tables.totals))
    return materialize(matrix.matrix_entries(tables.counts, genes, cols)), genes, cols


@query
def matrix_files(spark, sf):
    """One MatrixMarket file per sample, read again line by line."""
    path = _folder(spark)
    writers.write_matrix_files(*_matrix_parts(spark, sf), path)
    return writers.read_matrix_files(spark, path)


def _sparse(spark, sf) -> str:
    path = _folder(spark)
    sparse.write_sparse(*_matrix_parts(spark, sf), path)
    return path


@query
def sparse_pointers(spark, sf):
    """Where each barcode's and each gene's entries begin."""
    path = _sparse(spark, sf)
    both = [sparse.read_pointers(spark, path, axis).withColumn("axis", F.lit(axis)) for axis in sparse.AXES]
    return both[0].unionByName(both[1])


@query
def sparse_entries(spark, sf):
    """The entries of both compressed forms, read from their files."""
    path = _sparse(spark, sf)
    both = [sparse.read_entries(spark, path, axis).withColumn("axis", F.lit(axis)) for axis in sparse.AXES]
    return both[0].unionByName(both[1])


@query
def sparse_slice(spark, sf):
    """Barcodes 20 to 60 and genes 100 to 300 of every sample, read as ranges of places."""
    path = _sparse(spark, sf)
    both = [sparse.read_slice(spark, path, axis, *span).withColumn("axis", F.lit(axis)) for axis, span in (("rows", (20, 60)), ("columns", (100, 300)))]
    return both[0].unionByName(both[1])


def _sam_files(spark, sf, ending: str) -> DataFrame:
    """A SAM file per sample, header first, and the sheet of them."""
    path = _folder(spark)
    rows = _alignments(spark, sf)
    fields = ["read_name", "flag", "chrom", "pos", "mapq", "cigar", F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.lit("IIII")]
    tags = [F.concat(F.lit(f"{t}:i:"), F.col(t.lower())) for t in ("NH", "HI", "nM")]
    head = rows.select("sample", F.concat(F.lit("@SQ\tSN:"), F.col("chrom")).alias("value")).distinct()
    lines = rows.select("sample", F.concat_ws("\t", *fields, *tags).alias("value"), F.lit(1).alias("part"))
    lines = lines.unionByName(head.withColumn("part", F.lit(0))).withColumn("file", F.concat("sample", F.lit(ending)))
    files = single_file.write_files(lines, ["part", "value"], path, packed=ending.endswith("gz"))
    return spark.createDataFrame([(f.split(".")[0], f"{path}/{f}") for f in files], "sample string, path string")


@query
def sam_scan(spark, sf):
    """Reverse alignments of two chromosomes below a position, from block-gzip files, filtered in the scan."""
    few = [("chrom", "in", ["chr1", "chr3"]), ("pos", "<", 60_000), ("flag", "=", 16), ("sample", "in", ["S0", "S1"])]
    columns = ["sample", "read_name", "chrom", "pos", "nh", "nm"]
    return sam.scan_alignments(spark, _sam_files(spark, sf, ".sam.gz"), columns, few, split_bytes=1 << 20)


@query
def sam_scan_all(spark, sf):
    """Every field and tag of plain files."""
    return sam.scan_alignments(spark, _sam_files(spark, sf, ".sam"), split_bytes=1 << 20)


def _genome_order(spark, sf) -> str:
    path = _folder(spark)
    regions.write_regions(_alignments(spark, sf), path, window=1000)
    return path


@query
def region_alignments(spark, sf):
    """O1: alignments that reach into one stretch of a chromosome, from the files that the index names."""
    found = regions.read_region(spark, _genome_order(spark, sf), "chr2", 30_000, 45_000, ["S0", "S2"])
    return found.select("sample", "read_name", "chrom", "pos", "end", "cigar", "nh", "hi")


@query
def region_coverage(spark, sf):
    """O1: alignments that start in each window of each chromosome."""
    return regions.coverage(spark, _genome_order(spark, sf))


@query
def samplesheet_rows(spark, sf):
    """Lanes per sample, blanks, thresholds as text."""
    raw = bridge.table(spark, sf, "part").selectExpr(
        "concat(' s', p_partkey % 40, ' ') AS name", "concat('f1_', p_partkey) AS a", "concat('f2_', p_partkey, ' ') AS b",
        "CASE p_partkey % 3 WHEN 0 THEN '2.5' WHEN 1 THEN ' ' ELSE 'none' END AS c", "p_partkey AS row_no",
    )
    return readers.samplesheet_rows(raw)


@query
def metric_csv_values(spark, sf):
    """Values as written to the metric files, and as read back from them."""
    rows = _read_metrics(spark, sf).withColumn("text", writers.metric_text())
    back = F.col("text").try_cast("double")
    return rows.select(
        "sample", "variable_name", F.col("text").contains("E").alias("has_exponent"), (back == F.col("value")).alias("same"),
        F.col("text").contains(".").alias("has_point"),
    )
