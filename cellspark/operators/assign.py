"""Gene assignment of alignments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.config import AssignConfig
from cellspark.functions import alignments as al
from cellspark.operators.annotation import gene_intervals
from cellspark.operators.intervals import bin_of, binned_union, clip_to_bins
from cellspark.plans.scale import Footprint, lookup_join, materialize

ASSIGNED = "Assigned"
AMBIGUOUS = "Unassigned_Ambiguity"
NO_FEATURES = "Unassigned_NoFeatures"
# an alignment without an aligned block, such as an unmapped read
UNMAPPED = "Unassigned_Unmapped"

LEVELS = ("transcript", "exon")
STATUS_COLUMNS = ("tx_status", "tx_gene", "ex_status", "ex_gene")


@dataclass(frozen=True)
class FeatureIndex:
    """Annotation prepared for lookups by (chrom, strand, bin).

    ``rows``: ``chrom, strand, bin, level, gene_id, f_start, f_end`` with disjoint pieces per gene.
    ``windows``: per bin, the genes with their pieces in it and in the first bases of the next bin, as
    one array per level. Bins with too many pieces for that are listed in ``dense`` instead (None if there are none).
    """

    rows: DataFrame
    windows: DataFrame
    dense: DataFrame | None
    size: Footprint
    windows_size: Footprint
    bin_size: int
    reach: int


# the number first: sorts then compare few of the texts
BIN = ("bin", "chrom", "strand")


def feature_index(gtf: DataFrame, cfg: AssignConfig = AssignConfig()) -> FeatureIndex:
    """Index the transcripts and exons of an annotation.

    A gene's features of one type are united first, so nothing is counted twice. The index is
    written once to the shared folder; its size and dense bins are then measured in one job. A lookup
    never reaches over a whole bin, so the reach is at most the bin size.
    """
    spans = gene_intervals(gtf, *LEVELS).withColumnRenamed("feature", "level")
    if not cfg.stranded:
        spans = spans.withColumn("strand", F.explode(F.array(F.lit("+"), F.lit("-"))))
    pieces = binned_union(spans, ["chrom", "strand", "level", "gene_id"], cfg.bin_size)
    rows = materialize(
        pieces.select(*BIN, "level", "gene_id", F.col("start").alias("f_start"), F.col("end").alias("f_end"))
    )
    reach = min(cfg.bin_reach, cfg.bin_size)
    border = F.col("bin") * cfg.bin_size
    reached = rows.filter(F.col("f_start") < border + reach).select(
        "chrom",
        "strand",
        (F.col("bin") - 1).alias("bin"),
        "level",
        "gene_id",
        "f_start",
        F.least("f_end", border + (reach - 1)).alias("f_end"),
    )
    held = rows.withColumn("own", F.lit(1)).unionByName(reached.withColumn("own", F.lit(0)))
    per_bin = held.groupBy(*BIN).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("own").alias("own"),
        F.sum(F.octet_length("gene_id") + F.octet_length("chrom") + 128).alias("b"),
    )
    crowded = F.col("n") > cfg.max_pieces_per_bin
    seen = per_bin.agg(
        F.count_if(crowded).alias("dense"), F.sum("own").alias("rows"), F.sum("n").alias("n"), F.sum("b").alias("bytes")
    ).first()
    size = Footprint(seen["rows"] or 0, seen["bytes"] or 0)
    dense = None
    if seen["dense"]:
        dense = materialize(per_bin.filter(crowded).select(*BIN))
        held = held.join(dense, list(BIN), "left_anti")
    piece = F.struct(F.col("gene_id").alias("g"), F.col("f_start").alias("s"), F.col("f_end").alias("e"))
    gathered = held.groupBy(*BIN).agg(
        F.collect_list(F.when(F.col("level") == LEVELS[0], piece)).alias("tx_pieces"),
        F.collect_list(F.when(F.col("level") == LEVELS[1], piece)).alias("ex_pieces"),
    )
    windows = materialize(gathered.select(*BIN, *[_by_gene(f"{p}_pieces").alias(f"{p}_genes") for p in ("tx", "ex")]))
    return FeatureIndex(rows, windows, dense, size, Footprint(seen["n"] or 0, seen["bytes"] or 0), cfg.bin_size, reach)


def _status(count, gene):
    status = F.when(count == 0, NO_FEATURES).when(count == 1, ASSIGNED).otherwise(AMBIGUOUS)
    return status, F.when(count == 1, gene)


def _least_bases(cfg: AssignConfig):
    """Fewest bases of a read that must lie on a gene."""
    return F.greatest(F.ceil(al.read_length(F.col("cigar")) * F.lit(cfg.min_overlap_fraction)), F.lit(1))


def _by_gene(pieces: str):
    """``g, p``: the genes of an array of pieces, each with its own pieces."""
    genes = F.array_distinct(F.transform(pieces, lambda p: p["g"]))
    own = lambda gene: F.filter(pieces, lambda p: p["g"] == gene)
    return F.transform(
        genes,
        lambda g: F.struct(g.alias("g"), F.transform(own(g), lambda p: F.struct(p["s"].alias("s"), p["e"].alias("e"))).alias("p")),
    )


def _passing(genes: str):
    """The genes of an in-row array whose pieces cover enough of the alignment: of its one run, or of its blocks."""
    none = F.lit(0).cast("long")

    def shared(p, start, end):
        return F.greatest(F.least(p["e"], end) - F.greatest(p["s"], start) + 1, none)

    def of_run(pieces):
        return F.aggregate(pieces, none, lambda acc, p: acc + shared(p, F.col("pos"), F.col("_end")))

    def of_blocks(pieces):
        return F.aggregate(
            "_blocks", none, lambda all_, b: F.aggregate(pieces, all_, lambda acc, p: acc + shared(p, b["start"], b["end"]))
        )

    def covered(pieces):
        return F.when(F.col("_blocks").isNull(), of_run(pieces)).otherwise(of_blocks(pieces))

    return F.filter(genes, lambda g: covered(g["p"]) >= F.col("_least"))


def _once(value):
    """``value`` as the output of a generator: filters and projections above take it as it is, none works it out again."""
    return F.explode(F.array(value))


def _assign_in_row(alignments: DataFrame, index: FeatureIndex, exon_when, cfg: AssignConfig) -> DataFrame:
    """Alignments that end within the index's reach: one lookup by the bin of their start, with all genes they may touch.

    A broadcast lookup does not shuffle them; with a larger one they are shuffled once, as they were given: what
    follows from the CIGAR string is worked out after it.
    """
    columns = [c for c in alignments.columns if c not in ("strand", "bin")]
    found = lookup_join(alignments, index.windows, list(BIN), "left", size=index.windows_size)
    work = [*columns, "_end", "_least", "_blocks", "ex_genes"]
    single = al.single_run(F.col("cigar"))
    touched = F.coalesce(F.col("tx_genes"), F.col("ex_genes")).isNotNull()
    blocks = F.when(~single & touched, al.aligned_blocks(F.col("pos"), F.col("cigar")))
    end = (F.col("pos") + al.run_length(F.col("cigar")) - 1).alias("_end")
    measured = found.select(*columns, "tx_genes", "ex_genes", end, _least_bases(cfg).alias("_least"), _once(blocks).alias("_blocks"))
    with_tx = measured.select(*work, _once(_passing("tx_genes")).alias("_g")).select(*work, *_status_of_array("tx"))
    done = with_tx.select(*columns, "tx_status", "tx_gene", _once(F.when(exon_when, _passing("ex_genes"))).alias("_g"))
    return done.select(*columns, "tx_status", "tx_gene", *_status_of_array("ex"))


def _assign_unaligned(alignments: DataFrame) -> DataFrame:
    """Alignments without an aligned block."""
    columns = [c for c in alignments.columns if c not in ("strand", "bin")]
    gene, status = F.lit(None).cast("string"), F.lit(UNMAPPED)
    return alignments.select(*columns, *[v.alias(c) for c, v in zip(STATUS_COLUMNS, (status, gene, status, gene))])


def _aligned():
    return F.coalesce(F.col("pos").isNotNull() & F.col("cigar").rlike("[M=X]"), F.lit(False))


def _status_of_array(prefix: str):
    status, gene = _status(F.coalesce(F.size("_g"), F.lit(0)), F.get(F.col("_g"), F.lit(0))["g"])
    return status.alias(f"{prefix}_status"), gene.alias(f"{prefix}_gene")


def _assign_by_rows(alignments: DataFrame, index: FeatureIndex, cfg: AssignConfig) -> DataFrame:
    """Any aligned alignment: one row per aligned block and bin, overlap sums per (alignment, gene).

    Equal alignments are counted first and repeated at the end, so each keeps a status of its own; the
    overlap sums reuse that partitioning where the index is broadcast. An alignment has few rows: its
    blocks times the genes they touch.
    """
    given = [c for c in alignments.columns if c not in ("strand", "bin")]
    columns = [*given, "_copies"]
    distinct = alignments.groupBy(*given).agg(F.count(F.lit(1)).alias("_copies"))
    blocks = distinct.select(
        *columns,
        _least_bases(cfg).alias("_least"),
        al.strand(F.col("flag")).alias("strand"),
        F.explode(al.aligned_blocks(F.col("pos"), F.col("cigar"))).alias("_b"),
    )
    pieces = clip_to_bins(
        blocks.withColumn("start", F.col("_b.start")).withColumn("end", F.col("_b.end")).drop("_b"),
        "start",
        "end",
        index.bin_size,
    )
    touches = (F.col("start") <= F.col("f_end")) & (F.col("f_start") <= F.col("end"))
    joined = lookup_join(
        pieces, index.rows, list(BIN), "left", condition=touches, size=index.size
    )
    bases = F.coalesce(F.least("end", "f_end") - F.greatest("start", "f_start") + 1, F.lit(0))
    together = joined.select(*columns, "_least", "level", "gene_id", bases.alias("_bases"))
    per_gene = together.groupBy(*columns, "_least", "level", "gene_id").agg(F.sum("_bases").alias("_bases"))
    enough = F.col("gene_id").isNotNull() & (F.col("_bases") >= F.col("_least"))
    counted = per_gene.groupBy(*columns, "_least").agg(
        *[
            agg
            for prefix, level in zip(("tx", "ex"), LEVELS)
            for agg in (
                F.count_if(enough & (F.col("level") == level)).alias(f"_{prefix}_n"),
                F.min(F.when(enough & (F.col("level") == level), F.col("gene_id"))).alias(f"_{prefix}_g"),
            )
        ]
    )
    out = []
    for prefix in ("tx", "ex"):
        status, gene = _status(F.col(f"_{prefix}_n"), F.col(f"_{prefix}_g"))
        out += [status.alias(f"{prefix}_status"), gene.alias(f"{prefix}_gene")]
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")
    return counted.select(*columns, *out).select("*", again).drop("_copies", "_copy")


def assign_levels(
    alignments: DataFrame, index: FeatureIndex, cfg: AssignConfig = AssignConfig(), exon_when=None
) -> DataFrame:
    """A13 at both levels at once: adds ``tx_status, tx_gene, ex_status, ex_gene``.

    A gene counts when at least the minimum fraction of the read's bases lies on the union of its
    features. The share is compared in whole bases, so there is no rounding. An alignment without an
    aligned block gets the status ``Unassigned_Unmapped``. ``exon_when`` may limit
    the exon level to rows that need it; elsewhere the exon status has no meaning.
    """
    aligned = _aligned()
    keyed = alignments.withColumns(
        {"strand": al.strand(F.col("flag")), "bin": bin_of(F.col("pos"), index.bin_size)}
    )
    one_run = al.run_length(F.col("cigar"))
    span = F.when(al.single_run(F.col("cigar")), one_run).otherwise(al.reference_end(F.lit(1), F.col("cigar")))
    in_row = F.coalesce(span <= index.reach, F.lit(False))
    unaligned = keyed.filter(~aligned)
    if index.dense is not None:  # alignments that start in a dense bin go the long way, no others
        marked = index.dense.withColumn("_dense", F.lit(True))
        keyed = lookup_join(keyed, marked, list(BIN), "left")
        in_row = in_row & F.col("_dense").isNull()
    exon_when = exon_when if exon_when is not None else F.lit(True)
    short = keyed.filter(aligned & in_row).drop("_dense")
    long = keyed.filter(aligned & ~in_row).drop("_dense")
    ways = _assign_in_row(short, index, exon_when, cfg), _assign_by_rows(long, index, cfg), _assign_unaligned(unaligned)
    return ways[0].unionByName(ways[1]).unionByName(ways[2])


def assign_features(
    alignments: DataFrame, index: FeatureIndex, level: str = "transcript", cfg: AssignConfig = AssignConfig()
) -> DataFrame:
    """A13/J7-J9 at one level: adds ``xs`` (status), ``xn`` (1 when assigned) and ``xt`` (gene)."""
    prefix = "tx" if level == LEVELS[0] else "ex"
    both = assign_levels(alignments, index, cfg)
    return (
        both.withColumn("xs", F.col(f"{prefix}_status"))
        .withColumn("xt", F.col(f"{prefix}_gene"))
        .withColumn("xn", F.when(F.col("xs") == ASSIGNED, 1))
        .drop(*STATUS_COLUMNS)
    )


def filter_umr(alignments: DataFrame, max_nm: int = 3) -> DataFrame:
    """Unique alignments with at most ``max_nm`` mismatches."""
    return alignments.filter((F.col("nh") == 1) & F.col("nm").between(0, max_nm))


def filter_multimapped(alignments: DataFrame, max_nm: int = 3) -> DataFrame:
    """Alignments of multi-mapped reads with at most ``max_nm`` mismatches."""
    return alignments.filter((F.col("nh") > 1) & F.col("nm").between(0, max_nm))


def filter_assigned(assigned: DataFrame) -> DataFrame:
    """P13."""
    return assigned.filter((F.col("xn") == 1) & F.col("xt").isNotNull() & (F.col("xs") == ASSIGNED))


def filter_ambiguous(assigned: DataFrame) -> DataFrame:
    """Ambiguous alignments without their assignment columns."""
    return assigned.filter(F.col("xs") == AMBIGUOUS).drop("xs", "xn", "xt")


def _resolution(status: str, gene: str, prefix: str):
    """Aggregates that tell whether a read resolves to one gene; all combine before the shuffle."""
    hit = F.col(status) == ASSIGNED
    return [
        F.min(F.when(hit, F.col(gene))).alias(f"_{prefix}_lo"),
        F.max(F.when(hit, F.col(gene))).alias(f"_{prefix}_hi"),
        F.count_if(F.col(status) == AMBIGUOUS).alias(f"_{prefix}_amb"),
    ]


def _resolved(prefix: str):
    return F.coalesce((F.col(f"_{prefix}_lo") == F.col(f"_{prefix}_hi")) & (F.col(f"_{prefix}_amb") == 0), F.lit(False))


def resolve_multimappers(assigned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A14/W8, one round: (resolved alignments, alignments left for the tie-break).

    A read resolves when its assigned alignments name one gene and none is ambiguous; the alignment
    with the greatest HI is emitted as unique. Otherwise its assigned and ambiguous alignments go on
    without assignment columns.
    """
    read = ["sample", "read_name"]
    payload = [c for c in assigned.columns if c not in read]
    pick = F.max(F.when(F.col("xs") == ASSIGNED, F.struct("hi", *[c for c in payload if c != "hi"])))
    summary = assigned.groupBy(*read).agg(*_resolution("xs", "xt", "r"), pick.alias("_pick"))
    resolved = summary.filter(_resolved("r")).select(
        *read, *[(F.lit(1).alias(c) if c in ("nh", "hi") else F.col(f"_pick.{c}").alias(c)) for c in payload]
    )
    open_reads = summary.filter(~_resolved("r")).select(*read)
    left_over = (
        assigned.filter(F.col("xs").isin(ASSIGNED, AMBIGUOUS)).join(open_reads, read, "left_semi").drop("xs", "xn", "xt")
    )
    return resolved.select(*assigned.columns), left_over


def annotate(alignments: DataFrame, index: FeatureIndex, cfg: AssignConfig = AssignConfig()) -> DataFrame:
    """A13+A14+U1-U3 fused: every annotated alignment, with its gene in ``xt``.

    Transcript and exon status are looked up together. Unique alignments are then decided in their
    row. Both rounds of the multi-mapper resolution need only combining aggregates per read, so they
    share one aggregation and one shuffle, and only multi-mapped alignments take part in it.
    """
    columns = alignments.columns
    ambiguous = F.col("tx_status") == AMBIGUOUS
    umr = assign_levels(filter_umr(alignments, cfg.max_mismatches), index, cfg, exon_when=ambiguous)
    tie_broken = ambiguous & (F.col("ex_status") == ASSIGNED)
    gene = F.when(F.col("tx_status") == ASSIGNED, F.col("tx_gene")).when(tie_broken, F.col("ex_gene"))
    unique = umr.withColumn("xt", gene).filter(F.col("xt").isNotNull()).select(*columns, "xt")

    candidate = F.col("tx_status").isin(ASSIGNED, AMBIGUOUS)
    multi = assign_levels(filter_multimapped(alignments, cfg.max_mismatches), index, cfg, exon_when=candidate)
    candidates = multi.filter(candidate)
    read = ["read_name", "sample"]
    payload = F.struct("hi", *[c for c in columns if c not in read + ["hi"]])
    summary = candidates.groupBy(*read).agg(
        *_resolution("tx_status", "tx_gene", "tx"),
        *_resolution("ex_status", "ex_gene", "ex"),
        F.max(F.when(F.col("tx_status") == ASSIGNED, payload)).alias("_tx_pick"),
        F.max(F.when(F.col("ex_status") == ASSIGNED, payload)).alias("_ex_pick"),
    )
    settled = summary.withColumn(
        "_pick", F.when(_resolved("tx"), F.col("_tx_pick")).when(_resolved("ex"), F.col("_ex_pick"))
    ).withColumn("xt", F.when(_resolved("tx"), F.col("_tx_lo")).when(_resolved("ex"), F.col("_ex_lo")))
    resolved = settled.filter(F.col("xt").isNotNull()).select(
        *[
            F.col(c) if c in read else F.lit(1).alias(c) if c in ("nh", "hi") else F.col(f"_pick.{c}").alias(c)
            for c in columns
        ],
        "xt",
    )
    return unique.unionByName(resolved)


def assignment_summary(assigned: DataFrame) -> DataFrame:
    """Alignments per status."""
    return assigned.groupBy("sample", F.col("xs").alias("status")).agg(F.count(F.lit(1)).alias("alignments"))


def gene_assignment_counts(assigned: DataFrame) -> DataFrame:
    """Assigned alignments per gene."""
    return filter_assigned(assigned).groupBy("sample", F.col("xt").alias("gene_id")).agg(
        F.count(F.lit(1)).alias("alignments")
    )


def count_alignments(annotated: DataFrame) -> DataFrame:
    """A15+A16: annotated alignments and those on the reverse strand."""
    return annotated.groupBy("sample").agg(
        F.count(F.lit(1)).alias("annotated_alignments"),
        F.count_if(al.has_flag(F.col("flag"), al.FLAG_REVERSE)).alias("antisense_alignments"),
    )
