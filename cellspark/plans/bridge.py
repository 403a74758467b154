"""Deterministic mapping of the test tables to sequencing inputs (see FIXTURES.md).

Every row of the domain tables is derived by Spark from ``lineitem`` and ``part``, so all work
grows with those tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.plans.scale import materialize

READ_LENGTH = 60
CYCLE = 97
GENE_LENGTH = 600
EXON_OFFSETS = ((0, 149), (250, 399), (470, 599))

CELL_NO = "CASE WHEN l_orderkey % 10 < 8 THEN l_suppkey % 100 ELSE 1000 + l_orderkey % 2000 END"
SAMPLE = "CASE WHEN l_orderkey div 10 % 5 < 3 THEN 'S0' WHEN l_orderkey div 10 % 5 = 3 THEN 'S1' ELSE 'S2' END"
READ_NAME = (
    "concat_ws(':', 'R', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "CAST(round(l_extendedprice * 100) AS BIGINT))"
)
BASE4 = "reverse(translate(lpad(conv({n}, 10, 4), 13, '0'), '0123', 'ACGT'))"
BARCODE = BASE4.format(n="cell_no * 7919 + 12345")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """Use all cores for an input with fewer splits than cores; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    rows = _spread(table(spark, sf_dir, "lineitem").select(*columns)).selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        f"{CELL_NO} AS cell_no", f"{SAMPLE} AS sample", f"{READ_NAME} AS read_name",
    )
    return rows.selectExpr("*", f"{BARCODE} AS barcode")


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct barcodes of nine in ten cell numbers, and some neighbours, with a list position."""
    cells = table(spark, sf_dir, "lineitem").selectExpr(f"{CELL_NO} AS cell_no").distinct()
    listed = cells.filter("cell_no % 10 <> 9").selectExpr(f"{BARCODE} AS barcode", "cell_no AS row_no")
    # neighbours one base away, so that variants collide
    near = listed.filter("row_no % 50 = 0").selectExpr(
        "concat(translate(substr(barcode, 1, 1), 'ACGT', 'CGTA'), substr(barcode, 2)) AS barcode", "row_no + 100000 AS row_no"
    )
    return listed.unionByName(near.join(listed.select("barcode"), "barcode", "left_anti"))


def sample_names(spark: SparkSession, sf_dir: str) -> list[str]:
    """Names of the sample table, as a run takes them from its sample sheet."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(f"{SAMPLE} AS sample").distinct()
    return sorted(r["sample"] for r in rows.collect())


def _sequences(rows: DataFrame) -> DataFrame:
    """Adds ``s0``, the bases that follow from ``k`` and ``l_suppkey``.

    Both count modulo ``CYCLE``, so each sequence is worked out once and looked up; rows with negative or
    missing numbers work out their own.
    """
    base = f"substr('ACGT', cast((k + i * i * 13 + i * l_suppkey) % {CYCLE} % 4 AS INT) + 1, 1)"
    bases = f"array_join(transform(sequence(0, {READ_LENGTH - 1}), i -> {base}), '')"
    every = rows.sparkSession.range(CYCLE * CYCLE).selectExpr(f"id div {CYCLE} AS k", f"id % {CYCLE} AS l_suppkey")
    known = every.selectExpr("k AS _k", "l_suppkey AS _s", f"{bases} AS _known")
    found = rows.selectExpr("*", f"k % {CYCLE} AS _k", f"l_suppkey % {CYCLE} AS _s").join(F.broadcast(known), ["_k", "_s"], "left")
    return found.selectExpr(*rows.columns, f"CASE WHEN k >= 0 AND l_suppkey >= 0 THEN _known ELSE {bases} END AS s0")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read pairs ``sample, header, r1_seq, r1_qual, r2_seq, r2_qual``."""
    rows = _lines(spark, sf_dir).selectExpr(
        "*", "l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7 AS k"
    )
    plain = _sequences(rows)
    polya = plain.selectExpr(
        "*", "CASE WHEN l_orderkey % 9 = 0 THEN overlay(s0 PLACING repeat('A', 18) FROM 31) ELSE s0 END AS s1"
    )
    polyx = polya.selectExpr(
        "*", "CASE WHEN l_orderkey % 11 = 0 THEN overlay(s1 PLACING repeat('G', 14) FROM 47) ELSE s1 END AS s2"
    )
    many_n = polyx.selectExpr(
        "*", "CASE WHEN l_orderkey % 23 = 0 THEN overlay(s2 PLACING repeat('N', 7) FROM 10) ELSE s2 END AS s3"
    )
    length = f"CASE WHEN l_orderkey % 19 = 0 THEN 11 ELSE {READ_LENGTH} END"
    good = "".join(chr(33 + 20 + i) for i in range(21)) * 4
    bad = "".join(chr(33 + 5 + i % 8) for i in range(READ_LENGTH))
    return many_n.selectExpr(
        "sample",
        "concat('@', read_name, ' 1:N:0') AS header",
        f"substr(s3, 1, {length}) AS r1_seq",
        f"substr(CASE WHEN l_orderkey % 29 = 0 THEN '{_sql(bad)}' "
        f"ELSE substr('{_sql(good)}', cast(l_partkey % 21 AS INT) + 1, {READ_LENGTH}) END, 1, {length}) AS r1_qual",
        "CASE WHEN l_orderkey % 101 = 0 THEN substr(barcode, 1, 9) "
        "WHEN l_orderkey % 17 = 0 THEN overlay(overlay(barcode PLACING 'N' FROM 3) PLACING 'N' FROM 9) "
        "WHEN l_orderkey % 13 = 0 THEN overlay(barcode PLACING 'N' FROM 5) ELSE barcode END AS r2_seq",
        f"substr('{_sql(good)}', cast(l_suppkey % 21 AS INT) + 1, "
        "CASE WHEN l_orderkey % 101 = 0 THEN 9 ELSE 13 END) AS r2_qual",
    )


def _sql(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _parts(spark: SparkSession, sf_dir: str, mixed: bool) -> DataFrame:
    prefix = "CASE WHEN p_partkey % 2 = 0 THEN 'GRCh38_' ELSE 'GRCm39_' END" if mixed else "''"
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "concat('ENSG', lpad(p_partkey, 11, '0')) AS gene_id",
        f"CASE WHEN p_partkey % 50 = 7 THEN '' ELSE concat({prefix}, p_name) END AS gene_name",
        f"concat({prefix}, CASE WHEN p_partkey % 40 = 0 THEN 'MT' ELSE concat('chr', p_partkey % 4 + 1) END) AS chrom",
        "p_partkey div 4 * 400 + 1001 AS start",
        "CASE WHEN (p_partkey div 4) % 3 = 0 THEN '-' ELSE '+' END AS strand",
    )


def gtf(spark: SparkSession, sf_dir: str, mixed: bool = False) -> DataFrame:
    """Annotation lines: a transcript, three exons and, for even parts, both codons per part."""
    lines = []
    for i, (feature, lo, hi, when) in enumerate(
        [("transcript", 0, GENE_LENGTH - 1, "true")]
        + [("exon", lo, hi, "true") for lo, hi in EXON_OFFSETS]
        + [
            ("start_codon", 30, 32, "p_partkey % 2 = 0 AND strand = '+'"),
            ("stop_codon", 567, 569, "p_partkey % 2 = 0 AND strand = '+'"),
            ("start_codon", 567, 569, "p_partkey % 2 = 0 AND strand = '-'"),
            ("stop_codon", 30, 32, "p_partkey % 2 = 0 AND strand = '-'"),
        ]
    ):
        lines.append(
            f"CASE WHEN {when} THEN named_struct('feature', '{feature}', 'lo', {lo}L, 'hi', {hi}L, 'k', {i}L) END"
        )
    attributes = (
        "concat('gene_id \"', gene_id, '.3\"; ', "
        "CASE WHEN gene_name = '' THEN '' ELSE concat('gene_name \"', gene_name, '\"; ') END, "
        "'transcript_id \"T', p_partkey, '\";')"
    )
    spread = _parts(spark, sf_dir, mixed).selectExpr("*", f"inline(filter(array({', '.join(lines)}), x -> x IS NOT NULL))")
    return spread.selectExpr(
        "chrom AS seqname", "'bridge' AS source", "feature", "start + lo AS start", "start + hi AS end",
        "'.' AS score", "strand", "'.' AS frame", f"{attributes} AS attributes", "p_partkey * 10 + k AS row_no",
    )


def alignments(spark: SparkSession, sf_dir: str, mixed: bool = False, copies: bool = False) -> DataFrame:
    """One alignment per line item and hit; ``copies`` repeats lines as amplification copies."""
    lines = _lines(spark, sf_dir)
    if copies:
        lines = lines.selectExpr("*", "explode(sequence(0, l_linenumber % 3)) AS copy").withColumn(
            "read_name", F.concat("read_name", F.lit(":"), F.col("copy").cast("string"))
        )
    n_parts = table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("n")).first()["n"]
    hits = lines.selectExpr(
        "*", "CASE WHEN l_orderkey % 7 = 0 THEN 2 + l_linenumber % 2 ELSE 1 END AS nh"
    ).selectExpr("*", "explode(sequence(1, nh)) AS hi")
    own = f"(l_partkey + (hi - 1) * 13) % {n_parts}"
    pk = f"CASE WHEN l_orderkey % 10 <> 3 THEN {own} - {own} % 2 + cell_no % 2 ELSE {own} END" if mixed else own
    prefix = "CASE WHEN pk % 2 = 0 THEN 'GRCh38_' ELSE 'GRCm39_' END" if mixed else "''"
    placed = hits.selectExpr("*", f"{pk} AS pk").selectExpr(
        "*",
        "(CASE WHEN (pk div 4) % 3 = 0 THEN 1 ELSE 0 END + CASE WHEN l_quantity % 11 = 0 THEN 1 ELSE 0 END) % 2 AS rev",
        "(l_orderkey * 53 + l_linenumber * 101) % 700 AS shift",
    )
    # one in 29 lines is spliced: 20 bases, a gap of 100, 20 bases
    return placed.selectExpr(
        "sample",
        "concat(read_name, '_', barcode, '_') AS read_name",
        "cast(rev * 16 + CASE WHEN hi > 1 THEN 256 ELSE 0 END AS INT) AS flag",
        f"concat({prefix}, CASE WHEN pk % 40 = 0 THEN 'MT' ELSE concat('chr', pk % 4 + 1) END) AS chrom",
        "pk div 4 * 400 + 1001 + shift - 60 AS pos",
        "CASE WHEN nh = 1 THEN 255 ELSE 3 END AS mapq",
        "CASE WHEN l_orderkey % 29 = 0 THEN '20M100N20M' ELSE '40M' END AS cigar",
        "repeat('A', 40) AS seq",
        "nh",
        "hi",
        "cast(l_quantity % 5 AS INT) AS nm",
    )


_staged: dict[tuple, DataFrame] = {}


def staged(spark: SparkSession, sf_dir: str, name: str, **options: bool) -> DataFrame:
    """A domain table written once per session, standing in for the input files of a real run."""
    app = spark.sparkContext.applicationId
    key = (app, sf_dir, name, tuple(sorted(options.items())))
    if key not in _staged:
        makers = {"whitelist": whitelist, "reads": reads, "gtf": gtf, "alignments": alignments}
        _staged[key] = materialize(makers[name](spark, sf_dir, **options), "zstd")
    return _staged[key]
