"""Text and CSV inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cellspark.plans.scale import lookup_join, materialize

_BLOCK = 1 << 20
_PER_BLOCK = 1 << 33

METRICS_SCHEMA = "variable_name string, value string, human_readable_name string, description string, classification string"


def file_order(df: DataFrame, name: str = "row_no") -> DataFrame:
    """Number that grows in file order, for rows read from one file.

    The file block comes first, then the row counter inside the task that read the block, so no
    pass over the data is needed. The numbers are ordered but not consecutive.
    """
    block = F.floor(F.col("_metadata.file_block_start") / _BLOCK).cast("long")
    counter = F.monotonically_increasing_id().bitwiseAND(F.lit(_PER_BLOCK - 1))
    return df.select("*", (block * F.lit(_PER_BLOCK) + counter).alias(name))


def file_ordinals(df: DataFrame, name: str = "row_no", per_file: bool = False) -> DataFrame:
    """Consecutive numbers from 0 for the rows read from files, on through all files in the order of their paths.

    ``per_file``: from 0 in each file.
    ``df`` is a file read that still has ``_metadata``. Each file block is read by one task in its order, so a count
    per block and the sums of the counts before it are all that is needed; no row is sorted. The rows are written once
    with their block, because a later read might cut the files differently.
    """
    counted = materialize(
        df.select(
            "*",
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_id"),
        )
    )
    blocks = counted.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_least"))
    # blocks of a file, then files: one row per block, one per file
    in_file = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("_path").agg(F.sum("_rows").alias("_n"))
    over_files = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    start = F.lit(0) if per_file else F.coalesce(F.sum("_n").over(over_files), F.lit(0))
    starts = files.select("_path", start.alias("_start"))
    sums = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(in_file), F.lit(0))).join(starts, "_path")
    offsets = sums.select("_path", "_block", (F.col("_start") + F.col("_before") - F.col("_least")).alias("_shift"))
    numbered = lookup_join(counted, offsets, ["_path", "_block"], how="inner")
    return numbered.select(*df.columns, (F.col("_id") + F.col("_shift")).alias(name))


def read_samplesheet(spark: SparkSession, path: str, mixed: bool = False) -> DataFrame:
    """``sample, lane, fastq_1, fastq_2`` and the manual thresholds of the mode.

    Columns count by position. Repeated samples are lanes. Single-species sheets may have one
    threshold column (``manual_threshold``), mixed ones need both (``hsap_threshold``,
    ``mmus_threshold``), otherwise both are missing. Blank means missing.
    """
    return samplesheet_rows(file_order(spark.read.csv(path, header=True)), mixed)


def samplesheet_rows(raw: DataFrame, mixed: bool = False) -> DataFrame:
    """The sheet's columns by position and ``row_no`` to sample rows."""
    by_place = [F.trim(F.col(f"`{c}`")) for c in raw.columns if c != "row_no"]
    width = len(by_place)

    def threshold(place: int, needed: int):
        value = F.nullif(by_place[place], F.lit("")) if width >= needed else F.lit(None)
        return value.try_cast("double")

    if mixed:
        manual = [threshold(3, 5).alias("hsap_threshold"), threshold(4, 5).alias("mmus_threshold")]
    else:
        manual = [threshold(3, 4).alias("manual_threshold")]
    rows = raw.select(
        by_place[0].alias("sample"), by_place[1].alias("fastq_1"), by_place[2].alias("fastq_2"), *manual, "row_no"
    ).filter(F.col("sample") != "")
    lane = F.row_number().over(Window.partitionBy("sample").orderBy("row_no"))
    return rows.withColumn("lane", lane).drop("row_no")


def manual_thresholds(sheet: DataFrame, mixed: bool = False) -> DataFrame:
    """One manual threshold per sample, or per (sample, species) in mixed mode."""
    if not mixed:
        return sheet.groupBy("sample").agg(F.min_by("manual_threshold", "lane").alias("manual_threshold"))
    first = sheet.groupBy("sample").agg(
        F.min_by("hsap_threshold", "lane").alias("hsap"), F.min_by("mmus_threshold", "lane").alias("mmus")
    )
    return first.unpivot("sample", ["hsap", "mmus"], "species", "manual_threshold")


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """S3: second column of the barcode list as ``barcode``, with its place in the file."""
    return whitelist_rows(file_order(spark.read.csv(path, header=True)))


def whitelist_rows(rows: DataFrame) -> DataFrame:
    return rows.select(F.trim(F.col(f"`{rows.columns[1]}`")).alias("barcode"), "row_no").filter(F.col("barcode") != "")


def read_corrections(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(barcodes, corrections) of a tab-separated list of barcodes and their variants.

    Empty variants and variants equal to their barcode are dropped.
    """
    return correction_rows(file_order(spark.read.text(path)))


def correction_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines (``value, row_no``) to (barcodes, corrections)."""
    parts = F.split("value", "\t")
    rows = lines.select(parts[0].alias("barcode"), F.get(parts, F.lit(1)).alias("variants"), "row_no").filter(
        F.col("barcode") != ""
    )
    corrections = rows.select("barcode", F.explode(F.split("variants", ",")).alias("variant"), "row_no").filter(
        (F.col("variant") != "") & (F.col("variant") != F.col("barcode"))
    )
    return rows.select("barcode", "row_no"), corrections


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Annotation lines; comments, blanks and lines with fewer than nine fields are skipped."""
    return gtf_rows(file_order(spark.read.text(path)))


def gtf_rows(lines: DataFrame) -> DataFrame:
    """Lines (``value, row_no``) to annotation rows."""
    f = F.split("value", "\t")
    wide = lines.filter(~F.col("value").startswith("#") & (F.size(f) >= 9))
    return wide.select(
        f[0].alias("seqname"),
        f[1].alias("source"),
        f[2].alias("feature"),
        f[3].try_cast("long").alias("start"),
        f[4].try_cast("long").alias("end"),
        f[5].alias("score"),
        f[6].alias("strand"),
        f[7].alias("frame"),
        f[8].alias("attributes"),
        "row_no",
    )


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """M6: feature table ``gene_id, gene_name, chromosome``, one row per gene id."""
    rows = file_order(spark.read.csv(path, sep="\t", header=True)).toDF("gene_id", "gene_name", "chromosome", "row_no")
    first = rows.groupBy("gene_id").agg(F.min(F.struct("row_no", "gene_name", "chromosome")).alias("f"))
    return first.select("gene_id", "f.gene_name", "f.chromosome", "f.row_no")


def read_alignments(
    spark: SparkSession, paths: str | list[str], sample: str | None = None, name: str = r"([^/]+?)\.sam(?:\.\w+)?$"
) -> DataFrame:
    """SAM text of one or many samples as alignment rows, in one scan.

    Without ``sample`` it is the group of ``name`` in each file's path: the file name before ``.sam``.
    """
    lines = spark.read.text(paths)
    owner = F.lit(sample) if sample is not None else F.regexp_extract(F.col("_metadata.file_path"), name, 1)
    if sample is None:
        owner = F.url_decode(F.replace(owner, F.lit("+"), F.lit("%2B")))
    return sam_rows(lines.select(owner.alias("sample"), "value"))


def sam_rows(lines: DataFrame) -> DataFrame:
    """SAM lines (``sample, value``) to alignment rows; headers and blanks are skipped, tags found by name."""
    lines = lines.filter(~F.col("value").startswith("@") & (F.col("value") != ""))
    f = F.split("value", "\t")

    def tag(name: str, kind: str):
        return F.nullif(F.regexp_extract("value", rf"\t{name}:{kind}:([^\t]*)", 1), F.lit(""))

    return lines.select(
        "sample",
        f[0].alias("read_name"),
        f[1].cast("int").alias("flag"),
        f[2].alias("chrom"),
        f[3].cast("long").alias("pos"),
        f[4].cast("int").alias("mapq"),
        f[5].alias("cigar"),
        f[9].alias("seq"),
        f[10].alias("qual"),
        tag("NH", "i").cast("int").alias("nh"),
        tag("HI", "i").cast("int").alias("hi"),
        tag("AS", "i").cast("int").alias("as"),
        tag("nM", "i").cast("int").alias("nm"),
        tag("XS", "Z").alias("xs"),
        tag("XN", "i").cast("int").alias("xn"),
        tag("XT", "Z").alias("xt"),
    )


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """Metric rows of the per-sample files in a folder; the sample is the file name's stem."""
    rows = spark.read.schema(T.StructType.fromDDL(METRICS_SCHEMA)).csv(f"{path}/*.metrics.csv", header=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.metrics\.csv$", 1)
    return rows.select(
        F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("sample"),
        "variable_name",
        F.col("value").try_cast("double").alias("value"),
        (~F.col("value").contains(".")).alias("is_integral"),
        "human_readable_name",
        "description",
        "classification",
    )


def read_qc_json(spark: SparkSession, path: str) -> DataFrame:
    """QC documents of a folder, one row per file with the totals before filtering."""
    summary = (
        "summary struct<before_filtering:struct<total_reads:bigint,q30_bases:bigint,q30_rate:double,"
        "gc_content:double,read1_mean_length:double>>"
    )
    rows = spark.read.text(path, wholetext=True)
    parsed = rows.select(
        F.col("_metadata.file_path").alias("file"), F.from_json("value", summary)["summary"]["before_filtering"].alias("t")
    )
    return parsed.select("file", "t.*")
