"""Output formats (S4, S6, S8, S10-S15). Every writer is a distributed Spark write.

Ordered text outputs are range-partitioned and sorted, so their part files read in name order give
the whole file; gzip parts may simply be concatenated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.functions import names
from cellspark.functions.formatting import format_value, plain
from cellspark.sources.readers import file_ordinals
from cellspark.sources.single_file import write_files

MATRIX_HEADER = "%%MatrixMarket matrix coordinate integer general"
FEATURE_TYPE = "Gene Expression"


def _ordered_text(df: DataFrame, order: list[str], path: str, compression: str | None = None) -> None:
    """Write column ``value`` in the given order, one folder per sample."""
    rows = df.repartitionByRange("sample", *order).sortWithinPartitions("sample", *order)
    writer = rows.select("sample", "value").write.mode("overwrite").partitionBy("sample")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def matrix_lines(entries: DataFrame, genes: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Lines of the coordinate file: two header lines, the dimensions, then the entries."""
    sizes = (
        genes.groupBy("sample").agg(F.max("gene_index").alias("rows"))
        .join(barcodes.groupBy("sample").agg(F.max("barcode_index").alias("cols")), "sample", "left")
        .join(entries.groupBy("sample").agg(F.count(F.lit(1)).alias("nnz")), "sample", "left")
        .na.fill(0)
    )
    top = F.array(
        F.struct(F.lit(-3).alias("c"), F.lit(MATRIX_HEADER).alias("value")),
        F.struct(F.lit(-2).alias("c"), F.lit("%").alias("value")),
        F.struct(F.lit(-1).alias("c"), F.format_string("%d %d %d", "rows", "cols", "nnz").alias("value")),
    )
    header = sizes.select("sample", F.inline(top)).select("sample", F.col("c").cast("long").alias("c"), F.lit(0).cast("long").alias("g"), "value")
    body = entries.select(
        "sample", F.col("barcode_index").alias("c"), F.col("gene_index").alias("g"),
        F.format_string("%d %d %d", "gene_index", "barcode_index", "n").alias("value"),
    )
    return header.unionByName(body)


def write_matrix(entries: DataFrame, genes: DataFrame, barcodes: DataFrame, path: str) -> None:
    """MatrixMarket, barcode and feature files, gzip, one folder per sample.

    ``genes`` and ``barcodes`` carry ``gene_index`` and ``barcode_index``.
    """
    _ordered_text(matrix_lines(entries, genes, barcodes), ["c", "g"], f"{path}/matrix.mtx", "gzip")
    cells = barcodes.withColumn("value", F.concat_ws("_", "sample", "barcode"))
    _ordered_text(cells, ["barcode_index"], f"{path}/barcodes.tsv", "gzip")
    rows = genes.withColumn(
        "value", F.concat_ws("\t", "gene_id", F.coalesce("gene_name", F.lit("")), F.lit(FEATURE_TYPE))
    )
    _ordered_text(rows, ["gene_index"], f"{path}/features.tsv", "gzip")


def _in_file(df: DataFrame, name: str) -> DataFrame:
    """Lines with their file: ``name`` in a folder per sample."""
    folder = F.replace(F.replace(F.col("sample"), F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))
    return df.withColumn("file", F.concat(F.lit("sample="), folder, F.lit(f"/{name}")))


def write_matrix_files(entries: DataFrame, genes: DataFrame, barcodes: DataFrame, path: str) -> dict[str, int]:
    """``matrix.mtx.gz``, ``barcodes.tsv.gz`` and ``features.tsv.gz`` of every sample, one file each.

    Header lines come first in each matrix file, entries by column and row, so any reader of the format opens them.
    Samples without entries get a matrix file of no entries. Returns the files' sizes; ``write_matrix`` writes folders
    of parts instead.
    """
    lines = matrix_lines(entries, genes, barcodes)
    sizes = write_files(_in_file(lines, "matrix.mtx.gz"), ["c", "g"], path)
    cells = barcodes.withColumn("value", F.concat_ws("_", "sample", "barcode"))
    sizes |= write_files(_in_file(cells, "barcodes.tsv.gz"), ["barcode_index"], path)
    rows = genes.withColumn("value", F.concat_ws("\t", "gene_id", F.coalesce("gene_name", F.lit("")), F.lit(FEATURE_TYPE)))
    return sizes | write_files(_in_file(rows, "features.tsv.gz"), ["gene_index"], path)


def read_matrix_files(spark: SparkSession, path: str) -> DataFrame:
    """``sample, line, row, col, n`` of the files ``write_matrix_files`` makes; line 0 holds the dimensions."""
    lines = spark.read.text(f"{path}/sample=*/matrix.mtx.gz")
    folder = F.url_decode(F.replace(F.regexp_extract(F.col("_metadata.file_path"), r"/sample=([^/]*)/[^/]*$", 1), F.lit("+"), F.lit("%2B")))
    # once for the path of the file, once for the name in it
    sample = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    numbered = file_ordinals(lines.select("value", sample.alias("sample"), "_metadata"), "line", per_file=True)
    parts = F.split("value", " ")
    return numbered.filter(~F.col("value").startswith("%")).select(
        "sample", (F.col("line") - 2).alias("line"), *[parts[i].cast("long").alias(c) for i, c in enumerate(("row", "col", "n"))]
    )


def write_counts(counts: DataFrame, cells: DataFrame, genes: DataFrame, path: str) -> None:
    """The annotated matrix as three Parquet tables; counts and cells are split by sample."""
    counts.write.mode("overwrite").partitionBy("sample").parquet(f"{path}/counts")
    cells.write.mode("overwrite").partitionBy("sample").parquet(f"{path}/cells")
    genes.write.mode("overwrite").parquet(f"{path}/genes")


def write_corrections(listed: DataFrame, path: str) -> None:
    """``barcode TAB variants`` lines in list order."""
    correction_lines(listed).orderBy("row_no").select("value").write.mode("overwrite").text(path)


def correction_lines(listed: DataFrame) -> DataFrame:
    return listed.select("row_no", F.concat_ws("\t", "barcode", F.concat_ws(",", "variants")).alias("value"))


def collision_lines(collisions: DataFrame, stats: DataFrame) -> DataFrame:
    """``part, origin_count, value``: the five totals, a heading, then a line per colliding variant.

    A variant's origins are listed by name; there are as many as the list has barcodes one base away.
    """
    totals = stats.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("part"), F.concat_ws("\t", F.lit(c), F.col(c).cast("string")).alias("value"))
                           for i, c in enumerate(COLLISION_TOTALS)]))
    ).select("part", F.lit(0).cast("long").alias("origin_count"), "value")
    heading = stats.select(
        F.lit(len(COLLISION_TOTALS)).alias("part"), F.lit(0).cast("long").alias("origin_count"),
        F.lit("variant\torigin_count\torigins").alias("value"),
    )
    listed = collisions.groupBy("variant", "origin_count").agg(F.array_sort(F.collect_list("origin")).alias("o"))
    body = listed.select(
        F.lit(len(COLLISION_TOTALS) + 1).alias("part"), F.col("origin_count").cast("long").alias("origin_count"),
        F.concat_ws("\t", "variant", F.col("origin_count").cast("string"), F.concat_ws(",", "o")).alias("value"),
    )
    return totals.unionByName(heading).unionByName(body)


# Names of the report's totals, in order.
COLLISION_TOTALS = (
    "total_barcodes", "barcodes_with_corrections", "barcodes_without_corrections", "total_variants_removed",
    "total_safe_variants",
)


def collision_report(collisions: DataFrame, stats: DataFrame, path: str) -> None:
    """Totals first, then the variants with most origins first."""
    lines = collision_lines(collisions, stats).orderBy("part", F.desc("origin_count"), "value")
    lines.select("value").write.mode("overwrite").text(path)


def bed12_lines(models: DataFrame) -> DataFrame:
    """One BED12 line per transcript: 0-based start, trailing commas in the block lists."""

    def listed(column: str):
        return F.concat(F.concat_ws(",", F.transform(column, lambda v: v.cast("string"))), F.lit(","))

    fields = [
        F.col("chrom"),
        (F.col("start") - 1).cast("string"),
        F.col("end").cast("string"),
        F.col("transcript_id"),
        F.lit("0"),
        F.col("strand"),
        (F.col("cds_start") - 1).cast("string"),
        F.col("cds_end").cast("string"),
        F.lit("0"),
        F.col("exon_count").cast("string"),
        listed("block_sizes"),
        listed("block_starts"),
    ]
    return models.select("chrom", "first_exon_start", "transcript_id", F.concat_ws("\t", *fields).alias("value"))


def write_bed12(models: DataFrame, path: str) -> None:
    """Gene models ordered by chromosome, first exon start and transcript."""
    lines = bed12_lines(models).orderBy("chrom", "first_exon_start", "transcript_id")
    lines.select("value").write.mode("overwrite").text(path)


def write_alignments(alignments: DataFrame, path: str) -> None:
    """O1: alignments as Parquet, clustered by place inside each file so readers can skip row groups."""
    alignments.sortWithinPartitions("sample", "chrom", "pos").write.mode("overwrite").partitionBy("sample").parquet(path)


def metric_text():
    """Integral values without decimals, others as plain decimals."""
    whole = format_value(F.col("value"), F.lit(True))
    return F.when(F.col("is_integral"), whole).otherwise(plain(F.col("value")))


def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    """Metric rows per sample; the value is text, integral values without decimals."""
    rows = metrics.select(
        "sample", "ord", "variable_name", metric_text().alias("value"), "human_readable_name", "description", "classification"
    )
    ordered = rows.repartitionByRange("sample").sortWithinPartitions("sample", "ord").drop("ord")
    ordered.write.mode("overwrite").partitionBy("sample").csv(path, header=True)


def read_written_metrics(spark, path: str) -> DataFrame:
    """Metric rows back from the folders ``write_metrics_csv`` makes."""
    schema = "variable_name string, value string, human_readable_name string, description string, classification string, sample string"
    rows = spark.read.schema(schema).csv(path, header=True)
    return rows.withColumn("is_integral", ~F.col("value").contains(".")).withColumn("value", F.col("value").cast("double"))


def write_multisample_csv(pivoted: DataFrame, path: str) -> None:
    """The wide table as one file; it has one row per metric."""
    pivoted.orderBy("ord").drop("ord").coalesce(1).write.mode("overwrite").csv(path, header=True)


def fastq_lines(reads: DataFrame, header: str, seq: str, qual: str, *more: str) -> DataFrame:
    return reads.select("sample", F.concat_ws("\n", header, seq, F.lit("+"), qual).alias("value"), *more)


def rejected_fastq_lines(failed: DataFrame) -> DataFrame:
    """R1 and R2 records of the reads that did not pass, from one pass over them."""
    mates = [
        F.struct(F.lit(m).alias("mate"), F.col(f"{m}_seq").alias("_seq"), F.col(f"{m}_qual").alias("_qual")) for m in ("r1", "r2")
    ]
    both = failed.select("sample", "header", F.inline(F.array(*mates)))
    return fastq_lines(both, "header", "_seq", "_qual", "mate")


def write_fastq(passed: DataFrame, path: str) -> None:
    """Trimmed R1 records with tagged names, gzip, one folder per sample."""
    tagged = passed.withColumn("header", names.tagged_header(F.col("header"), F.col("barcode")))
    lines = fastq_lines(tagged, "header", "out_seq", "out_qual")
    lines.write.mode("overwrite").partitionBy("sample").option("compression", "gzip").text(path)


def write_fastq_files(reads: DataFrame, header: str, seq: str, qual: str, order: list[str], path: str, packed: bool = True) -> dict[str, int]:
    """The records of each ``file`` of ``reads`` in the given order as one FASTQ file, block-gzip or plain."""
    value = F.concat_ws("\n", header, seq, F.lit("+"), qual)
    return write_files(reads.select("file", *order, value.alias("value")), order, path, packed)


def write_rejected_fastq(failed: DataFrame, path: str) -> None:
    """R1 and R2 of the reads that did not pass."""
    for mate in ("r1", "r2"):
        lines = fastq_lines(failed, "header", f"{mate}_seq", f"{mate}_qual")
        lines.write.mode("overwrite").partitionBy("sample").option("compression", "gzip").text(f"{path}/{mate}")


def write_qc_json(documents: DataFrame, path: str) -> None:
    """One JSON document per line, one folder per sample and kind."""
    documents.select("sample", "kind", F.col("document").alias("value")).write.mode("overwrite").partitionBy(
        "sample", "kind"
    ).text(path)
