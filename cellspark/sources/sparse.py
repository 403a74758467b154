"""The annotated matrix in compressed sparse form, as tables.

``rows`` holds the entries by barcode, ``columns`` by gene. Each has ``entries`` (place, major, minor, n: places count a
sample's entries from 0 in the order of major and minor index) and ``pointers`` (major, start, stored: where the entries
of a row or column begin and how many there are; rows without entries too). Places come from numbering the entries by
ranges, pointers from prefix sums over ranges, so neither a sample nor a barcode or gene with most of the entries meets
in one task. Entries are written in order of place: a slice is a range of places, whose files and row groups the
reader's statistics find. ``obs`` and ``var`` describe barcodes and genes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.plans.scale import number_rows, prefix_sums

#: Axis: (major index, minor index).
AXES = {"rows": ("barcode_index", "gene_index"), "columns": ("gene_index", "barcode_index")}
_POINTERS = "major long, start long, stored long, sample string"
_ENTRIES = "place long, major long, minor long, n long, sample string"


def compressed_entries(entries: DataFrame, axis: str) -> DataFrame:
    """``sample, place, major, minor, n``: entries with their place along an axis."""
    major, minor = AXES[axis]
    named = entries.select("sample", F.col(major).alias("major"), F.col(minor).alias("minor"), F.col("n").cast("long").alias("n"))
    placed = number_rows(named, ["sample"], [F.col("major"), F.col("minor")], "place")
    return placed.select("sample", (F.col("place") - 1).alias("place"), "major", "minor", "n")


def pointers(entries: DataFrame, extent: DataFrame, axis: str) -> DataFrame:
    """``sample, major, start, stored`` for every row or column that ``extent`` (the genes or barcodes) lists."""
    major = AXES[axis][0]
    stored = entries.groupBy("sample", F.col(major).alias("major")).agg(F.count(F.lit(1)).alias("stored"))
    every = extent.select("sample", F.col(major).alias("major")).join(stored, ["sample", "major"], "left").na.fill(0, ["stored"])
    summed = prefix_sums(every, ["sample"], [F.col("major")], F.col("stored"), "start")
    return summed.select("sample", "major", "start", "stored")


def _write(df: DataFrame, order: str, path: str, ranged: bool = False) -> None:
    """``ranged``: the rows come from tables of ranges in order, which are only merged inside a task."""
    rows = (df if ranged else df.repartitionByRange("sample", order)).sortWithinPartitions("sample", order)
    rows.write.mode("overwrite").partitionBy("sample").parquet(path)


def write_sparse(entries: DataFrame, genes: DataFrame, barcodes: DataFrame, path: str) -> None:
    """Both compressed forms and the descriptions of barcodes (``obs``) and genes (``var``).

    ``entries`` has sample, gene_index, barcode_index, n, each pair of indexes once; ``genes`` and ``barcodes`` carry
    their index (from 1, without gaps) and anything that describes them.
    """
    for axis, extent in (("rows", barcodes), ("columns", genes)):
        _write(compressed_entries(entries, axis), "place", f"{path}/{axis}/entries", ranged=True)
        _write(pointers(entries, extent, axis), "major", f"{path}/{axis}/pointers")
    _write(barcodes, "barcode_index", f"{path}/obs")
    _write(genes, "gene_index", f"{path}/var")


def read_pointers(spark: SparkSession, path: str, axis: str) -> DataFrame:
    return spark.read.schema(_POINTERS).parquet(f"{path}/{axis}/pointers").select("sample", "major", "start", "stored")


def read_entries(spark: SparkSession, path: str, axis: str) -> DataFrame:
    return spark.read.schema(_ENTRIES).parquet(f"{path}/{axis}/entries").select("sample", "place", "major", "minor", "n")


def read_slice(spark: SparkSession, path: str, axis: str, first: int, last: int, samples: list[str] | None = None) -> DataFrame:
    """Entries of the rows (or columns) ``first`` to ``last``, both included, of some or all samples.

    The pointers give one range of places per sample; the scan is asked for these ranges only.
    """
    listed = read_pointers(spark, path, axis).filter(F.col("major").between(first, last))
    if samples is not None:
        listed = listed.filter(F.col("sample").isin(samples))
    ranges = listed.groupBy("sample").agg(F.min("start").alias("a"), F.max(F.col("start") + F.col("stored")).alias("b")).collect()
    wanted = F.lit(False)
    for row in ranges:
        wanted = wanted | ((F.col("sample") == row["sample"]) & (F.col("place") >= row["a"]) & (F.col("place") < row["b"]))
    return read_entries(spark, path, axis).filter(wanted)


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """``sample, gene_index, barcode_index, n`` as they were written."""
    return read_entries(spark, path, "rows").select("sample", F.col("minor").alias("gene_index"), F.col("major").alias("barcode_index"), "n")
