"""The SAM scan against the line reader, and region reads against plain filters."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from cellspark.sources import readers, regions, sam

from .test_splits import blocked


def sam_text(n, seed, ending="\n"):
    rng = random.Random(seed)
    lines = ["@HD\tVN:1.6", "@SQ\tSN:chr1", ""]
    for i in range(n):
        tags = [f"NH:i:{rng.randrange(1, 4)}", f"HI:i:{i % 3}", f"AS:i:-{i % 7}", f"nM:i:{i % 5}"]
        tags += [x for x in ("XS:Z:", "XS:Z:Assigned", "XN:i:2", "XT:Z:ENSG1.5", "XX:Z:é") if rng.random() < 0.4]
        rng.shuffle(tags)
        fields = [f"r{i}{'é' if i % 50 == 3 else ''}", rng.choice([0, 16, 256]), rng.choice(["chr1", "chr2", "MT"]), rng.randrange(1, 5000), 255]
        lines.append("\t".join(map(str, [*fields, f"{i % 90 + 1}M", "*", 0, 0, "ACGT" * (i % 9), "*", *tags])))
        if i % 40 == 0:
            lines += ["", "@CO\tin between"]
    return (ending.join(lines) + (ending if seed % 2 else "")).encode()


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sam")
    texts = {"A": sam_text(900, 1), "B": sam_text(300, 2), "C": sam_text(200, 3, "\r\n"), "D": b"@HD\tonly\n", "E": b"", "F": sam_text(9, 4)}
    rows = []
    for name, kind in (("A", "blocks"), ("B", "plain"), ("C", "plain"), ("D", "blocks"), ("E", "plain"), ("F", "gzip")):
        data = texts[name]
        packed = blocked(data, [900, 37, 0, 4000]) if kind == "blocks" else gzip.compress(data) if kind == "gzip" else data
        ending = ".sam" if kind == "plain" else ".sam.gz"
        (root / f"{name}{ending}").write_bytes(packed)
        rows.append((name, f"{root}/{name}{ending}"))
    return spark.createDataFrame(rows, "sample string, path string"), str(root)


def got(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("split_bytes", [777, 20_000, 1 << 26])
def test_scan_equals_the_line_reader(spark, files, split_bytes):
    sheet, root = files
    want = readers.read_alignments(spark, root).select(*sam.COLUMNS)
    found = sam.scan_alignments(spark, sheet, split_bytes=split_bytes)
    assert found.columns == list(sam.COLUMNS) and found.count() == 900 + 300 + 200 + 9
    assert got(found) == got(want)


CONDITIONS = {
    "chrom = 'chr1'": [("chrom", "=", "chr1")],
    "pos between 100 and 900": [("pos", ">=", 100), ("pos", "<=", 900)],
    "flag = 16 and chrom in ('MT', 'chr2')": [("flag", "=", 16), ("chrom", "in", ["MT", "chr2"])],
    "sample = 'B'": [("sample", "=", "B")],
    "sample in ('A', 'F') and pos > 4000": [("sample", "in", ["A", "F"]), ("pos", ">", 4000)],
    "sample > 'A' and sample <= 'C' and mapq < 300": [("sample", ">", "A"), ("sample", "<=", "C"), ("mapq", "<", 300)],
    "read_name >= 'r5' and read_name < 'r\u00e9'": [("read_name", ">=", "r5"), ("read_name", "<", "ré")],
    "chrom = 'none'": [("chrom", "=", "none")],
    "sample = 'none'": [("sample", "=", "none")],
    "cigar in ('5M')": [("cigar", "in", ["5M"])],
    "flag in (cast(null as int))": [("flag", "in", [])],
}


@pytest.mark.parametrize("condition", CONDITIONS)
def test_conditions_in_the_scan(spark, files, condition):
    sheet, root = files
    columns = ["sample", "read_name", "pos", "nm"]
    want = readers.read_alignments(spark, root).filter(condition).select(*columns)
    found = sam.scan_alignments(spark, sheet, columns, CONDITIONS[condition], split_bytes=5000)
    assert found.columns == columns
    assert got(found) == got(want)


def test_frames_share_no_conditions(spark, files):
    sheet, _ = files
    whole = sam.scan_alignments(spark, sheet, ["sample", "pos"], split_bytes=5000)
    one = sam.scan_alignments(spark, sheet, ["sample"], [("sample", "=", "A")], split_bytes=5000)
    assert one.rdd.getNumPartitions() < whole.rdd.getNumPartitions()
    counts = [whole.filter(c).count() for c in ("sample = 'A'", "sample = 'B'", "true", "sample = 'B' and pos > 0")]
    assert counts == [900, 300, 1409, 300] and one.count() == 900 and whole.count() == 1409


@pytest.mark.parametrize("where", [("nh", "=", 1), ("pos", "like", 1), ("pos", "=", "1"), ("chrom", "in", [None]), ("pos", "=", None)])
def test_conditions_that_are_none(spark, files, where):
    with pytest.raises(ValueError):
        sam.scan_alignments(spark, files[0], where=[where])
    with pytest.raises(ValueError):
        sam.scan_alignments(spark, files[0], ["chromosome"])


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(6)
    rows = []
    for i in range(4000):
        chrom = rng.choice(["1", "1", "1", "2", "X"])
        cigar = rng.choice(["50M", "20M900N30M", "5S40M", "10M20000N10M" if i % 100 == 0 else "9M2D9M"])
        rows.append((rng.choice(["S", "T"]), f"r{i}", chrom, rng.randrange(1, 100_000), cigar, i))
    rows += [("S", "none", None, None, "*", -1), ("T", "half", "1", None, "*", -2)]
    path = str(tmp_path_factory.mktemp("regions"))
    df = spark.createDataFrame(rows, "sample string, read_name string, chrom string, pos long, cigar string, i int")
    df = df.repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        regions.write_regions(df, path, window=1000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    return path


@pytest.mark.parametrize(
    "chrom, first, last, samples",
    [("1", 5000, 6000, None), ("1", 40_000, 40_000, ["T"]), ("2", 1, 10**9, None), ("X", 99_999, 100_500, ["S"]), ("3", 1, 9, None), ("1", 150_000, 160_000, None)],
)
def test_regions(spark, stored, chrom, first, last, samples):
    whole = spark.read.parquet(f"{stored}/data")
    want = whole.filter((F.col("chrom") == chrom) & (F.col("pos") <= last) & (F.col("end") >= first))
    if samples:
        want = want.filter(F.col("sample").isin(samples))
    found = regions.read_region(spark, stored, chrom, first, last, samples)
    assert got(found) == got(want)
    if last - first < 5000 and chrom != "3":
        read = {f.rsplit("/", 1)[1] for f in found.inputFiles()}
        assert len(read) < len(whole.inputFiles()) // 2


def test_a_region_reads_only_the_files_named(spark, stored):
    found = regions.read_region(spark, stored, "2", 7000, 7100, ["S"])
    named = {
        r.file
        for r in regions.read_index(spark, stored).collect()
        if r.chrom == "2" and r["sample"] == "S" and r.least <= 7100 and r.most >= 7000
    }
    assert {f.rsplit("/", 1)[1] for f in found.inputFiles()} == named
    frame = found._jdf.queryExecution()
    frame.executedPlan().executeCollect()
    plan = frame.executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    metrics = plan.metrics()
    assert metrics.apply("numFiles").value() == len(named)
    assert metrics.apply("numOutputRows").value() < spark.read.parquet(f"{stored}/data").count() // 2


def test_coverage(spark, stored):
    whole = spark.read.parquet(f"{stored}/data").filter("pos is not null and chrom is not null")
    want = whole.groupBy("sample", "chrom", F.floor(F.col("pos") / 1000).alias("window")).count()
    assert got(regions.coverage(spark, stored).toDF("a", "b", "c", "d")) == got(want.toDF("a", "b", "c", "d"))


def test_no_alignments(spark, tmp_path):
    df = spark.createDataFrame([], "sample string, read_name string, chrom string, pos long, cigar string")
    regions.write_regions(df, str(tmp_path))
    assert regions.read_region(spark, str(tmp_path), "1", 1, 9).count() == 0
