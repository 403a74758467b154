"""Single-file outputs, consecutive file ordinals, prefix sums and the compressed sparse layout."""

import gzip
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cellspark.plans.scale import prefix_sums
from cellspark.sources import fastq, readers, single_file, sparse, writers


def lines_frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "file string, value string, k long").repartition(parts)


def test_one_file_each_in_order(spark, tmp_path):
    rng = random.Random(2)
    keys = {"a/x.gz": rng.sample(range(10**6), 3000), "b.gz": [1], "c é.gz": rng.sample(range(10**6), 500)}
    rows = [(f, f"line {k} é" + "x" * (k % 50), k) for f, ks in keys.items() for k in ks]
    sizes = single_file.write_files(lines_frame(spark, rows), ["k"], str(tmp_path))
    assert set(sizes) == set(keys)
    for name, ks in keys.items():
        data = (tmp_path / name).read_bytes()
        assert len(data) == sizes[name]
        assert gzip.decompress(data).decode() == "".join(f"line {k} é" + "x" * (k % 50) + "\n" for k in sorted(ks))
    # nothing else stays, and a file in place is replaced
    assert sorted(os.listdir(tmp_path)) == ["a", "b.gz", "c é.gz"]
    single_file.write_files(lines_frame(spark, [("b.gz", "two", 2), ("b.gz", "one\nand", 1)]), ["k"], str(tmp_path), packed=False)
    assert (tmp_path / "b.gz").read_text() == "one\nand\ntwo\n"
    assert single_file.write_files(lines_frame(spark, rows).limit(0), ["k"], str(tmp_path)) == {}


@pytest.mark.parametrize("bad", [("b", None, 7), (None, "x", 7)])
def test_a_failed_task_leaves_nothing(spark, tmp_path, bad):
    rows = [(f, f"{k}", k) for f in ("a", "b", "c") for k in range(200)]
    with pytest.raises(Exception, match="is null"):
        single_file.write_files(lines_frame(spark, [*rows, bad]), ["k"], str(tmp_path))
    assert os.listdir(tmp_path) == []


def test_a_failed_task_leaves_the_old_file(spark, tmp_path):
    old = lines_frame(spark, [("m", "old", 1)])
    single_file.write_files(old, ["k"], str(tmp_path), packed=False)

    @F.udf("string")
    def killed(value):
        if value == "150":
            raise SystemExit("worker is killed")
        return value

    rows = lines_frame(spark, [("m", f"{k}", k) for k in range(200)]).withColumn("value", killed("value"))
    with pytest.raises(Exception):
        single_file.write_files(rows, ["k"], str(tmp_path), packed=False)
    assert os.listdir(tmp_path) == ["m"] and (tmp_path / "m").read_text() == "old\n"


def parse_matrix_market(path):
    """A plain reader of the coordinate format."""
    with gzip.open(path, "rt") as file:
        assert file.readline().split() == ["%%MatrixMarket", "matrix", "coordinate", "integer", "general"]
        line = file.readline()
        while line.startswith("%"):
            line = file.readline()
        rows, cols, stored = map(int, line.split())
        entries = [tuple(map(int, x.split())) for x in file]
    assert len(entries) == stored
    return rows, cols, entries


def small_matrix(spark, seed=1):
    rng = random.Random(seed)
    entries, genes, barcodes = [], [], []
    for sample, n_genes, n_cells, density in (("S 1/%", 40, 30, 0.2), ("S2", 7, 60, 0.9), ("none", 3, 2, 0.0)):
        genes += [(sample, f"g{i}", None if i % 3 else f"name{i}", i) for i in range(1, n_genes + 1)]
        barcodes += [(sample, f"b{i:04}", i) for i in range(1, n_cells + 1)]
        # a gene that every barcode has, a barcode with every gene
        entries += [
            (sample, g, b, rng.randrange(1, 9))
            for g in range(1, n_genes + 1)
            for b in range(1, n_cells + 1)
            if density and (rng.random() < density or g == 2 or b == 5) and b != 7
        ]
    return (
        entries,
        spark.createDataFrame(entries, "sample string, gene_index long, barcode_index long, n long").repartition(6),
        spark.createDataFrame(genes, "sample string, gene_id string, gene_name string, gene_index long").repartition(3),
        spark.createDataFrame(barcodes, "sample string, barcode string, barcode_index long").repartition(3),
    )


def test_matrix_files(spark, tmp_path):
    entries, *frames = small_matrix(spark)
    writers.write_matrix_files(*frames, str(tmp_path))
    for sample, folder, n_genes, n_cells in (("S 1/%", "S 1%2F%25", 40, 30), ("S2", "S2", 7, 60), ("none", "none", 3, 2)):
        place = tmp_path / f"sample={folder}"
        rows, cols, found = parse_matrix_market(place / "matrix.mtx.gz")
        assert (rows, cols) == (n_genes, n_cells)
        assert found == sorted(((g, b, n) for s, g, b, n in entries if s == sample), key=lambda e: (e[1], e[0]))
        names = gzip.decompress((place / "barcodes.tsv.gz").read_bytes()).decode().split("\n")
        assert names == [f"{sample}_b{i:04}" for i in range(1, n_cells + 1)] + [""]
        features = gzip.decompress((place / "features.tsv.gz").read_bytes()).decode().split("\n")
        assert features[2] == "g3\tname3\tGene Expression" and len(features) == n_genes + 1
    back = writers.read_matrix_files(spark, str(tmp_path)).filter("line > 0")
    assert sorted((r["sample"], r.row, r.col, r.n) for r in back.collect()) == sorted(entries)


def test_sparse_layout(spark, tmp_path):
    entries, *frames = small_matrix(spark, 4)
    path = str(tmp_path / "sparse")
    sparse.write_sparse(*frames, path)
    assert sorted(map(tuple, sparse.read_triples(spark, path).collect())) == sorted(entries)
    for axis, (major, _) in sparse.AXES.items():
        order = (lambda e: (e[2], e[1])) if axis == "rows" else (lambda e: (e[1], e[2]))
        by_sample = defaultdict(list)
        for e in sorted(entries, key=order):
            by_sample[e[0]].append(e)
        want = [(s, i, *order(e), e[3]) for s, found in by_sample.items() for i, e in enumerate(found)]
        assert sorted(map(tuple, sparse.read_entries(spark, path, axis).collect())) == sorted(want)
        starts = {(r["sample"], r.major): (r.start, r.stored) for r in sparse.read_pointers(spark, path, axis).collect()}
        for sample, size in (("S 1/%", 30), ("S2", 60), ("none", 2)) if axis == "rows" else (("S 1/%", 40), ("S2", 7), ("none", 3)):
            at = 0
            for i in range(1, size + 1):
                stored = sum(order(e)[0] == i for e in by_sample[sample])
                assert starts.pop((sample, i)) == (at, stored)
                at += stored
        assert not starts
        for first, last, samples in ((5, 7, None), (1, 1, ["S2"]), (7, 7, None), (50, 900, None), (3, 2, None), (1, 99, ["none"])):
            got = sparse.read_slice(spark, path, axis, first, last, samples)
            assert sorted(map(tuple, got.collect())) == sorted(
                w for w in want if first <= w[2] <= last and (samples is None or w[0] in samples)
            )
    plan = sparse.read_slice(spark, path, "rows", 5, 6, ["S2"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "GreaterThanOrEqual(place," in plan
    none = [f.limit(0) for f in frames]
    sparse.write_sparse(*none, path)
    assert sparse.read_triples(spark, path).count() == 0


def test_ordinals_over_files_and_blocks(spark, tmp_path):
    rng = random.Random(8)
    texts = [[f"{i}:{k}" + "y" * rng.randrange(60) for k in range(n)] for i, n in enumerate((700, 0, 1, 90, 2000))]
    for i, lines in enumerate(texts):
        data = "".join(f"{x}\n" for x in lines).encode()
        (tmp_path / f"{i}.txt{'.gz' if i == 3 else ''}").write_bytes(gzip.compress(data) if i == 3 else data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4096b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            read = spark.read.text(str(tmp_path)).select("value", "_metadata")
            got = {r.row_no: r.value for r in readers.file_ordinals(read).select("value", "row_no").collect()}
            assert [got[i] for i in range(len(got))] == [x for lines in texts for x in lines]
            own = readers.file_ordinals(read, "n", per_file=True).select("value", "n").collect()
            assert sorted((r.value.split(":")[0], r.n) for r in own) == sorted((str(i), k) for i, t in enumerate(texts) for k in range(len(t)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_prefix_sums(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("abc"), k, rng.randrange(5)) for k in range(2000)]
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(7)
    got = {(r.g, r.k): r.s for r in prefix_sums(df, ["g"], [F.col("k")], F.col("v"), "s").collect()}
    sums = defaultdict(int)
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        assert got.pop((g, k)) == sums[g]
        sums[g] += v
    assert not got


def test_fastq_files_round_trip(spark, tmp_path):
    rows = [(f"L{i % 2}.gz", i, f"@r{i}", "ACGT" * (i % 9 + 1), "IIII" * (i % 9 + 1)) for i in range(500)]
    df = spark.createDataFrame(rows, "file string, i long, h string, s string, q string").repartition(4)
    for mate in ("a", "b"):
        named = df.withColumn("file", F.concat(F.lit(mate), "file"))
        writers.write_fastq_files(named, "h", "s", "q", ["i"], str(tmp_path))
    sheet = spark.createDataFrame(
        [("S", lane, f"{tmp_path}/aL{lane}.gz", f"{tmp_path}/bL{lane}.gz") for lane in (0, 1)],
        "sample string, lane int, fastq_1 string, fastq_2 string",
    )
    got = fastq.read_fastq_pairs(spark, sheet, split_bytes=2000, merged=True)
    want = sorted((0 if r[1] % 2 == 0 else 1, r[1], r) for r in rows)
    assert sorted((r.ord, r.header, r.r1_seq, r.r2_qual) for r in got.collect()) == [
        (i, r[2], r[3], r[4]) for i, (_, _, r) in enumerate(want)
    ]
