import gzip
import json

import pytest
from pyspark.sql import functions as F

from cellspark.config import EngineConfig
from cellspark.operators import annotation, barcodes, profiles, reads_qc, report
from cellspark.plans import bridge, pipeline
from cellspark.plans.scale import materialize, stage_tables
from cellspark.sources import fastq, readers, writers

SF = "/root/testdata/sf0.001"


def test_samplesheet_modes(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("id,r1,r2,thr,thr2\nA, a1.gz ,a2.gz,3.3,3.4\nB,b1,b2,3.2,\nA,a3,a4,,\n")
    rows = {(r["sample"], r.lane): r for r in readers.read_samplesheet(spark, str(path), mixed=True).collect()}
    assert set(rows) == {("A", 1), ("A", 2), ("B", 1)}
    assert rows["A", 1].fastq_1 == "a1.gz" and rows["A", 2].fastq_1 == "a3"
    assert (rows["B", 1].hsap_threshold, rows["B", 1].mmus_threshold) == (3.2, None)
    sheet = readers.read_samplesheet(spark, str(path), mixed=False)
    assert {r["sample"]: r.manual_threshold for r in readers.manual_thresholds(sheet).collect()} == {"A": 3.3, "B": 3.2}
    path.write_text("id,r1,r2,thr\nA,a,b,2.4\n")
    r = readers.read_samplesheet(spark, str(path), mixed=True).first()
    assert (r.hsap_threshold, r.mmus_threshold) == (None, None)
    assert "manual_threshold" in readers.read_samplesheet(spark, str(path)).columns


def fastq_text(records):
    return "".join(f"{h}\n{s}\n+\n{q}\n" for h, s, q in records).encode()


def test_fastq_lanes_and_members(spark, tmp_path):
    one = [(f"@a{i} 1", "ACGT" * 5, "I" * 20) for i in range(5)]
    two = [(f"@b{i} 1", "TTTT" * 5, "#" * 20) for i in range(3)]
    mates = [(f"@m{i} 2", "ACGTACGTACGTA", "I" * 13) for i in range(5)]
    # gzip with two members, mates as plain text
    (tmp_path / "a1.gz").write_bytes(gzip.compress(fastq_text(one[:2])) + gzip.compress(fastq_text(one[2:])))
    (tmp_path / "a2.fq").write_bytes(fastq_text(mates))
    (tmp_path / "b1.fq").write_bytes(fastq_text(two))
    (tmp_path / "b2.gz").write_bytes(gzip.compress(fastq_text(mates[:2])))
    sheet = spark.createDataFrame(
        [("A", 1, str(tmp_path / "a1.gz"), str(tmp_path / "a2.fq")), ("A", 2, str(tmp_path / "b1.fq"), f"file:{tmp_path}/b2.gz")],
        "sample string, lane int, fastq_1 string, fastq_2 string",
    )
    rows = {(r.lane, r.ord): r for r in fastq.read_fastq_pairs(spark, sheet, 3).collect()}
    assert set(rows) == {(1, i) for i in range(5)} | {(2, i) for i in range(3)}
    assert rows[1, 3].header == "@a3 1" and rows[1, 3].r2_seq == "ACGTACGTACGTA" and rows[1, 3].r1_qual == "I" * 20
    assert rows[2, 2].r2_seq == "" and rows[2, 1].r2_seq == "ACGTACGTACGTA"


def test_corrections_round_trip(spark, tmp_path):
    wl = spark.createDataFrame([("AAAA", 0), ("AAAT", 1), ("CCCC", 2), ("CCCC", 3)], "barcode string, row_no long")
    writers.write_corrections(barcodes.correction_list(wl), str(tmp_path / "list"))
    lines = [x for p in sorted((tmp_path / "list").glob("part-*")) for x in p.read_text().splitlines()]
    assert [x.split("\t")[0] for x in lines] == ["AAAA", "AAAT", "CCCC", "CCCC"]
    assert lines[2] == "CCCC\t"
    known, corrections = readers.read_corrections(spark, str(tmp_path / "list"))
    assert known.count() == 4
    want = {(r.variant, r.barcode) for r in barcodes.curate_corrections(wl).collect()}
    assert {(r.variant, r.barcode) for r in corrections.collect()} == want


def test_whitelist_and_gtf(spark, tmp_path):
    (tmp_path / "wl.csv").write_text("cell,io,ioID\nc1,ACGT,1\nc2,TTTT,2\n")
    rows = readers.read_whitelist(spark, str(tmp_path / "wl.csv")).orderBy("row_no").collect()
    assert [r.barcode for r in rows] == ["ACGT", "TTTT"]
    body = "#c\n\n1\ts\texon\t10\t20\t.\t+\t.\tgene_id \"G.2\"; transcript_id \"T\";\nshort\tline\n"
    body += "1\ts\texon\t30\t40\t.\t+\t.\tgene_id \"G.2\"; transcript_id \"T\"; gene_name \"N\";\n"
    (tmp_path / "a.gtf.gz").write_bytes(gzip.compress(body.encode()))
    gtf = readers.read_gtf(spark, str(tmp_path / "a.gtf.gz"))
    assert [(r.start, r.end) for r in gtf.orderBy("row_no").collect()] == [(10, 20), (30, 40)]
    assert [tuple(r)[:3] for r in annotation.features(gtf).collect()] == [("G", "G", "1")]
    writers.write_bed12(annotation.gene_models(gtf), str(tmp_path / "bed"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "bed").glob("part-*")))
    assert text == "1\t9\t40\tT\t0\t+\t9\t40\t0\t2\t11,11,\t0,20,\n"


def test_file_order_over_many_splits(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join(f"{i}\n" for i in range(700_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        rows = readers.file_order(spark.read.text(str(path)))
        assert rows.rdd.getNumPartitions() > 2
        got = [r.value for r in rows.orderBy("row_no").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [str(i) for i in range(700_000)]


def test_sam_tags_by_name(spark, tmp_path):
    head = "@HD\tVN:1\n"
    a = "r_AC_\t256\t5\t100\t3\t34M\t*\t0\t0\tACGT\tIIII\tnM:i:1\tHI:i:2\tNH:i:3\tAS:i:33\tXS:Z:Assigned\tXN:i:1\tXT:Z:G1.2\n"
    b = "s_AC_\t0\t5\t100\t255\t34M\t*\t0\t0\tACGT\tIIII\tNH:i:1\tHI:i:1\tAS:i:33\tnM:i:0\n"
    (tmp_path / "a.sam").write_text(head + a + b)
    rows = readers.read_alignments(spark, str(tmp_path / "a.sam"), "S").orderBy("read_name").collect()
    assert (rows[0].nh, rows[0].hi, rows[0].nm, rows[0].xs, rows[0].xn, rows[0].xt) == (3, 2, 1, "Assigned", 1, "G1.2")
    assert (rows[1].nh, rows[1].xs, rows[1].xt) == (1, None, None)


def test_metrics_and_fastq_outputs(spark, tmp_path):
    qc = pipeline.read_stage(bridge.reads(spark, SF), bridge.whitelist(spark, SF), cfg=EngineConfig()).cache()
    cascade = reads_qc.qc_cascade(qc).cache()
    rows = report.read_qc_rows(cascade, reads_qc.derived_read_metrics(cascade)).cache()
    writers.write_metrics_csv(rows, str(tmp_path / "metrics"))
    back = {(r["sample"], r.variable_name): r for r in writers.read_written_metrics(spark, str(tmp_path / "metrics")).collect()}
    for r in rows.collect():
        assert back[r["sample"], r.variable_name].value == r.value
        assert "," not in r.description
    folder = tmp_path / "flat"
    folder.mkdir()
    (folder / "S 1.metrics.csv").write_text(
        "variable_name,value,human_readable_name,description,classification\nnum_cells,12,Cells,d,Cell metrics\nraw,1.5,R,d,Read QC\n"
    )
    flat = {r.variable_name: (r["sample"], r.value, r.is_integral) for r in readers.read_metrics_csv(spark, str(folder)).collect()}
    assert flat == {"num_cells": ("S 1", 12.0, True), "raw": ("S 1", 1.5, False)}
    writers.write_multisample_csv(report.pivot_metrics(rows, ["S0", "S1", "S2"]), str(tmp_path / "wide"))
    wide = [x for p in (tmp_path / "wide").glob("part-*") for x in p.read_text().splitlines()]
    assert wide[0] == "variable_name,human_readable_name,description,classification,S0,S1,S2" and len(wide) == 24

    passed = reads_qc.passed_reads(qc)
    writers.write_fastq(passed, str(tmp_path / "fq"))
    lines = [x for p in (tmp_path / "fq").glob("sample=S1/*.gz") for x in gzip.open(p, "rt").read().splitlines()]
    assert len(lines) == 4 * passed.filter("sample = 'S1'").count()
    assert all(len(s) == len(q) for s, q in zip(lines[1::4], lines[3::4]))
    assert all(h.split(" ")[0].endswith("_") for h in lines[::4])
    rejected = reads_qc.failed_reads(qc)
    writers.write_rejected_fastq(rejected, str(tmp_path / "bad"))
    for mate in ("r1", "r2"):
        n = sum(len(gzip.open(p, "rt").read().splitlines()) for p in (tmp_path / "bad" / mate).glob("sample=*/*.gz"))
        assert n == 4 * rejected.count()

    documents = profiles.qc_summary_json(profiles.profiled_reads(qc)).cache()
    for r in documents.collect():
        tree = json.loads(r.document)
        part = "after" if r.kind == "R1 Post-QC" else "before"
        total = tree["summary"][f"{part}_filtering"]["total_reads"]
        assert sum(tree[f"read1_{part}_filtering"]["length_distribution"].values()) == total
    raw = {r["sample"]: r.raw_reads for r in profiles.raw_reads_from_json(documents).collect()}
    assert raw == {r["sample"]: r.raw_reads for r in cascade.collect()}
    writers.write_qc_json(documents, str(tmp_path / "json"))
    back = readers.read_qc_json(spark, str(tmp_path / "json")).filter("total_reads IS NOT NULL").collect()
    before = documents.filter("kind <> 'R1 Post-QC'").count()
    assert len(back) == before and sum(r.total_reads for r in back) == 2 * sum(raw.values())


def sam_line(name, flag, chrom, pos, cigar, tags):
    return "\t".join([name, str(flag), chrom, str(pos), "255", cigar, "*", "0", "0", "ACGT", "IIII", *tags])


def test_alignments_of_all_samples_in_one_scan(spark, tmp_path):
    for sample, n in (("S1", 2), ("S 2", 1)):
        lines = ["@HD\tVN:1.6", *(sam_line(f"r{i}", 0, "1", i + 1, "4M", ["HI:i:1", "NH:i:1", "nM:i:0"]) for i in range(n))]
        (tmp_path / f"{sample}.sam").write_text("\n".join(lines) + "\n")
    every = readers.read_alignments(spark, [str(tmp_path / "S1.sam"), str(tmp_path / "S 2.sam")])
    assert sorted((r["sample"], r.read_name, r.pos, r.nh) for r in every.collect()) == [("S 2", "r0", 1, 1), ("S1", "r0", 1, 1), ("S1", "r1", 2, 1)]
    assert {r["sample"] for r in readers.read_alignments(spark, str(tmp_path), name=r"/([^/]+)/[^/]+$").collect()} == {tmp_path.name}
    assert {r["sample"] for r in readers.read_alignments(spark, str(tmp_path / "S1.sam"), "mine").collect()} == {"mine"}


def test_collision_report_has_totals_first(spark, tmp_path):
    listed = spark.createDataFrame([("A" * 13, 1), ("C" + "A" * 12, 2), ("G" * 13, 3)], "barcode string, row_no long")
    writers.collision_report(barcodes.collisions(listed), barcodes.collision_stats(listed), str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).orderBy(F.monotonically_increasing_id()).collect()]
    assert lines[0] == "total_barcodes\t3" and lines[5] == "variant\torigin_count\torigins"
    assert lines[3] == f"total_variants_removed\t{len(lines) - 6}" and len(lines) > 6
    assert all(line.split("\t")[2] == "A" * 13 + "," + "C" + "A" * 12 for line in lines[6:])


def test_tables_of_counts_and_alignments(spark, tmp_path):
    counts = spark.createDataFrame([("S", "B", "G", 2)], "sample string, barcode string, gene_id string, n long")
    cells = spark.createDataFrame([("S", "B", True)], "sample string, barcode string, is_single_cell boolean")
    genes = spark.createDataFrame([("G", "g", False)], "gene_id string, gene_name string, is_mito boolean")
    writers.write_counts(counts, cells, genes, str(tmp_path / "m"))
    for name, df in (("counts", counts), ("cells", cells), ("genes", genes)):
        back = spark.read.parquet(str(tmp_path / "m" / name))
        assert back.select(*df.columns).collect() == df.collect()
    rows = [("S", f"r{i}", "21"[i % 2], (i * 37) % 50) for i in range(60)]
    placed = spark.createDataFrame(rows, "sample string, read_name string, chrom string, pos long").coalesce(1)
    writers.write_alignments(placed, str(tmp_path / "a"))
    back = [(r.chrom, r.pos) for r in spark.read.parquet(str(tmp_path / "a")).collect()]
    assert back == sorted((r[2], r[3]) for r in rows)


def test_feature_table_keeps_the_first_line_of_a_gene(spark, tmp_path):
    (tmp_path / "f.tsv").write_text("gene_id\tgene_name\tchromosome\nG1\ta\t1\nG2\tb\t2\nG1\tc\t3\n")
    found = {(r.gene_id, r.gene_name, r.chromosome) for r in readers.read_features(spark, str(tmp_path / "f.tsv")).collect()}
    assert found == {("G1", "a", "1"), ("G2", "b", "2")}


def test_stage_tables_go_when_a_run_ends(spark):
    kept = materialize(spark.range(3))
    with stage_tables(spark):
        inside = materialize(spark.range(5))
        path = inside.inputFiles()[0]
        assert inside.count() == 5
    assert kept.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|not found"):
        spark.read.parquet(path).count()


def test_sequences_are_looked_up(spark):
    big = 10**15
    pairs = [(0, 0), (96, 96), (97, 1), (12345678, 987654), (big, 7), (-5, 3), (4, -90), (-1, -1), (None, 3), (3, None), (97, 1)]
    rows = spark.createDataFrame([(i, k, s) for i, (k, s) in enumerate(pairs)], "id long, k long, l_suppkey long")
    found = bridge._sequences(rows)
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()

    def bases(k, s):
        return "".join("ACGT"[(k + i * i * 13 + i * s) % 97 % 4] for i in range(60))

    got = {r.id: r.s0 for r in found.collect()}
    assert len(got) == found.count() == len(pairs)
    for i, (k, s) in enumerate(pairs):
        direct = f"array_join(transform(sequence(0, 59), i -> substr('ACGT', cast(({k} + i * i * 13 + i * {s}) % 97 % 4 AS INT) + 1, 1)), '')"
        if k is None or s is None:
            assert got[i] == ""
        else:
            assert got[i] == spark.sql(f"select {direct} as v").first().v
            if k >= 0 and s >= 0:
                assert got[i] == bases(k, s)
