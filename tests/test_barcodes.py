from cellspark.config import ReadQcConfig
from cellspark.operators import barcodes, reads_qc
from cellspark.plans import scale
from cellspark.sources import writers


def whitelist(spark, codes):
    return spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "barcode string, row_no long")


def brute_variants(code):
    return [code[:i] + b + code[i + 1 :] for i in range(len(code)) for b in "NACGT" if b != code[i]]


def test_curation_drops_shared_variants(spark):
    codes = ["AAAA", "AAAT", "CCCC", "CCCC", "GTGT"]
    wl = whitelist(spark, codes)
    every = [(v, c) for c in codes for v in brute_variants(c)]
    safe = {(v, c) for v, c in every if sum(x == v for x, _ in every) == 1}
    got = {(r.variant, r.barcode) for r in barcodes.curate_corrections(wl).collect()}
    assert got == safe
    listed = barcodes.correction_list(wl).orderBy("row_no").collect()
    assert [r.barcode for r in listed] == codes
    for r in listed:
        assert r.variants == [v for v in brute_variants(r.barcode) if (v, r.barcode) in safe]
    assert listed[2].variants == [] and listed[3].variants == []
    stats = barcodes.collision_stats(wl).first()
    assert stats.total_barcodes == 5 and stats.barcodes_without_corrections == 2
    assert stats.total_safe_variants == len(safe)
    shared = {v for v, _ in every} - {v for v, _ in safe}
    assert stats.total_variants_removed == len(shared)
    origins = barcodes.collisions(wl).collect()
    assert sorted((r.variant, r.origin) for r in origins) == sorted((v, c) for v, c in every if v in shared)


def reads(spark, r2):
    rows = [("S", f"@r{i} x", "ACGT" * 10, "I" * 40, s, "I" * len(s)) for i, s in enumerate(r2)]
    return spark.createDataFrame(rows, "sample string, header string, r1_seq string, r1_qual string, r2_seq string, r2_qual string")


def test_exact_match_beats_correction(spark):
    a, b = "ACGTACGTACGTA", "ACGTACGTACGTC"
    wl = whitelist(spark, [a, b])
    # an uncurated list that claims b as a variant of a
    corrections = spark.createDataFrame([(a, b, 0), (a, "NCGTACGTACGTA", 0), (b, "NCGTACGTACGTA", 1)], "barcode string, variant string, row_no long")
    lookup = barcodes.barcode_lookup(wl, barcodes.last_correction(corrections))
    data = reads(spark, [a, b, "NCGTACGTACGTA", "T" * 13, "ACGT"])
    got = [(r.barcode, r.barcode_status) for r in barcodes.match_barcodes(data, lookup).orderBy("header").collect()]
    assert got == [(a, "direct"), (b, "direct"), (b, "corrected"), (None, "failed"), (None, "too_short")]
    large = barcodes.match_barcodes(data, lookup, max_bytes=0).orderBy("header")
    assert [(r.barcode, r.barcode_status) for r in large.collect()] == got
    stats = barcodes.barcode_stats(data, lookup).first()
    assert (stats.total, stats.passed, stats.failed, stats.direct_match, stats.corrected) == (5, 3, 2, 2, 1)


def test_salted_lookup_equals_broadcast(spark):
    big = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(600)], "k string, v long")
    small = spark.createDataFrame([("hot", "H"), ("k3", "T"), ("zz", "Z")], "k string, w string")
    for how in ("left", "inner", "left_semi", "left_anti"):
        a = scale.lookup_join(big, small, ["k"], how)
        b = scale.lookup_join(big, small, ["k"], how, max_bytes=0, salts=5)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), how
        assert a.columns == b.columns
    plan = scale.lookup_join(big, small, ["k"], "left", max_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "strategy=broadcast" not in plan


def test_numbering_splits_groups(spark):
    rows = [("hot", i * 37 % 1009) for i in range(1009)] + [("b", 5), ("b", 2)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = scale.number_rows(df, ["g"], [df["v"]], "n").collect()
    assert sorted((r.g, r.v, r.n) for r in got) == sorted([("hot", v, v + 1) for v in range(1009)] + [("b", 2, 1), ("b", 5, 2)])


def test_cascade_conserves_reads(spark):
    code = "ACGTACGTACGTA"
    seqs = ["ACGTTGCA" + s for s in ["ACGTG", "ACGT", "ACGT" + "G" * 12, "ACGTCACGTC" + "T" * 10, "ACGTCNNNNNNAC", "ACGTCNNNNNAC",
                                    "ACGTCGC" + "A" * 15 + "CGT", "ACG" + "A" * 13 + "CGTTGCA", "ACGTC" + "A" * 14 + "T"]]
    quals = ["I" * len(s) for s in seqs]
    rows = [("S", f"@r{i}", s, q, code, "I" * 13) for i, (s, q) in enumerate(zip(seqs, quals))]
    rows.append(("S", "@low", "A" * 4 + "CGTACGTACGTT", "#" * 16, code, "I" * 13))
    rows.append(("S", "@bad", "ACGT" * 10, "I" * 40, "T" * 13, "I" * 13))
    rows.append(("T", "@bad", "ACGT" * 10, "I" * 40, "T" * 5, "I" * 5))
    data = spark.createDataFrame(rows, "sample string, header string, r1_seq string, r1_qual string, r2_seq string, r2_qual string")
    lookup = barcodes.barcode_lookup(whitelist(spark, [code]), barcodes.curate_corrections(whitelist(spark, [code])))
    qc = reads_qc.qc_reads(barcodes.match_barcodes(data, lookup))
    got = {r.header: (r.lost_at, r.out_seq) for r in qc.filter("sample = 'S'").collect()}
    assert got["@r0"] == (None, "ACGTG")
    assert got["@r1"] == ("sss", None)
    assert got["@r2"] == ("polyx", None)
    assert got["@r3"] == (None, "ACGTCACGTC")
    assert got["@r4"] == ("n", None)
    assert got["@r5"][0] is None
    assert got["@r6"] == (None, "ACGTCGC")
    assert got["@r7"] == ("polya", None)
    assert got["@r8"] == (None, "ACGTC" + "A" * 14 + "T")
    assert got["@low"] == ("quality", None)
    assert got["@bad"] == ("barcode", None)
    strict = reads_qc.qc_reads(barcodes.match_barcodes(data, lookup), ReadQcConfig(polya_strict_length=True))
    assert strict.filter("header = '@r0'").first().lost_at == "polya"
    for c in reads_qc.qc_cascade(qc).collect():
        kept = c.raw_reads
        for lost, left in [
            (c.barcode_failed, c.post_barcode_reads_retained), (c.too_short_after_sss, c.post_sss_trim_reads_retained),
            (c.polyx_too_short_after_trim, c.post_polyx_trim_reads_retained), (c.low_quality_reads, c.post_quality_filter_reads_retained),
            (c.too_many_n_reads, c.post_n_filter_reads_retained), (c.polya_too_short_after_trim, c.post_polya_trim_reads_retained),
        ]:
            assert left == kept - lost
            kept = left
        assert kept == c.reads_output
    empty = reads_qc.qc_cascade(qc).filter("sample = 'T'").first()
    assert empty.reads_output == 0 and empty.mean_read_length_post_QC == 0 and empty.median_read_length_post_QC == 0


def _matched_rows(spark):
    good, bases = "I" * 40, "ACGTTGCAACGTGATCCATGCAGTTACGATCAGGCTAACT"
    rows = [
        ("S", "@a 1", bases, good, "ACGTACGTACGTA", good[:13], "ACGTACGTACGTA", "direct"),
        ("S", "@b 1", bases, good, "NNNNACGTACGTA", good[:13], None, "failed"),
        ("S", "@c 1", bases, "#" * 40, "ACGTACGTACGTA", good[:13], "ACGTACGTACGTA", "direct"),
        ("S", "@d 1", bases[:10], good[:10], "ACGTACGTACGTA", good[:13], "ACGTACGTACGTA", "direct"),
        ("S", "@e 1", bases[:20] + "A" * 18 + "CG", good, "ACGTACGTACGTA", good[:13], "ACGTACGTACGTA", "direct"),
        ("S", "@f 1", None, None, "ACGTACGTACGTA", good[:13], "ACGTACGTACGTA", "direct"),
    ]
    return spark.createDataFrame(
        rows, "sample string, header string, r1_seq string, r1_qual string, r2_seq string, r2_qual string, barcode string, barcode_status string"
    )


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filters_on_the_outcome_work_it_out_once(spark):
    qc = reads_qc.qc_reads(_matched_rows(spark))
    lost = {r.header[1]: (r.lost_at, r.out_seq, r.polya_trimmed) for r in qc.collect()}
    assert {k: v[0] for k, v in lost.items()} == {"a": None, "b": "barcode", "c": "quality", "d": "sss", "e": None, "f": None}
    assert lost["e"][1:] == ("ACGTGATCCATG", True)
    for kept in (reads_qc.passed_reads(qc), reads_qc.failed_reads(qc)):
        # the sum of the qualities, the costliest step, stands in the plan once
        assert _optimized(kept).count("split(") == 1
    assert sorted(r.header[1] for r in reads_qc.failed_reads(qc).collect()) == ["b", "c", "d"]


def test_both_mates_of_rejected_reads_come_from_one_pass(spark):
    failed = reads_qc.failed_reads(reads_qc.qc_reads(_matched_rows(spark)))
    lines = writers.rejected_fastq_lines(failed)
    assert _optimized(lines).count("split(") == 1
    rows = {(r.mate, r.value.split("\n")[0]): r.value.split("\n")[1:] for r in lines.collect()}
    assert len(rows) == 6 and lines.columns == ["sample", "value", "mate"]
    assert rows["r2", "@b 1"] == ["NNNNACGTACGTA", "+", "I" * 13]
    assert rows["r1", "@d 1"] == ["ACGTTGCAAC", "+", "I" * 10]
