import dataclasses
import random
from collections import Counter, defaultdict

import pytest

from cellspark.config import AssignConfig
from cellspark.operators import annotation, assign, dedup, intervals
from cellspark.plans.scale import Footprint, lookup_join
from tests.test_functions import walk

# a size no broadcast bound allows: forces the shuffled, salted joins
HUGE = Footprint(10**9, 10**15)

ALN = "sample string, read_name string, flag int, chrom string, pos long, mapq int, cigar string, nh int, hi int, nm int"


def gtf_line(i, feature, chrom, strand, start, end, gene, transcript, name=None):
    attributes = f'gene_id "{gene}"; transcript_id "{transcript}";' + (f' gene_name "{name}";' if name else "")
    return (chrom, "t", feature, start, end, ".", strand, ".", attributes, i)


def gtf(spark, lines):
    rows = [gtf_line(i, *line) for i, line in enumerate(lines)]
    return spark.createDataFrame(
        rows, "seqname string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string, row_no long"
    )


def random_lines(rng, genes=40):
    lines = []
    for g in range(genes):
        chrom, strand = rng.choice("12"), rng.choice("+-")
        for t in range(rng.randint(1, 3)):
            start = rng.randint(1, 3000)
            end = start + rng.randint(50, 900)
            lines.append(("transcript", chrom, strand, start, end, f"G{g}", f"T{g}_{t}"))
            at = start
            while at < end:
                stop = min(end, at + rng.randint(20, 120))
                lines.append(("exon", chrom, strand, at, stop, f"G{g}", f"T{g}_{t}"))
                at = stop + rng.randint(10, 150)
    return lines


def brute(lines, level, flag, chrom, pos, cigar):
    blocks, _, length = walk(pos, cigar)
    strand = "-" if flag & 16 else "+"
    bases = defaultdict(set)
    for feature, c, s, lo, hi, gene, _ in lines:
        if feature == level and c == chrom and s == strand:
            for a, b in blocks:
                bases[gene] |= set(range(max(a, lo), min(b, hi) + 1))
    hits = [g for g, x in bases.items() if len(x) * 2 >= length and x]
    status = "Unassigned_NoFeatures" if not hits else "Assigned" if len(hits) == 1 else "Unassigned_Ambiguity"
    return status, hits[0] if len(hits) == 1 else None


def random_alignments(rng, n):
    rows = []
    for i in range(n):
        nh = rng.choice([1, 1, 1, 2, 3])
        for hi in range(1, nh + 1):
            cigar = rng.choice(["40M", "5S35M", "20M100N20M", "18M2I20M", "15M300N10M700N15M", "40M", "40M"])
            rows.append(("S", f"r{i}_ACGTACGTACGTA_", rng.choice([0, 16]) + (256 if hi > 1 else 0), rng.choice("12"),
                         rng.randint(1, 3800), 255 if nh == 1 else 3, cigar, nh, hi, rng.randint(0, 5)))
    return rows


def test_assignment_equals_brute_force_on_every_path(spark):
    rng = random.Random(11)
    lines, rows = random_lines(rng), random_alignments(rng, 250)
    data = spark.createDataFrame(rows, ALN)
    annotated = gtf(spark, lines)
    want = {
        (r[1], r[8]): (brute(lines, "transcript", r[2], r[3], r[4], r[6]), brute(lines, "exon", r[2], r[3], r[4], r[6]))
        for r in rows
    }
    for cfg in (AssignConfig(bin_size=256, bin_reach=64), AssignConfig(bin_size=256, max_pieces_per_bin=0), AssignConfig(bin_size=1024, bin_reach=30)):
        index = assign.feature_index(annotated, cfg)
        assert (index.dense is not None) == (cfg.max_pieces_per_bin == 0)
        if cfg.bin_size == 1024:
            index = dataclasses.replace(index, size=HUGE, windows_size=HUGE)
        got = {
            (r.read_name, r.hi): ((r.tx_status, r.tx_gene), (r.ex_status, r.ex_gene))
            for r in assign.assign_levels(data, index, cfg).collect()
        }
        assert got == want, cfg


@pytest.mark.parametrize("bin_size", [128, 512, 4096])
@pytest.mark.parametrize("limit", [0, 1, 6, 256])
def test_equal_rows_and_long_reads_at_every_bin_width(spark, bin_size, limit):
    """Equal alignments keep a row and a status each, whatever bins, reach and limits are."""
    rng = random.Random(3)
    lines, rows = random_lines(rng, 25), random_alignments(rng, 60)
    rows += [("S", "long", 0, "1", p, 255, c, 1, 1, 0) for p in (1, 700, 2200) for c in ("500M", "300M5D400M")]
    rows += [("S", "star", 4, "*", 0, 0, "*", 0, 0, 0), ("S", "star", 4, None, None, 0, None, 0, 0, 0)]
    rows += [("S", "half", 0, "1", 5000, 255, c, 1, 1, 0) for c in ("40M", "15M20N10M")]
    rows = rows * 2 + rows[:20]
    lines.append(("transcript", "1", "+", 5030, 5100, "H", "TH"))
    want = Counter()
    for r in rows:
        if r[6] is None or "M" not in r[6]:
            want[(r[1], r[4], r[6], ("Unassigned_Unmapped", None), ("Unassigned_Unmapped", None))] += 1
            continue
        both = (brute(lines, level, r[2], r[3], r[4], r[6]) for level in ("transcript", "exon"))
        want[(r[1], r[4], r[6], *both)] += 1
    cfg = AssignConfig(bin_size=bin_size, max_pieces_per_bin=limit)
    index = assign.feature_index(gtf(spark, lines), cfg)
    for size in (index.size, HUGE):
        sized = dataclasses.replace(index, size=size, windows_size=size)
        found = assign.assign_levels(spark.createDataFrame(rows, ALN), sized, cfg).collect()
        got = Counter((r.read_name, r.pos, r.cigar, (r.tx_status, r.tx_gene), (r.ex_status, r.ex_gene)) for r in found)
        assert got == want


def test_lookup_joins_refuse_what_salting_would_repeat(spark):
    one = spark.createDataFrame([(1, 2)], "k int, v int")
    for how in ("right", "full", "outer", "cross"):
        with pytest.raises(ValueError):
            lookup_join(one, one.withColumnRenamed("v", "w"), ["k"], how)
    many = spark.createDataFrame([(i % 3, i) for i in range(50)], "k int, v int")
    side = spark.createDataFrame([(0, "a"), (7, "b")], "k int, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        small = sorted(map(str, lookup_join(many, side, ["k"], how).collect()))
        assert small == sorted(map(str, lookup_join(many, side, ["k"], how, size=HUGE).collect()))


def test_large_lookups_are_neither_repeated_nor_broadcast(spark, tmp_path):
    many = spark.createDataFrame([(i % 3 if i % 5 else None, i) for i in range(50)], "k int, v int")
    spark.createDataFrame([(0, "a"), (0, "b"), (2, "c")], "k int, w string").write.parquet(f"{tmp_path}/side")
    side = spark.read.parquet(f"{tmp_path}/side")  # small as a file, whatever was measured
    for how in ("inner", "left"):
        joined = lookup_join(many, side, ["k"], how, size=HUGE)
        plan = joined._jdf.queryExecution().toString()
        assert "_salt" not in plan and "BroadcastHashJoin" not in plan and "explode" not in plan
        assert sorted(map(str, joined.collect())) == sorted(map(str, lookup_join(many, side, ["k"], how).collect()))
    middle = lookup_join(many, side, ["k"], "left", size=Footprint(1, 200 << 20))._jdf.queryExecution().toString()
    assert "_salt" in middle and "BroadcastHashJoin" not in middle


def test_overlap_share_boundary(spark):
    lines = [("transcript", "1", "+", 1000, 1999, "G", "T"), ("exon", "1", "+", 1000, 1999, "G", "T")]
    rows = [("S", f"n{o}", 0, "1", 1000 - (40 - o), 255, "40M", 1, 1, 0) for o in (19, 20, 21)]
    rows.append(("S", "rev", 16, "1", 1100, 255, "40M", 1, 1, 0))
    index = assign.feature_index(gtf(spark, lines))
    got = {r.read_name: r.xs for r in assign.assign_features(spark.createDataFrame(rows, ALN), index).collect()}
    assert got == {"n19": "Unassigned_NoFeatures", "n20": "Assigned", "n21": "Assigned", "rev": "Unassigned_NoFeatures"}
    loose = AssignConfig(stranded=False)
    got = assign.assign_features(spark.createDataFrame(rows, ALN), assign.feature_index(gtf(spark, lines), loose), cfg=loose)
    assert got.filter("read_name = 'rev'").first().xs == "Assigned"


def staged_annotation(data, index, cfg):
    """The same annotation as separate passes."""
    first = assign.assign_features(data, index, "transcript", cfg)
    unique = assign.filter_umr(first)
    tie = assign.assign_features(assign.filter_ambiguous(unique), index, "exon", cfg)
    resolved, open_rows = assign.resolve_multimappers(assign.filter_multimapped(first))
    second, _ = assign.resolve_multimappers(assign.assign_features(open_rows, index, "exon", cfg))
    parts = [assign.filter_assigned(unique), assign.filter_assigned(tie), resolved, second]
    return sorted((r.read_name, r.pos, r.nh, r.hi, r.xt) for p in parts for r in p.collect())


def test_fused_annotation_equals_separate_passes(spark):
    rng = random.Random(23)
    cfg = AssignConfig(bin_size=256, bin_reach=64)
    data = spark.createDataFrame(random_alignments(rng, 300), ALN)
    index = assign.feature_index(gtf(spark, random_lines(rng)), cfg)
    fused = sorted((r.read_name, r.pos, r.nh, r.hi, r.xt) for r in assign.annotate(data, index, cfg).collect())
    assert fused == staged_annotation(data, index, cfg)
    assert len({name for name, *_ in fused}) == len(fused)


def test_multimapper_cases(spark):
    rows = [
        ("same", 1, "Assigned", "A"), ("same", 2, "Assigned", "A"), ("same", 3, "Unassigned_NoFeatures", None),
        ("two", 1, "Assigned", "A"), ("two", 2, "Assigned", "B"),
        ("amb", 1, "Assigned", "A"), ("amb", 2, "Unassigned_Ambiguity", None),
        ("none", 1, "Unassigned_NoFeatures", None), ("none", 2, "Unassigned_NoFeatures", None),
    ]
    data = spark.createDataFrame([("S", n, 3, h, s, g) for n, h, s, g in rows], "sample string, read_name string, nh int, hi int, xs string, xt string")
    resolved, left = assign.resolve_multimappers(data)
    assert [(r.read_name, r.nh, r.hi, r.xt) for r in resolved.collect()] == [("same", 1, 1, "A")]
    assert sorted((r.read_name, r.hi) for r in left.collect()) == [("amb", 1), ("amb", 2), ("two", 1), ("two", 2)]


def test_overlap_join_pairs(spark):
    rng = random.Random(5)
    left = [(i, rng.choice("ab"), s, s + rng.randint(0, 500)) for i, s in ((i, rng.randint(1, 3000)) for i in range(80))]
    right = [(i, rng.choice("ab"), s, s + rng.randint(0, 500)) for i, s in ((i, rng.randint(1, 3000)) for i in range(80))]
    a = spark.createDataFrame(left, "l long, k string, start long, end long")
    b = spark.createDataFrame(right, "r long, k string, start long, end long")
    want = sorted((x[0], y[0]) for x in left for y in right if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3])
    for size in (None, HUGE):
        pairs = intervals.overlap_join(a, b, ["k"], 128, size=size)
        assert sorted((r.l, r.r_r) for r in pairs.collect()) == want
        assert pairs.columns == ["l", "k", "start", "end", "r_r", "r_start", "r_end"]


def test_dedup(spark):
    rows = [
        ("S", "a_AC_", 0, "1", 100, 255, "40M", 1, 1, 0, "G1"), ("S", "b_AC_", 0, "1", 105, 255, "5S35M", 1, 1, 0, "G2"),
        ("S", "c_AC_", 16, "1", 61, 3, "40M", 1, 1, 0, "G1"), ("S", "d_AC_", 16, "1", 66, 255, "35M", 1, 1, 0, "G1"),
        ("S", "e_TT_", 0, "1", 100, 255, "40M", 1, 1, 0, "G1"), ("T", "f_AC_", 0, "1", 100, 255, "40M", 1, 1, 0, "G1"),
    ]
    data = spark.createDataFrame(rows, ALN + ", xt string")
    kept = dedup.dedup(data)
    assert sorted(r.read_name for r in kept.collect()) == ["a_AC_", "d_AC_", "e_TT_", "f_AC_"]
    assert sorted(r.read_name for r in dedup.dedup(kept).collect()) == ["a_AC_", "d_AC_", "e_TT_", "f_AC_"]
    one = {r["sample"]: r.asDict() for r in dedup.dedup_stats(data, kept).collect()}
    two = {r["sample"]: r.asDict() for r in dedup.dedup_stats_single_pass(data).collect()}
    assert one == two
    assert one["S"]["sequencing_saturation"] == pytest.approx(40.0)


def test_gene_models(spark):
    lines = [
        ("exon", "1", "-", 300, 400, "A", "TA"), ("exon", "1", "-", 100, 200, "A", "TA"),
        ("start_codon", "1", "-", 380, 382, "A", "TA"), ("stop_codon", "1", "-", 120, 122, "A", "TA"),
        ("exon", "1", "+", 10, 90, "B", "TB"), ("exon", "1", "+", 20, 50, "B", "TB"),
        ("miRNA", "2", "+", 5, 9, "C", "TC"), ("start_codon", "2", "+", 5, 7, "D", "TD"),
    ]
    got = {r.transcript_id: r for r in annotation.gene_models(gtf(spark, lines)).collect()}
    assert set(got) == {"TA", "TB", "TC"}
    a = got["TA"]
    assert (a.start, a.end, a.cds_start, a.cds_end, a.first_exon_start) == (100, 400, 120, 382, 300)
    assert (a.block_sizes, a.block_starts) == ([101, 101], [0, 200])
    assert (got["TB"].start, got["TB"].end, got["TB"].cds_start, got["TB"].cds_end) == (10, 50, 10, 50)


def test_regions_equal_brute_force(spark):
    rng = random.Random(2)
    lines = []
    for g in range(12):
        chrom, strand, at = "1", rng.choice("+-"), rng.randint(3000, 60000)
        exons = []
        for _ in range(rng.randint(1, 4)):
            stop = at + rng.randint(50, 400)
            exons.append((at, stop))
            at = stop + rng.randint(20, 2000)
        lines += [("exon", chrom, strand, a, b, f"G{g}", f"T{g}") for a, b in exons]
        if rng.random() < 0.7:
            c0, c1 = exons[0][0] + 20, exons[-1][1] - 20
            low, high = ("start_codon", "stop_codon") if strand == "+" else ("stop_codon", "start_codon")
            lines += [(low, chrom, strand, c0, c0 + 2, f"G{g}", f"T{g}"), (high, chrom, strand, c1 - 2, c1, f"G{g}", f"T{g}")]
    models = annotation.gene_models(gtf(spark, lines))
    spots = defaultdict(set)
    for m in models.collect():
        exons = [(m.start + o, m.start + o + n - 1) for o, n in zip(m.block_starts, m.block_sizes)]
        five, three = ("5'UTR_Exons", "3'UTR_Exons") if m.strand == "+" else ("3'UTR_Exons", "5'UTR_Exons")
        up, down = ("TSS_up_", "TES_down_") if m.strand == "+" else ("TES_down_", "TSS_up_")
        for a, b in exons:
            for p in range(a, b + 1):
                spots["CDS_Exons" if m.cds_start <= p <= m.cds_end else five if p < m.cds_start else three].add(p)
        for (_, e), (s, _) in zip(exons, exons[1:]):
            spots["Introns"] |= set(range(e + 1, s))
        for k in (1, 5, 10):
            spots[f"{up}{k}kb"] |= set(range(max(1, m.start - 1000 * k), m.start))
            spots[f"{down}{k}kb"] |= set(range(m.end + 1, m.end + 1000 * k + 1))
    cds = spots["CDS_Exons"]
    utr5, utr3 = spots["5'UTR_Exons"] - cds, spots["3'UTR_Exons"] - cds
    intron = spots["Introns"] - cds - utr5 - utr3
    body = cds | utr5 | utr3 | intron
    want = {"CDS_Exons": cds, "5'UTR_Exons": utr5, "3'UTR_Exons": utr3, "Introns": intron}
    want |= {g: spots[g] - body for g in annotation.REGION_GROUPS[4:]}
    for bin_size in (512, 4096):
        got = defaultdict(set)
        for r in annotation.distribution_regions(models, bin_size).collect():
            for g in r.groups:
                span = set(range(r.start, r.end + 1))
                assert not span & got[g]
                got[g] |= span
        assert {g: got[g] for g in want} == want


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_in_row_genes_are_worked_out_once(spark):
    """No filter above repeats the interpreted search through the pieces of a bin."""
    rng = random.Random(5)
    lines = random_lines(rng)
    rows = [("S", f"r{i}_ACGT_", 0, rng.choice("12"), rng.randint(1, 3000), 255, "40M", 1, 1, 0) for i in range(50)]
    index = assign.feature_index(gtf(spark, lines), AssignConfig(bin_size=512))
    found = assign.annotate(spark.createDataFrame(rows, ALN), index, AssignConfig(bin_size=512))
    plan = optimized(found)
    assert not [line for line in plan.splitlines() if "Filter" in line and "tx_genes" in line or "tx_pieces" in line]
    # once for unique and once for multi-mapped alignments
    assert plan.count("filter(tx_genes") == 2
    # the gathered pieces come from a table, not from an aggregate in each use
    assert "collect_list" not in plan


def test_overlap_join_carries_its_bin_once(spark):
    """the shuffled rows have no second copy of the bin."""
    left = spark.createDataFrame([("1", 10, 5000, 7), ("1", 5000, 5000, 8)], "chrom string, start long, end long, n int")
    right = spark.createDataFrame([("1", 4000, 9000, "g"), ("2", 1, 9, "h")], "chrom string, start long, end long, gene string")
    found = intervals.overlap_join(left, right, ["chrom"], 4096, size=HUGE)
    assert "_bin#" not in optimized(found).replace("_k_bin#", "")
    assert sorted((r["n"], r["r_gene"]) for r in found.collect()) == [(7, "g"), (8, "g")]


def test_alignments_within_reach_are_looked_up_in_their_row(spark, monkeypatch):
    rng = random.Random(5)
    lines = random_lines(rng)
    cigars = ["40M", "20M2D20M", "10M3I27M", "8=2X30M", "20M100N20M", "5S10M40N25M3H", "5N40M", "15M700N25M", "*"]
    rows = [("S", f"r{i}", rng.choice([0, 16]), rng.choice("12"), rng.randint(1, 3800), 255, cigars[i % 9], 1, 1, 0) for i in range(270)]
    rows += rows[:45]
    cfg = AssignConfig(bin_size=256, bin_reach=256)
    index = assign.feature_index(gtf(spark, lines), cfg)
    by_rows, long = assign._assign_by_rows, []
    monkeypatch.setattr(assign, "_assign_by_rows", lambda some, *more: long.append(some) or by_rows(some, *more))
    for found in (index, dataclasses.replace(index, size=HUGE, windows_size=HUGE)):
        got = assign.assign_levels(spark.createDataFrame(rows, ALN), found, cfg).collect()
        assert {r.cigar for r in long.pop().collect()} == {"15M700N25M"}
        assert Counter(r.read_name for r in got) == Counter(r[1] for r in rows)
        for r in got:
            if r.cigar == "*":
                assert (r.tx_status, r.tx_gene, r.ex_status, r.ex_gene) == ("Unassigned_Unmapped", None, "Unassigned_Unmapped", None)
            else:
                assert (r.tx_status, r.tx_gene) == brute(lines, "transcript", r.flag, r.chrom, r.pos, r.cigar)
                assert (r.ex_status, r.ex_gene) == brute(lines, "exon", r.flag, r.chrom, r.pos, r.cigar)
