import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellspark.functions import alignments as al
from cellspark.functions import names
from cellspark.functions import sequences as sq
from cellspark.functions.formatting import abbreviate, fixed, format_value, plain, round_exact


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_barcode_needs_thirteen_bases(spark):
    got = column(spark, ["ACGTACGTACGT", "ACGTACGTACGTA", "ACGTACGTACGTAGGGGGGG", "ACGTACGTACGTA \r\n"], names.barcode_from_r2)
    assert got == [None, "ACGTACGTACGTA", "ACGTACGTACGTA", "ACGTACGTACGTA"]


def test_header_tag(spark):
    got = column(spark, ["@a b c", "@a", "@a b\n"], lambda c: names.tagged_header(c, F.lit("AC")))
    assert got == ["@a_AC_ b c", "@a_AC_", "@a_AC_ b"]


def test_two_barcode_rules_differ(spark):
    values = ["x_ACGTACGTACGTA_", "x_ACGTA_", "x_acgt_", "a_ACGTACGTACGTA_b"]
    assert column(spark, values, names.barcode_for_counting) == ["ACGTACGTACGTA", "ACGTA", "", ""]
    assert column(spark, values, names.barcode_for_categorizing) == ["ACGTACGTACGTA", None, None, "ACGTACGTACGTA"]


def test_gene_tags_and_names(spark):
    assert column(spark, ["ENSG1.5", "HLA-A", None], names.gene_from_tag) == ["ENSG1", "HLA", None]
    assert column(spark, ["ENSG1.12", "A.b"], names.strip_version) == ["ENSG1", "A.b"]
    assert column(spark, ["", None, "nan", "x"], lambda c: names.name_or_id(c, F.lit("id"))) == ["id", "id", "id", "x"]
    assert column(spark, ["1;1", "MT"], names.first_seqname) == ["1", "MT"]


def test_polya_rule(spark):
    seqs = ["C" + "A" * 12 + "CG", "C" + "A" * 13 + "CGT", "C" + "A" * 14 + "CGT", "C" + "A" * 14 + "T", "C" + "A" * 15, "A" * 20, "A" * 16 + "CG"]
    assert column(spark, seqs, lambda c: sq.polya_start(c, 15, 13)) == [0, 2, 2, 0, 2, 1, 1]


def test_trimming_matches_regular_expressions(spark):
    rng = random.Random(3)
    seqs = []
    for _ in range(400):
        parts = [rng.choice("ACGTN") * rng.choice([1, 1, 2, 9, 10, 13, 14, 15, 16]) for _ in range(rng.randint(0, 7))]
        seqs.append("".join(parts) + rng.choice(["", "CG"]))
    starts = column(spark, seqs, lambda c: sq.polya_start(c, 15, 13))
    keeps = column(spark, seqs, lambda c: sq.polyx_keep(c, 10))
    for seq, start, keep in zip(seqs, starts, keeps):
        found = re.search("A{15,}|A{13,}CG", seq)
        assert start == (found.start() + 1 if found else 0), seq
        assert keep == len(re.sub("(A{10,}|C{10,}|G{10,}|T{10,})$", "", seq)), seq


def test_quality_filter_boundaries(spark):
    def qual(*values):
        return "".join(chr(33 + v) for v in values)

    reads = [
        qual(*[15] * 10),
        qual(*[14] * 4, *[16] * 6),
        qual(*[14] * 41, *[40] * 59),
        qual(*[0] * 4, *[15] * 6),
        qual(*[0] * 3, *[20] * 7),
        qual(*[14] * 5),
    ]
    want = []
    for r in reads:
        phred = [ord(c) - 33 for c in r]
        want.append(sum(phred) < 15 * len(phred) or sum(q < 15 for q in phred) > 0.4 * len(phred))
    assert column(spark, reads, lambda c: sq.low_quality(c, 15, 40)) == want


def test_quality_filter_random(spark):
    rng = random.Random(5)
    reads = ["".join(chr(33 + rng.choice([rng.randint(0, 40), rng.randint(8, 20)])) for _ in range(rng.randint(5, 60))) for _ in range(400)]
    got = column(spark, reads, lambda c: F.struct(sq.low_quality(c, 15, 40), sq.phred_sum(c), sq.bases_at_least(c, 30)))
    for r, (low, total, high) in zip(reads, got):
        phred = [ord(c) - 33 for c in r]
        assert total == sum(phred)
        assert high == sum(q >= 30 for q in phred)
        assert low == (sum(phred) < 15 * len(phred) or sum(q < 15 for q in phred) > 0.4 * len(phred))


def walk(pos, cigar):
    """Plain walk over a CIGAR string: blocks, last reference base, read length."""
    at, blocks, read = pos, [], 0
    for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
        n = int(n)
        if op in "M=X":
            blocks.append((at, at + n - 1))
        if op in "MDN=X":
            at += n
        if op in "MIS=X":
            read += n
    return blocks, at - 1, read


CIGARS = ["40M", "5S35M", "3H5S35M2S", "20M100N20M", "10M2I10M", "10M3D10M5S", "5=1X30=", "12M1000N5M2D6M4I9M3S2H"]


def test_cigar_functions(spark):
    got = column(
        spark, CIGARS, lambda c: F.struct(al.aligned_blocks(F.lit(101), c), al.reference_end(F.lit(101), c), al.read_length(c))
    )
    for cigar, (blocks, end, length) in zip(CIGARS, got):
        assert ([tuple(b) for b in blocks], end, length) == walk(101, cigar), cigar


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 300), st.sampled_from("MIDN=X")), min_size=1, max_size=6), min_size=5, max_size=40))
def test_cigar_random(spark, shapes):
    cigars = ["".join(f"{n}{op}" for n, op in shape) for shape in shapes]
    got = column(spark, cigars, lambda c: F.struct(al.aligned_blocks(F.lit(7), c), al.reference_end(F.lit(7), c)))
    for cigar, (blocks, end) in zip(cigars, got):
        want, last, _ = walk(7, cigar)
        assert ([tuple(b) for b in blocks], end) == (want, last), cigar


def test_five_prime_uses_clips(spark):
    rows = [(0, 100, "40M"), (0, 100, "5S35M"), (16, 100, "40M"), (16, 100, "35M5S"), (16, 100, "5S30M100N5M"), (0, 50, "2H3S5M")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, flag int, pos long, cigar string")
    got = [r[0] for r in df.orderBy("i").select(al.five_prime(F.col("flag"), F.col("pos"), F.col("cigar"))).collect()]
    assert got == [100, 95, 139, 139, 234, 47]


def test_number_formats(spark):
    assert column(spark, [999.0, 1500.0, 2_340_000.0], abbreviate, "double") == ["999.0", "1.5 k", "2.3 M"]
    assert column(spark, [3.0], lambda c: format_value(c, F.lit(True)), "double") == ["3"]
    assert column(spark, [2.345678], lambda c: format_value(c, F.lit(False)), "double") == ["2.35"]


def test_rounding_goes_by_the_exact_value(spark):
    """Ties of the shortest text are not ties of the double; real ties go to the even digit."""
    values = [0.125, 0.375, 2.675, 1.005, 0.005, 1.115, 2.5, 0.0, -0.0, -0.125, -0.001, 99.995, 1e12 + 0.125, 123456.785, 0.29]
    values += [random.Random(1).uniform(-1000, 1000) for _ in range(300)] + [i * 0.005 for i in range(400)]
    assert column(spark, values, lambda c: fixed(c, 2), "double") == [f"{v:.2f}" for v in values]
    assert column(spark, values, lambda c: round_exact(c, 2), "double") == [round(v, 2) for v in values]
    assert column(spark, values, lambda c: format_value(c, F.lit(False)), "double") == [f"{v:.2f}" for v in values]
    marks = [1250.0, 2250.0, 1350.0, 1_250_000.0, 999.95, 999.94, 0.25, 0.05, 2_350_000.0, 1e15]
    want = [f"{v / 1e6:.1f} M" if v >= 1e6 else f"{v / 1e3:.1f} k" if v >= 1e3 else f"{v:.1f}" for v in marks]
    assert column(spark, marks, abbreviate, "double") == want
    assert want[:2] == ["1.2 k", "2.2 k"]


def test_plain_decimals(spark):
    values = [12345678.5, 0.0001, 3.0, 1e-7, 0.1, 123456789012.25, -25000000.0]
    got = column(spark, values, plain, "double")
    assert not any("E" in g for g in got) and [float(g) for g in got] == values and got[2] == "3.0"


def test_high_bases_are_counted_only_beside_low_ones(spark):
    quals = ["", "I" * 30, "#" * 13 + "I" * 17, "#" * 12 + "0" * 18, "#" * 3 + "0" * 27, "!" * 11 + "0" * 19, "I" * 11 + "!" * 19, None]

    def low(qual):
        scores = [ord(c) - 33 for c in qual]
        return sum(s < 15 for s in scores) * 100 > len(scores) * 40 or sum(scores) < 15 * len(scores)

    rows = spark.createDataFrame([(q,) for q in quals], "q string").select("q", sq.low_quality(F.col("q"), 15, 40).alias("low"))
    assert {r.q: r.low for r in rows.collect()} == {q: None if q is None else low(q) for q in quals}
    # the check for any low base stands before the pattern that finds the high ones
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert "> 0) AND" in plan and plan.index("> 0) AND") < plan.index("\\x3f-\\x7e")
