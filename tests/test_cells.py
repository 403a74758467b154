import math
import random
import statistics
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellspark.config import GENOMES, CellConfig, EngineConfig
from cellspark.operators import cells, matrix, metrics, report
from cellspark.plans import pipeline, scale
from cellspark.sources import writers


def totals(spark, groups):
    rows = [(s, f"B{i}", int(c)) for s, counts in groups.items() for i, c in enumerate(counts)]
    return spark.createDataFrame(rows, "sample string, barcode string, total_counts long")


def reference_curve(counts):
    x = np.log10(np.array(counts) + 1)
    h = len(x) ** -0.2 * x.std(ddof=1)
    grid = np.linspace(x.min(), x.max(), 200)
    return grid, np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))


def reference_threshold(counts, manual, minimum):
    if len(set(counts)) <= 1:
        return int(minimum)
    grid, d = reference_curve(counts)
    floor = np.log10(minimum + 1)
    lows = [grid[i] for i in range(1, 199) if d[i] < d[i - 1] and d[i] < d[i + 1] and grid[i] >= floor]
    f = np.diff(d) / np.diff(grid)
    s = np.diff(f) / np.diff(grid[:-1])
    turns = [grid[i + 1] for i in range(1, 198) if s[i - 1] * s[i] < 0 and grid[i + 1] >= floor and abs(f[i]) < 0.2]
    cut = manual if manual else min(lows) if lows else min(turns) if turns else floor
    return round(10**cut - 1)


@pytest.fixture(scope="module")
def shapes():
    rng = np.random.default_rng(4)
    return {
        "bimodal": [*rng.lognormal(1.5, 0.4, 400).astype(int) + 1, *rng.lognormal(7, 0.3, 60).astype(int)],
        "plain": [*rng.lognormal(5, 0.5, 200).astype(int) + 1],
        "shoulder": [*rng.lognormal(5, 0.7, 300).astype(int) + 1, *rng.lognormal(7.2, 0.25, 40).astype(int)],
        "flat": [7, 7, 7],
        "one": [500],
        "two": [1, 5000],
        "small": [1, 2, 3, 2, 1, 4],
    }


def test_density_equals_direct_sum(spark, shapes):
    got = defaultdict(dict)
    for r in cells.density(totals(spark, shapes), ["sample"], "total_counts").collect():
        got[r["sample"]][r.i] = (r.x, r.d)
    assert set(got) == set(shapes) - {"flat", "one"}
    for s, points in got.items():
        grid, d = reference_curve(shapes[s])
        assert np.allclose([points[i][0] for i in range(200)], grid)
        assert np.allclose([points[i][1] for i in range(200)], d, rtol=1e-6, atol=1e-12)


@pytest.mark.parametrize("minimum", [100.0, 2.0])
def test_thresholds(spark, shapes, minimum):
    manual = {"plain": 2.4, "bimodal": 0.0}
    given = spark.createDataFrame([(s, manual.get(s)) for s in shapes], "sample string, manual_threshold double")
    cfg = CellConfig(minimum_count_threshold=minimum)
    got = {r["sample"]: r.threshold for r in cells.thresholds_single(totals(spark, shapes), given, cfg).collect()}
    assert got == {s: reference_threshold(c, manual.get(s), minimum) for s, c in shapes.items()}


def test_mixed_flags_cover_all_boundaries(spark):
    rows = [("S", f"{h}_{m}", h + m, h, m) for h in (9, 10, 11) for m in (19, 20, 21)]
    data = spark.createDataFrame(rows, "sample string, barcode string, total_counts long, hsap_counts long, mmus_counts long")
    limits = spark.createDataFrame([("S", 10, 20)], "sample string, hsap_threshold long, mmus_threshold long")
    for r in cells.barcode_type(cells.flag_cells_mixed(data, limits)).collect():
        h, m = r.hsap_counts, r.mmus_counts
        single = (h >= 10 and m <= 20) or (h <= 10 and m >= 20)
        assert r.is_called_cell == (h >= 10 or m >= 20)
        assert r.is_single_cell == single
        assert r.is_hsap_cell + r.is_mmus_cell == single
        assert (r.barcode_type == "single-cell") == single


def test_mixed_thresholds_default_together(spark):
    rows = [("S", f"h{i}", i * 50 + 100, i * 50 + 100, 0) for i in range(10)] + [("S", "m", 5, 0, 5)]
    data = spark.createDataFrame(rows, "sample string, barcode string, total_counts long, hsap_counts long, mmus_counts long")
    r = cells.thresholds_mixed(data).first()
    assert (r.hsap_threshold, r.mmus_threshold) == (100, 100)


GENES = [("g1", "A", "1", 1), ("g2", "A", "MT", 2), ("g3", "A", "2", 3), ("g4", "A-1", "2", 4), ("g5", "B", "MT", 5), ("g6", "A-3", "2", 6)]


def test_gene_order_and_unique_names(spark):
    features = spark.createDataFrame(GENES, "gene_id string, gene_name string, chromosome string, row_no long")
    counts = spark.createDataFrame([("S", "X", "g5", 2), ("S", "X", "g3", 1), ("T", "Y", "g1", 1)], "sample string, barcode string, gene_id string, n long")
    indexed = matrix.index_genes(counts, features)
    order = {s: [r.gene_id for r in indexed.filter(F.col("sample") == s).orderBy("gene_index").collect()] for s in "ST"}
    assert order == {"S": ["g3", "g5", "g1", "g2", "g4", "g6"], "T": ["g1", "g2", "g3", "g4", "g5", "g6"]}
    named = {(r["sample"], r.gene_id): r.unique_name for r in matrix.unique_gene_names(indexed).collect()}
    for s, ids in order.items():
        raw = [{g[0]: g[1] for g in GENES}[i] for i in ids]
        seen, used, counter, want = set(), set(raw), Counter(), []
        for n in raw:
            if n not in seen:
                seen.add(n)
                want.append(n)
                continue
            while True:
                counter[n] += 1
                if f"{n}-{counter[n]}" not in used:
                    break
            used.add(f"{n}-{counter[n]}")
            want.append(f"{n}-{counter[n]}")
        assert [named[s, i] for i in ids] == want
    zero = matrix.zero_genes(counts, features).filter("sample = 'S'")
    assert sorted(r.gene_id for r in zero.collect()) == ["g1", "g2", "g4", "g6"]


def test_matrix_market_files(spark, tmp_path):
    features = spark.createDataFrame(GENES, "gene_id string, gene_name string, chromosome string, row_no long")
    rng = random.Random(1)
    rows = [("S", f"B{b:02d}", g[0], rng.randint(1, 9)) for b in range(20) for g in GENES if rng.random() < 0.4]
    counts = spark.createDataFrame(rows, "sample string, barcode string, gene_id string, n long")
    genes, barcodes = matrix.index_genes(counts, features), matrix.index_barcodes(matrix.cell_totals(counts))
    writers.write_matrix(matrix.matrix_entries(counts, genes, barcodes), genes, barcodes, str(tmp_path))

    def lines(name):
        import gzip
        return [x for p in sorted(tmp_path.glob(f"{name}/sample=S/*.gz")) for x in gzip.open(p, "rt").read().splitlines()]

    body, codes, names = lines("matrix.mtx"), lines("barcodes.tsv"), lines("features.tsv")
    assert body[:2] == ["%%MatrixMarket matrix coordinate integer general", "%"]
    assert body[2] == f"{len(GENES)} {len(codes)} {len(rows)}"
    back = set()
    for line in body[3:]:
        g, c, n = map(int, line.split())
        back.add((codes[c - 1], names[g - 1].split("\t")[0], n))
    assert back == {(f"S_{b}", g, n) for _, b, g, n in rows}
    assert names[0].split("\t")[2] == "Gene Expression"


def test_cell_metrics_equal_dense_frames(spark):
    rng = random.Random(8)
    genes = [(f"g{i}", ("GRCh38_" if i % 2 else "GRCm39_") + f"n{i}", ("GRCh38_MT" if i % 2 else "GRCm39_MT") if i % 5 == 0 else "1", i) for i in range(30)]
    rows = [(s, f"B{b}", g[0], rng.randint(1, 5)) for s in "ST" for b in range(12) for g in genes if rng.random() < (0.5 if (b % 2) == (g[3] % 2) else 0.05)]
    rows = [r for r in rows if not (r[0] == "T" and int(r[1][1:]) % 2 == 0)]  # T has no mouse cells
    counts = spark.createDataFrame(rows, "sample string, barcode string, gene_id string, n long")
    flagged_genes = matrix.annotate_genes(
        spark.createDataFrame(genes, "gene_id string, gene_name string, chromosome string, row_no long"), GENOMES["mouse_human_mix"]
    )
    limits = spark.createDataFrame([(s, 9, 9) for s in "ST"], "sample string, hsap_threshold long, mmus_threshold long")
    called = cells.flag_cells_mixed(matrix.cell_totals(counts, flagged_genes), limits)
    raw = spark.createDataFrame([("S", 1000), ("T", 500), ("U", 0)], "sample string, raw_reads long")
    got = {(r["sample"], r.label): r for r in metrics.cell_metrics_mixed(counts, called, flagged_genes, raw).collect()}
    single = {(r["sample"], r.label): r for r in metrics.cell_metrics_single(counts, called, flagged_genes, raw).withColumn("label", F.lit("x")).collect()}
    assert got["U", "total"].num_cells == 0 and single["U", "x"].mean_genes_detected_per_cell == 0
    flags = {(r["sample"], r.barcode): r for r in called.collect()}
    mito = {g[0]: g[2].endswith("MT") for g in genes}
    human = {g[0]: g[1].startswith("GRCh38_") for g in genes}
    for s in "ST":
        frame = pd.DataFrame([r for r in rows if r[0] == s and flags[s, r[1]].is_single_cell], columns=["s", "b", "g", "n"])
        dense = frame.pivot_table(index="b", columns="g", values="n", fill_value=0)
        plain = single[s, "x"]
        assert plain.num_cells == len(dense) and plain.median_total_reads_per_cell == int(np.median(dense.sum(axis=1)))
        m = dense[[g for g in dense if mito[g]]]
        assert plain.mean_mito_genes_detected_per_cell == pytest.approx(np.mean((m > 0).sum(axis=1)))
        assert plain.percentage_counts_from_mito == pytest.approx(100 * m.values.sum() / dense.values.sum())
        assert plain.num_unique_genes_detected_across_sample == (dense.sum() > 0).sum()
        pooled = []
        for label, wanted in (("Hsap", True), ("Mmus", False)):
            mine = dense.loc[[b for b in dense.index if flags[s, b].is_hsap_cell == wanted], [g for g in dense if human[g] == wanted]]
            r = got[s, label]
            assert r.num_cells == len(mine)
            if len(mine):
                own_mito = mine[[g for g in mine if mito[g]]]
                assert r.median_genes_detected_per_cell == int(np.median((mine > 0).sum(axis=1)))
                assert r.median_mito_genes_detected_per_cell == int(np.median((own_mito > 0).sum(axis=1)))
                assert r.mean_total_counts_per_cell == pytest.approx(mine.sum(axis=1).mean())
                assert r.num_unique_genes_detected_across_sample == (mine.sum() > 0).sum()
                assert r.raw_reads_per_cell == pytest.approx({"S": 1000, "T": 500}[s] / len(mine))
                pooled += list(mine.sum(axis=1))
            else:
                assert r.mean_total_counts_per_cell == 0 and r.num_unique_genes_detected_across_sample == 0
        all_cells = got[s, "total"]
        assert all_cells.median_total_reads_per_cell == int(statistics.median(pooled))
        assert all_cells.total_genes_detected_across_sample == (dense > 0).values.sum()


def test_categories_and_counts_add_up(spark):
    data = spark.createDataFrame(
        [("S", "a_ACGTACGTACGTA_", 0), ("S", "a_ACGTACGTACGTA_", 256), ("S", "b_TTTTACGTACGTA_", 16), ("S", "c", 0), ("S", "d_ACGTACGTACGTA_", 2048)],
        "sample string, read_name string, flag int",
    )
    flagged = spark.createDataFrame([("S", "ACGTACGTACGTA", 9, True), ("S", "TTTTACGTACGTA", 4, False)], "sample string, barcode string, total_counts long, is_single_cell boolean")
    raw = spark.createDataFrame([("S", 10), ("Z", 3)], "sample string, raw_reads long")
    got = {r["sample"]: (r.reads_in_cells, r.reads_out_of_cells, r.unusable_reads) for r in metrics.categorize_reads(data, flagged, raw).collect()}
    assert got == {"S": (1, 1, 8), "Z": (0, 0, 3)}
    r = metrics.counts_in_out_cells(flagged).first()
    assert (r.counts_in_cells, r.counts_out_of_cells) == (9, 4)


def test_box_and_ranges(spark):
    values = [0.9, 0.5, 0.7, 0.95, 0.1]
    data = spark.createDataFrame([(f"s{i}", 0, "Input", int(v * 100), v) for i, v in enumerate(values)], "sample string, ord int, step string, reads long, proportion double")
    box = report.cascade_box_stats(data).filter("view = 'proportional'").first()
    ordered = sorted(values)

    def at(q):
        p = q * 5 - 0.5
        return ordered[int(p)] + (p - int(p)) * (ordered[math.ceil(p)] - ordered[int(p)])

    assert (box.q1, box.median, box.q3) == pytest.approx((at(0.25), at(0.5), at(0.75)))
    assert box.sd == pytest.approx(statistics.pstdev(values))
    assert (box.lower_fence, box.upper_fence) == pytest.approx((0.1, 0.95))
    rows = spark.createDataFrame([("a", "num_cells", 5.0), ("b", "num_cells", 9.0), ("c", "reads_pre_qc", 3.0)], "sample string, variable_name string, value double")
    got = {r.variable_name: (r.y_min, r.y_max) for r in report.axis_ranges(rows).collect()}
    sd = statistics.stdev([5, 9])
    assert got["num_cells"] == pytest.approx((max(0, 5 - 2 * sd), 9 + 2 * sd))
    assert got["reads_pre_qc"] == (None, None)
    assert {r.variable_name: r.n for r in report.metric_n(rows).collect()} == {"num_cells": 2, "reads_pre_qc": 1}


def test_row_numbers_need_no_window_over_rows(spark):
    """Rows are numbered as the sorted ranges are written, not shuffled and sorted again."""
    rng = random.Random(3)
    rows = [(rng.choice("aab"), rng.randint(0, 40)) for _ in range(500)] + [("hot", i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(7)
    numbered = scale.number_rows(df, ["g"], [F.col("v")], "n")
    assert "Window" not in numbered._jdf.queryExecution().optimizedPlan().toString()
    found = defaultdict(list)
    for r in numbered.collect():
        found[r["g"]].append((r["n"], r["v"]))
    for g, given in found.items():
        assert [n for n, _ in sorted(given)] == list(range(1, len(given) + 1))
        assert [v for _, v in sorted(given)] == sorted(v for h, v in rows if h == g)
    assert sum(map(len, found.values())) == len(rows)


def test_matrix_entries_broadcast_few_barcodes(spark):
    """The entries are not shuffled to meet a short list of barcodes."""
    counts = spark.createDataFrame([("S", "B1", "g1", 3), ("S", "B2", "g2", 4)], "sample string, barcode string, gene_id string, n long")
    genes = spark.createDataFrame([("S", "g1", 2), ("S", "g2", 1)], "sample string, gene_id string, gene_index long")
    cols = spark.createDataFrame([("S", "B1", 1), ("S", "B2", 2)], "sample string, barcode string, barcode_index long")
    found = matrix.matrix_entries(counts, genes, cols)
    assert "strategy=broadcast" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [("S", 1, 2, 4), ("S", 2, 1, 3)]


def test_totals_are_worked_out_once(spark):
    """Thresholds, curves and flags read the totals from a table."""
    annotation_line = ("1", "t", "transcript", 100, 900, ".", "+", ".", 'gene_id "G1"; gene_name "GRCh38_A"; transcript_id "T1";', 1)
    lines = spark.createDataFrame(
        [annotation_line],
        "seqname string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string, row_no long",
    )
    rows = [("S", f"r{i}_ACGT_", 0, "1", 100 + i, 255, "40M", 1, 1, 0, "G1") for i in range(5)]
    annotated = spark.createDataFrame(
        rows, "sample string, read_name string, flag int, chrom string, pos long, mapq int, cigar string, nh int, hi int, nm int, xt string"
    )
    cfg = EngineConfig(genome=GENOMES["mouse_human_mix"])
    tables = pipeline.matrix_stage(annotated, lines, spark.createDataFrame([("ACGT", 1)], "barcode string, row_no long"), cfg)
    assert "Aggregate" not in tables.totals._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["total_counts"], r["hsap_counts"], r["n_genes"]) for r in tables.totals.collect()] == [(5, 5, 1)]
