"""Time the headline queries and print one JSON line.

The test tables are first turned into sequencing inputs (reads, alignments, annotation) and written
as Parquet; that step is reported as ``stage_inputs`` and is not part of the total. Each query then
runs from those inputs to its full result.
"""

from __future__ import annotations

import glob
import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from cellspark import registry
from cellspark.session import build_session
from cellspark.sources import fastq

HEADLINE = [
    "match_barcodes",
    "qc_cascade",
    "read_summary",
    "quality_curve",
    "gene_models",
    "assign_transcripts",
    "annotated_alignments",
    "dedup_stats",
    "count_matrix",
    "cells_single",
    "cells_mixed",
    "cell_metrics_single",
    "read_distribution",
    "unique_gene_names",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def fastq_sheet(spark, reads):
    """The staged reads as plain FASTQ files, one lane per part file, and their sample sheet."""
    root = tempfile.mkdtemp(prefix="bench-fastq-")
    for mate in ("r1", "r2"):
        lines = reads.select(F.concat_ws("\n", "header", f"{mate}_seq", F.lit("+"), f"{mate}_qual"))
        lines.write.text(f"{root}/{mate}")
    parts = [sorted(glob.glob(f"{root}/{mate}/part-*")) for mate in ("r1", "r2")]
    rows = [("S", i + 1, r1, r2) for i, (r1, r2) in enumerate(zip(*parts))]
    return spark.createDataFrame(rows, "sample string, lane int, fastq_1 string, fastq_2 string")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "cellspark-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    started = time.time()
    for mixed, copies in ((False, False), (True, False), (False, True)):
        registry._alignments(spark, sf_dir, mixed, copies)
        registry._gtf(spark, sf_dir, mixed)
    registry._reads(spark, sf_dir)
    registry._whitelist(spark, sf_dir)
    sheet = fastq_sheet(spark, registry._reads(spark, sf_dir))
    staging = time.time() - started
    started = time.time()
    run(fastq.read_fastq_pairs(spark, sheet))
    timings = {"fastq_pairs": round(time.time() - started, 3)}
    for name in HEADLINE:
        started = time.time()
        run(registry.QUERIES[name](spark, sf_dir))
        timings[name] = round(time.time() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "stage_inputs": round(staging, 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
