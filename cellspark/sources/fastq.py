"""Paired FASTQ files as a Spark data source.

Plain and block-gzip lanes are read in parallel. The line index of both mate files (``splits``) tells the number of the
first line of every split, so a task knows which records begin in its split of R1, by count and not by the look of the
lines. It reads those and enters R2 at the split that holds the first of them: pairs meet by record number without a
shuffle. A lane with an ordinary gzip file is one streaming task.
"""

from __future__ import annotations

import json
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cellspark.session import ship
from cellspark.sources import splits

SCHEMA = "sample string, lane int, ord long, header string, r1_seq string, r1_qual string, r2_seq string, r2_qual string"
BATCH = 20_000


class LaneSplit(InputPartition):
    """Records ``first`` up to ``last`` (null: to the end) of one lane. Mates are (path, kind, offset, skip, line) or null."""

    def __init__(self, sample: str, lane: int, first: int, last: int | None, r1: list, r2: list | None):
        self.sample, self.lane, self.first, self.last, self.r1, self.r2 = sample, lane, first, last, r1, r2


def _records(mate: list | None, first: int, last: int | None):
    """(headers, sequences, qualities) of up to ``BATCH`` records at a time; a cut-off last record has empty fields."""
    if mate is None:
        return
    path, kind, offset, skip, line = mate
    with splits.lines_from(path, kind, offset, skip) as lines:
        for _ in islice(lines, 4 * first - line):
            pass
        number = first
        while last is None or number < last:
            raw = list(islice(lines, 4 * (BATCH if last is None else min(BATCH, last - number))))
            if not raw:
                return
            text = b"".join(raw).decode("ascii", "replace")
            texts = text.removesuffix("\n").split("\n")
            if "\r" in text:
                texts = [some.rstrip("\r") for some in texts]
            texts += [""] * (-len(texts) % 4)
            yield texts[0::4], texts[1::4], texts[3::4]
            number += len(texts) // 4


class FastqPairReader(DataSourceReader):
    def __init__(self, options):
        self.lanes = [LaneSplit(*lane) for lane in json.loads(options["lanes"])]

    def partitions(self):
        return self.lanes

    def read(self, partition: LaneSplit):
        import pyarrow as pa

        done = partition.first
        mates = _records(partition.r2, partition.first, partition.last)
        for headers, seqs, quals in _records(partition.r1, partition.first, partition.last):
            n = len(headers)
            # both sides take as many records at a time; R2 may end before R1
            _, mate_seqs, mate_quals = (some[:n] + [""] * (n - len(some)) for some in next(mates, ([], [], [])))
            texts = zip(("header", "r1_seq", "r1_qual", "r2_seq", "r2_qual"), (headers, seqs, quals, mate_seqs, mate_quals))
            yield pa.RecordBatch.from_pydict(
                {
                    "sample": pa.array([partition.sample] * n, pa.string()),
                    "lane": pa.array([partition.lane] * n, pa.int32()),
                    "ord": pa.array(range(done, done + n), pa.int64()),
                    **{name: pa.array(column, pa.string()) for name, column in texts},
                }
            )
            done += n


class FastqPairSource(DataSource):
    @classmethod
    def name(cls):
        return "fastq_pairs"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return FastqPairReader(self.options)


def lane_splits(sample: str, lane: int, r1: str, r2: str, files: dict[str, splits.FileLines]) -> list[tuple]:
    """What tasks read of one lane: a ``LaneSplit``'s fields for each split of R1 in which a record begins."""
    left, right = files.get(r1), files.get(r2)
    if any(f is not None and f.lines is None for f in (left, right)):
        whole = [[path, splits.STREAM, 0, 0, 0] for path in (r1, r2)]
        return [(sample, lane, 0, None, *whole)]
    if left is None:  # an empty file
        return []
    records = -(-left.lines // 4)
    starts = sorted({-(-line // 4) for line, _, _ in left.entries} - {records} | {0})
    found = []
    for first, last in zip(starts, [*starts[1:], records]):
        mates = []
        for path, file in ((r1, left), (r2, right)):
            if file is None or 4 * first >= file.lines:
                mates.append(None)  # nothing there
            else:
                line, offset, skip = file.entry(4 * first)
                mates.append([path, file.kind, offset, skip, line])
        found.append((sample, lane, first, last, *mates))
    return found


def read_fastq_pairs(
    spark: SparkSession,
    sheet: DataFrame,
    partitions: int | None = None,
    split_bytes: int = splits.SPLIT_BYTES,
    index: DataFrame | None = None,
    merged: bool = False,
) -> DataFrame:
    """Read pairs of every lane of a sample sheet, mates matched by their place in the file.

    ``ord`` counts a lane's records from 0. ``merged`` counts on over a sample's lanes, in lane order, as if their
    files had been concatenated; lanes that have to be streamed are read once more for that. Missing mates are empty,
    mates beyond R1's end are left out. ``index`` is what ``splits.line_index`` gave for these files before.
    ``partitions`` spreads the rows evenly afterwards. Lanes' names and one entry per task pass through the driver.
    """
    ship(spark)
    spark.dataSource.register(FastqPairSource)
    lanes = sheet.select("sample", "lane", "fastq_1", "fastq_2").collect()
    paths = [path for row in lanes for path in (row["fastq_1"], row["fastq_2"])]
    if not lanes:
        return spark.createDataFrame([], SCHEMA)
    files = splits.file_lines(index if index is not None else splits.line_index(spark, paths, split_bytes))
    parts = [part for row in lanes for part in lane_splits(*row, files)]
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    reads = spark.read.format("fastq_pairs").option("lanes", json.dumps(parts)).load()
    if merged:
        reads = _merged(spark, reads, parts)
    return reads.repartition(partitions) if partitions else reads


def _merged(spark: SparkSession, reads: DataFrame, parts: list[tuple]) -> DataFrame:
    """``ord`` counted on over the lanes of a sample."""
    counts: dict[tuple[str, int], int] = {}
    for sample, lane, _, last, *_ in parts:
        counts[sample, lane] = max(counts.get((sample, lane), 0), last or 0)
    streamed = [(sample, lane) for sample, lane, _, last, *_ in parts if last is None]
    if streamed:
        names = spark.createDataFrame(streamed, "sample string, lane int")
        sized = reads.join(F.broadcast(names), ["sample", "lane"]).groupBy("sample", "lane").count()
        counts |= {(row[0], row[1]): row[2] for row in sized.collect()}
    before, sums = [], {}
    for (sample, lane), n in sorted(counts.items()):
        before.append((sample, lane, sums.get(sample, 0)))
        sums[sample] = sums.get(sample, 0) + n
    # one row per lane
    lanes = F.broadcast(spark.createDataFrame(before, "sample string, lane int, _before long"))
    return reads.join(lanes, ["sample", "lane"]).withColumn("ord", F.col("ord") + F.col("_before")).drop("_before")
