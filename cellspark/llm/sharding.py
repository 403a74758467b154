"""Sharding by a two-pass external shuffle.

Pass one scatters the rows uniformly into memory-sized buckets by a seeded hash; the number of buckets
follows the measured size. Pass two reads one bucket at a time, puts its rows into an order that does not
depend on arrival, shuffles them with Fisher-Yates under the bucket's own seed, and writes them. Bucket
after bucket the rows then stand in one random order, which is cut into shards of equal row counts
(law ``rows``): position g of n goes to shard g * shards div n, so counts differ by one at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellspark.llm.common import ship
from cellspark.plans.scale import checkpoint_root

SHARDS = 40
BUCKET_BYTES = 16 << 20
OVERHEAD = 16
LAW = "rows"


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A uniform permutation of 0..n-1: from the end, each place swaps with one at or before it."""
    draw = np.random.Generator(np.random.PCG64(seed))
    picks = draw.integers(0, np.arange(n, 0, -1)) if n else []
    order = list(range(n))
    for last, pick in zip(range(n - 1, -1, -1), picks):
        order[last], order[pick] = order[pick], order[last]
    return np.array(order, np.int64)


def _shuffle(seed: int, shards: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        bucket = key[0].as_py()
        place = pc.sort_indices(rows, [("_order", "ascending"), ("_content", "ascending")])
        order = place.to_numpy()[fisher_yates(rows.num_rows, seed * 1_000_003 + bucket)]
        rows = rows.take(pa.array(order))
        before, total = rows.column("_before")[0].as_py(), rows.column("_total")[0].as_py()
        position = before + np.arange(rows.num_rows)
        shard = position * shards // total
        slot = position - (-(-shard * total // shards))  # the shard begins at the ceiling
        rows = rows.drop_columns(["_bucket", "_order", "_content", "_before", "_total"])
        rows = rows.append_column("slot", pa.array(slot, pa.int64())).append_column("shard", pa.array(shard, pa.int32()))
        yield from rows.to_batches(max_chunksize=4096)

    return run


def shard(
    rows: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    seed: int = 42,
    bucket_bytes: int = BUCKET_BYTES,
    path: str | None = None,
) -> DataFrame:
    """All columns of ``rows`` and ``slot``, ``shard``: written to ``path`` by shard and read back.

    A row weighs the UTF-8 bytes of its text (null: none) and ``OVERHEAD``. Slots are gapless from 0 in
    each shard. The order depends on the seed, the size and the rows alone: a row is scattered by its id
    and its text, so only rows equal in both share a bucket for certain. Null ids and texts are values
    like others; columns named slot or shard are replaced. Without rows nothing is placed.
    """
    ship(rows.sparkSession)
    spark = rows.sparkSession
    rows = rows.drop("slot", "shard")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + OVERHEAD
    total = rows.agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    buckets = max(1, -(-(total["bytes"] or 0) // bucket_bytes))
    content = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    marked = rows.withColumns(
        {
            "_order": F.coalesce(F.col(id_col).cast("string"), F.lit("")),
            "_content": content,
            "_bucket": F.pmod(content, F.lit(buckets)),
        }
    )
    counts = marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # a row per bucket, which is a row per bucket_bytes of input
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.lit(total["n"]).alias("_total")
    )
    placed = marked.join(starts, "_bucket")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    shuffled = placed.select(*rows.columns, "_bucket", "_order", "_content", "_before", "_total").groupBy("_bucket")
    written = shuffled.applyInArrow(_shuffle(seed, shards), ", ".join([*kept, "slot long", "shard int"]))
    if path is None:
        import uuid

        path = f"{checkpoint_root(spark)}/shards-{uuid.uuid4().hex}"
    written.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    schema = f"{', '.join([*kept, 'slot long'])}, shard int"
    return spark.read.schema(schema).parquet(path)
