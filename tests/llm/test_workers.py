"""What Python workers hold."""

import numpy as np
import pyarrow as pa

from cellspark.llm.common import ship


def test_freed_memory_goes_back(spark):
    ship(spark)

    def run(batches):
        def held():
            with open("/proc/self/status") as file:
                return next(int(line.split()[1]) for line in file if line.startswith("VmRSS"))

        for _ in batches:
            before = held()
            np.ones(3 << 20)  # from now on the C library would keep arrays up to this size
            arrays = [np.ones(1 << 18) for _ in range(24)]
            del arrays[:-1]  # 46 MB of 48
            yield pa.RecordBatch.from_arrays([pa.array([held() - before])], ["kb"])

    grown = spark.range(1).repartition(1).mapInArrow(run, "kb long").first()["kb"]
    assert grown < 16 << 10


def test_batches_are_small(spark):
    ship(spark)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    texts = spark.range(0, 6000, numPartitions=1).selectExpr("repeat('abcd', 500) as text")
    sizes = [r["n"] for r in texts.mapInArrow(run, "n long").collect()]
    assert sum(sizes) > 12_000_000 and max(sizes) < 3 << 20
