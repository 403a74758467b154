"""Helpers the training-data operators share."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path may be in any store Spark reads."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of rows that Spark hands to a Python worker at once, where the session leaves it at the default.
BATCH_BYTES = "2m"
_BATCHES, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
#: Lets Python workers give memory back when it is freed. Stage after stage uses the same workers, and by default the C
#: library keeps arrays of up to 32 MB in a heap that one live object on top holds in full; Arrow has a pool besides.
WORKER_ENVIRONMENT = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(4 << 20),
}


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and keep their memory and batches small.

    What the session's environment or configuration already says about memory stays.
    """
    env = spark.sparkContext.environment
    if PACKAGE_ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, [env.get("PYTHONPATH")])])
    for name, value in WORKER_ENVIRONMENT.items():
        env.setdefault(name, value)
    if spark.conf.get(_BATCHES, _DEFAULT) == _DEFAULT:
        spark.conf.set(_BATCHES, BATCH_BYTES)


def lower_ascii(column) -> F.Column:
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
