"""Corpus pipeline over ``documents``: each stage works on what the one before it kept.

language ID -> SimHash near-dedup -> substring dedup -> benchmark decontamination -> best-fit packing.
All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.llm import decontaminate, language_id, near_dups, packing, substring_dedup
from cellspark.llm.common import table
from cellspark.llm.queries import TOKENIZER
from cellspark.plans.scale import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what language ID rejects; ``lang`` stays as given, or becomes the prediction where it is null."""
    marked = language_id.identify(docs, carry=COLUMNS)
    kept = marked.filter(~F.col("rejected"))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (Jaccard of 5-word shingles at least 0.8) the row with the smallest id stays."""
    return near_dups.first_of_each(docs.select(*COLUMNS))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages. A text that loses nothing stays as it is; one that loses all goes."""
    found = substring_dedup.repeated_words(docs, carry=["lang", "source", "n_chars"], as_is=True)
    left = found.filter("n_removed = 0 or n_removed < n_words").withColumnRenamed("kept", "text")
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), carry=COLUMNS[1:])
    return found.filter(F.size("hits") == 0).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language_id", identify),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substrings),
    ("benchmark_decontamination", decontaminated),
    ("best_fit_packing", packed),
]

#: SQL has neither the fingerprints nor the tokenizer; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        # a stage's own tables go as soon as its output is written
        docs = settle(spark, partial(stage, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
