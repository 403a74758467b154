"""One query per training-data operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.llm import (
    conversations,
    decontaminate,
    harmonic,
    language_id,
    merkle,
    packing,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
    topk,
    url_filter,
    warc,
)
from cellspark.llm.common import lower_ascii, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Fixed rules of the url query: host, path, action.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.in_fold(F.col("doc_id"))
    marked = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text", "lang")
    found = language_id.identify(marked, ~held_out, carry=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    placed = sharding.shard(docs)
    return placed.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + sharding.OVERHEAD).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_folder(spark)
    written = warc.write(table(spark, sf_dir, "pages"), folder)
    members = warc.normalise(written, folder)
    return warc.read(members, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.repeated_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0), lambda total, h: total + h[1] - h[0]).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    found = conversations.repair(conversations.damage(given))
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    rows = given.select("conv_id").distinct().select("conv_id", key)
    rows = rows.join(found.report.select(key, *counts, "audit"), "_id", "left")
    rows = rows.join(found.digests().select(key, "repaired_sha256"), "_id", "left")
    return rows.select(
        "conv_id",
        *[F.when(F.col("audit").isNull(), 0).otherwise(F.col(c)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonic.pack(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = docs.select(
        "doc_id",
        "lang",
        merkle.row_digest(*fields, F.col("text")).alias("leaf"),
        # only where it differs from the leaf
        F.when(tampered, merkle.row_digest(*fields, lower_ascii("text"))).alias("tampered_leaf"),
    )
    found = merkle.manifest(leaves, "leaf", "lang", ["doc_id"])
    folded = merkle.fold(F.coalesce("tampered_leaf", "leaf"), F.col("path"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_best_fit_packing,
        op3_sharding,
        op4_suffix_array_dedup,
        op5_warc,
        op6_substring_dedup,
        op7_url_filters,
        op8_exact_top_k,
        op9_decontamination,
        op10_simhash,
        op11_conversation_repair,
        op12_harmonic_packing,
        op13_merkle_manifest,
    )
}
