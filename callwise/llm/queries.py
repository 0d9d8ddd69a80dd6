"""Registered queries of the corpus operators: each applies its operator to whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from callwise.llm import (
    conversations,
    embedding_dedup,
    exact_dedup,
    hard_negatives,
    license_scan,
    line_dedup,
    mixing,
    packing,
    secrets,
    simhash,
    substring_dedup,
    token_counts,
    toxicity,
)
from callwise.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEQUENCE_TOKENS = 1024
TOXIC = 0.7


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, sf_dir))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(documents(spark, sf_dir), width=3, distance=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), capacity=SEQUENCE_TOKENS)


@query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(documents(spark, sf_dir))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[number(i).alias(f"n_{kind}") for i, kind in enumerate(secrets.KINDS[:3])],
        F.sha2(secrets.render("base"), 256).alias("base_sha256"),
        secrets.render(F.concat("base", "added")).alias("spans"),
    )


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(documents(spark, sf_dir))
    return counts.withColumn("over_limit", F.col("n_tokens") > SEQUENCE_TOKENS)


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.with_copies(documents(spark, sf_dir))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.add_scores(docs.select("doc_id", "text"), toxicity.trained(docs, labels))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("key")


@query
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(documents(spark, sf_dir))


@query
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.with_all(conversations.repair_conversations(conversations.damaged(rows)), rows)


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, label=label)
