"""The corpus pipeline: each stage applies one operator to all that the stage before it kept.

A stage is a function ``(spark, docs, sf_dir) -> DataFrame``. Its result is written as Parquet and read again as the
next one's ``docs``, so no lineage runs through the whole and a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callwise.llm import exact_dedup, mixing, packing, simhash, toxicity
from callwise.sources.staging import stage


TOXIC = 0.7
SEQUENCE_TOKENS = 1024


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the score is learned from the labelled ones among ``docs``."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), TOXIC)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: three-word shingles, two bits."""
    return simhash.drop_near_duplicates(docs, width=3, distance=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens by source, language and topic meet the tempered marginals of ``docs``."""
    return mixing.sample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its sequence and offset there."""
    return packing.pack(docs, capacity=SEQUENCE_TOKENS)


STAGES = [("toxicity", clean), ("exact dedup", exact), ("simhash near-dedup", near), ("mixing", mixed), ("packing", packed)]

#: Trained scores, tokenizer counts and drawn samples are not SQL; the tests compare the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
