"""Scores of several model versions, their outcomes and the daily call list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callwise.functions.scalars import DECISION_THRESHOLD, threshold_classify
from callwise.operators.metrics import point_aggregates


def as_scores(scored: DataFrame, version: str, key: str = "id", score: str = "score") -> DataFrame:
    return scored.select(F.col(key).alias("id"), F.col(score).cast("double").alias("score"), F.lit(version).alias("version"))


def attach_scores(customers: DataFrame, scores: DataFrame, version: str, column: str, key: str = "id") -> DataFrame:
    """Add one version's score as a column. The join is by key: rows of a distributed table have no position."""
    mine = scores.filter(F.col("version") == version).select(F.col("id").alias(key), F.col("score").alias(column))
    return customers.drop(column).join(mine, key, "left")


def attach_versions(customers: DataFrame, scores: DataFrame, columns: dict[str, str], key: str = "id") -> DataFrame:
    """Add the scores of several versions (version -> column name) with one join."""
    picks = [F.max(F.when(F.col("version") == v, F.col("score"))).alias(c) for v, c in columns.items()]
    wide = scores.filter(F.col("version").isin(*columns)).groupBy(F.col("id").alias(key)).agg(*picks)
    return customers.drop(*columns.values()).join(wide, key, "left")


def champion_challenger(scores: DataFrame, old: str, new: str) -> DataFrame:
    """``(id, old_score, new_score, change)``, a customer scored by only one version kept with a null."""
    pick = lambda v: F.max(F.when(F.col("version") == v, F.col("score")))
    both = scores.filter(F.col("version").isin(old, new)).groupBy("id").agg(pick(old).alias("old_score"), pick(new).alias("new_score"))
    return both.withColumn("change", F.col("new_score") - F.col("old_score"))


def latest_scores(daily: DataFrame) -> DataFrame:
    """The score of the last day on which a version scored a customer."""
    last = F.max_by(F.struct("score", "scored_on"), "scored_on")
    return daily.groupBy("id", "version").agg(last.alias("l")).select("id", "version", "l.score", "l.scored_on")


def latest_outcomes(outcomes: DataFrame) -> DataFrame:
    """``(id, result)``: a customer who was called several times counts once, with the last outcome; of two on one day the
    better one."""
    return outcomes.groupBy("id").agg(F.max(F.struct("called_on", "result")).alias("l")).select("id", "l.result")


def outcome_metrics(scores: DataFrame, outcomes: DataFrame, threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """Precision, recall, accuracy and number of calls of each version, against what the calls brought."""
    called = scores.join(outcomes.select("id", F.col("result").alias("label")), "id").withColumn("pred", threshold_classify(F.col("score"), threshold))
    return called.groupBy("version").agg(*point_aggregates("label", "pred"), F.count("*").alias("calls"))


def call_list(scores: DataFrame, outcomes: DataFrame, version: str, n: int) -> DataFrame:
    """The n customers to call next: best score first, those already called left out. A top-n, not a full sort."""
    waiting = scores.filter(F.col("version") == version).join(outcomes.select("id"), "id", "left_anti")
    return waiting.select("id", "score").orderBy(F.col("score").desc(), "id").limit(n)
