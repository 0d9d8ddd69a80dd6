"""The three flows: training, experiments and daily scoring.

Each materializes at the split table, the feature table and the scores table, and is one lazy plan in between.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from callwise.functions.scalars import DECISION_THRESHOLD, threshold_classify
from callwise.operators.features import feature_pipeline
from callwise.operators.forest import DeepForest
from callwise.operators.metrics import point_metrics
from callwise.operators.models import assemble, load_version, positive_probability, voting_model
from callwise.operators.newton import NewtonLogistic
from callwise.operators.relational import dropna_any
from callwise.operators.resampling import Smoted
from callwise.operators.schema import exclude_from, infer_schema
from callwise.operators.selection import best_features
from callwise.operators.serving import as_scores, attach_scores
from callwise.operators.splits import SEED, three_way_split
from callwise.operators.tracking import run_rows
from callwise.operators.validation import gate, validate
from callwise.sources.staging import stage
from callwise.sources.tables import read_scores, write_scores


def prepare(
    history: DataFrame,
    key: str,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    minimum: tuple[str, float] | None = None,
    fit_on: Sequence[str] = ("train", "eval"),
    bounds: str = "batch",
    seed: int = SEED,
) -> tuple[DataFrame, PipelineModel]:
    """Split the complete rows, fit the feature pipeline and apply it to each split by itself.

    Returns the stored feature table ``(key, features..., label, split)`` and the fitted pipeline. ``minimum`` filters
    training and evaluation rows only: a serving row is scored whatever its values. With ``bounds="batch"`` each
    split is clamped by its own quartiles.
    """
    rows = stage(three_way_split(dropna_any(history), key, label, seed=seed), "splits")
    if minimum is not None:
        column, floor = minimum
        rows = rows.filter((F.col("split") == "serving") | (F.col(column) > F.lit(floor)))
    pipeline = feature_pipeline(key, numeric, categorical, keep=[label, "split"], bounds=bounds, group="split")
    fitted = pipeline.fit(rows.filter(F.col("split").isin(*fit_on)))
    return stage(fitted.transform(rows), "features"), fitted


def training_checks(split_rows: DataFrame, key: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Infer the schema from the training split, exclude the label from SERVING, and report the anomalies of the
    other two splits. Returns schema and report."""
    train = split_rows.filter(F.col("split") == "train").drop("split")
    evaluation = split_rows.filter(F.col("split") == "eval").drop("split")
    serving = split_rows.filter(F.col("split") == "serving").drop("split", label)
    schema = stage(exclude_from(infer_schema(train, [key]), label, "SERVING"), "schema")
    report = validate(evaluation, schema, "TRAINING", exclude=[key]).withColumn("data", F.lit("eval"))
    live = validate(serving, schema, "SERVING", exclude=[key], types_from_schema=True).withColumn("data", F.lit("serving"))
    between = validate(train, schema, exclude=[key], serving=serving, previous=evaluation).withColumn("data", F.lit("train"))
    return schema, report.unionByName(live).unionByName(between)


def train_ensemble(
    train: DataFrame, key: str, cols: Sequence[str], label: str, trees: int = 100, depth: int | None = None, seed: int = SEED
) -> PipelineModel:
    """Random forest and logistic regression on the same oversampled rows, combined by the mean of their probabilities."""
    balanced = Smoted(inner=NewtonLogistic(), key=key, cols=list(cols), label=label, seed=seed).balanced(train)
    members = {"rf": DeepForest(trees=trees, deepest=depth, seed=seed).fit(balanced), "lr": NewtonLogistic().fit(balanced)}
    return voting_model(members, cols)


def feature_ablation(
    features: DataFrame, key: str, cols: Sequence[str], label: str, ks: Sequence[int], threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """One run per k: keep the k best features, oversample, fit logistic regression, measure on the evaluation split."""
    train, evaluation = (features.filter(F.col("split") == s) for s in ("train", "eval"))
    runs = None
    for k in ks:
        chosen = best_features(train, cols, label, k) if k < len(cols) else list(cols)
        model = Smoted(inner=NewtonLogistic(), key=key, cols=chosen, label=label).fit(train)
        scored = positive_probability(model, assemble(evaluation, chosen, label))
        measured = point_metrics(scored.withColumn("pred", threshold_classify(F.col("score"), threshold)))
        run = run_rows(measured, f"select-{k}-features", {"test_size": 0.2, "n": len(chosen)})
        runs = run if runs is None else runs.unionByName(run)
    return runs


def batch_score(features: DataFrame, model: PipelineModel, version: str, key: str = "id") -> DataFrame:
    """``(id, score, version)`` of every row of a feature table."""
    return as_scores(model.transform(features), version, key)


def daily_run(
    spark: SparkSession,
    customers: DataFrame,
    schema: DataFrame,
    fitted: PipelineModel,
    model_root: str,
    scores_path: str,
    version: str,
    column: str,
    key: str = "id",
    ignore_columns: Sequence[str] = (),
) -> DataFrame:
    """Check the serving table (a warning at most), prepare it, score it with one version, store the scores and
    return the customers with the score as a column."""
    gate(validate(customers, schema, "SERVING", exclude=[key], ignore_columns=ignore_columns, types_from_schema=True))
    features = fitted.transform(customers)
    write_scores(batch_score(features, load_version(spark, model_root, version), version, key), scores_path)
    return attach_scores(customers, read_scores(spark, scores_path), version, column, key)
