"""Experiment runs as a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

RUNS = "run_name string, params map<string,string>, metrics map<string,double>, model_path string"


def run_row(
    spark: SparkSession, name: str, params: Mapping[str, object], metrics: Mapping[str, float], model_path: str | None = None
) -> DataFrame:
    row = (name, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()}, model_path)
    return spark.createDataFrame([row], RUNS)


def run_rows(metrics: DataFrame, name: str, params: Mapping[str, object], model_path: str | None = None) -> DataFrame:
    """A run whose metrics are the columns of a one-row table (as from ``point_metrics``), without fetching them."""
    told = F.map_from_arrays(
        F.array(*[F.lit(f"validation_{c}") for c in metrics.columns]), F.array(*[F.col(c).cast("double") for c in metrics.columns])
    )
    given = [x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]
    return metrics.select(
        F.lit(name).alias("run_name"),
        (F.create_map(*given) if given else F.lit(None).cast("map<string,string>")).alias("params"),
        told.alias("metrics"),
        F.lit(model_path).cast("string").alias("model_path"),
    )


def log_run(run: DataFrame, path: str) -> None:
    run.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def leaderboard(runs: DataFrame, metrics: Sequence[str] | None = None) -> DataFrame:
    """``(metric, rank, run_name, value)``, best value first; equal values share a rank."""
    rows = runs.select("run_name", F.explode("metrics").alias("metric", "value"))
    if metrics is not None:
        rows = rows.filter(F.col("metric").isin(*metrics))
    # one row per run and metric
    w = Window.partitionBy("metric").orderBy(F.col("value").desc())
    return rows.select("metric", F.rank().over(w).alias("rank"), "run_name", "value")
