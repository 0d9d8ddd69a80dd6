"""Data schema as a table: one row of constraints per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from callwise.operators.stats import features_of, profile, value_counts

CONSTRAINTS = (
    "feature string, type string, min_fraction double, min_count bigint, shape_dim int, domain array<string>, "
    "is_bool boolean, not_in_environment array<string>, skew_threshold double, drift_threshold double"
)
DEFAULT_ENVIRONMENTS = ("TRAINING", "SERVING")
DOMAIN_LIMIT = 100


def infer_schema(df: DataFrame, exclude: Sequence[str] = (), domain_limit: int = DOMAIN_LIMIT) -> DataFrame:
    """Constraints that the given data meets: type, presence, one value per cell, closed domain of strings with at
    most ``domain_limit`` distinct values, and a bool domain for integers that are only 0 or 1."""
    cols = features_of(df, exclude)
    types = dict(df.dtypes)
    text = [c for c in cols if types[c] == "string"]
    unit = (F.col("type") == "INT") & (F.col("lo") >= 0) & (F.col("hi") <= 1)
    out = profile(df, cols).select(
        "feature",
        "type",
        F.when(F.col("num_missing") == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("min_fraction"),
        F.lit(1).cast("bigint").alias("min_count"),
        F.when(F.col("max_num_values") == F.col("min_num_values"), F.col("max_num_values").cast("int")).alias("shape_dim"),
        F.coalesce(unit, F.lit(False)).alias("is_bool"),
    )
    if text:
        # one value over the limit is enough to know that a domain is open, so no more are kept
        order = Window.partitionBy("feature").orderBy("value")
        some = value_counts(df, text).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= domain_limit + 1)
        domains = some.groupBy("feature").agg(F.array_sort(F.collect_list("value")).alias("domain"))
        out = out.join(domains.filter(F.size("domain") <= domain_limit), "feature", "left")
    else:
        out = out.withColumn("domain", F.lit(None).cast("array<string>"))
    return out.select(
        "feature",
        "type",
        "min_fraction",
        "min_count",
        "shape_dim",
        "domain",
        "is_bool",
        F.array().cast("array<string>").alias("not_in_environment"),
        F.lit(None).cast("double").alias("skew_threshold"),
        F.lit(None).cast("double").alias("drift_threshold"),
    )


def exclude_from(schema: DataFrame, feature: str, environment: str) -> DataFrame:
    """Declare that a feature (such as the label) is absent in an environment."""
    added = F.array_union("not_in_environment", F.array(F.lit(environment)))
    return schema.withColumn("not_in_environment", F.when(F.col("feature") == feature, added).otherwise(F.col("not_in_environment")))


def with_thresholds(schema: DataFrame, feature: str, skew: float | None = None, drift: float | None = None) -> DataFrame:
    """Turn on the skew or drift check of a feature; both are off by default."""
    mine = F.col("feature") == feature
    return schema.withColumns(
        {
            "skew_threshold": F.when(mine, F.lit(skew).cast("double")).otherwise(F.col("skew_threshold")),
            "drift_threshold": F.when(mine, F.lit(drift).cast("double")).otherwise(F.col("drift_threshold")),
        }
    )


def expected_in(schema: DataFrame, environment: str | None) -> DataFrame:
    if environment is None:
        return schema
    return schema.filter(~F.array_contains("not_in_environment", environment))


def environments_of(schema: DataFrame, defaults: Sequence[str] = DEFAULT_ENVIRONMENTS) -> DataFrame:
    """``(feature, environment)`` for every environment a feature belongs to."""
    every = F.array(*[F.lit(e) for e in defaults])
    return schema.select("feature", F.explode(F.array_except(every, "not_in_environment")).alias("environment"))


def write_schema(schema: DataFrame, path: str, mode: str = "errorifexists") -> None:
    schema.write.mode(mode).parquet(path)


def read_schema(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONSTRAINTS).parquet(path)
