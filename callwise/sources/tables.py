"""Table, CSV and parquet sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from callwise.sources.staging import stage

SCORES_SCHEMA = "id bigint, score double, version string"
DAILY_SCHEMA = "id bigint, score double, version string, scored_on date"
OUTCOMES_SCHEMA = "id bigint, result int, called_on date"


def read_table(spark: SparkSession, source: str) -> DataFrame:
    """A path (anything with a slash) is read as parquet, anything else as a catalog table."""
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, drop: Sequence[str] = ()) -> DataFrame:
    """CSV with a header under an explicit schema; ``drop`` names stray columns such as a written row index."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    reader = reader.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return reader.schema(schema).csv(path).drop(*drop)


def write_splits(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One table for all splits, partitioned by ``split`` so that reading one split prunes the others."""
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("split") == split).drop("split")


def write_features(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Feature table keyed by the row id; the label travels in the same row as its features."""
    df.write.mode(mode).parquet(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """Upsert whole versions into the long ``(id, version, score, ...)`` table: each version present in ``scores``
    replaces its own partition and leaves the others alone, so a rerun is safe and history is kept."""
    writer = scores.write.mode("overwrite").partitionBy("version")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_scores(spark: SparkSession, path: str, schema: StructType | str = SCORES_SCHEMA) -> DataFrame:
    # an explicit schema keeps partition values such as "2024" or "01" as text
    return spark.read.schema(schema).parquet(path)


def write_daily_scores(scores: DataFrame, day: str, path: str) -> None:
    """Scores by version and day: a rerun replaces its own day of its own versions, all other days stay."""
    dated = scores.withColumn("scored_on", F.lit(day).cast("date"))
    writer = dated.write.mode("overwrite").partitionBy("version", "scored_on")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_outcomes(outcomes: DataFrame, day: str, path: str) -> None:
    """What the calls of a day brought, ``(id, result)`` with result 0 or 1; a rerun replaces the day."""
    dated = outcomes.select("id", F.col("result").cast("int").alias("result"), F.lit(day).cast("date").alias("called_on"))
    dated.write.mode("overwrite").partitionBy("called_on").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OUTCOMES_SCHEMA).parquet(path)


def overwrite_with_column(spark: SparkSession, table: DataFrame, target: str) -> None:
    """Replace the table stored at ``target`` by ``table``, which may be derived from it and have new columns.

    Spark refuses to overwrite what it is reading, so the rows are written to a staging table first. They never
    pass through the driver.
    """
    staged = stage(table, "overwrite")
    if "/" in target:
        staged.write.mode("overwrite").parquet(target)
    else:
        staged.write.mode("overwrite").option("mergeSchema", "true").saveAsTable(target)
