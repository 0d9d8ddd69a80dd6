"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MIN_HOT_ROWS = 20_000
HOT_KEYS = 10_000
SALTS = 64


def join_spread(left: DataFrame, right: DataFrame, on: str, tie: str, how: str = "inner", min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Join a staged ``left`` to ``right``, which has one row per key, and spread hot keys over SALTS partitions.

    A key is hot when it holds more than ``max(min_hot_rows, rows / HOT_KEYS)`` rows of ``left``. At most HOT_KEYS
    keys can, so their list is safe to broadcast. ``tie`` is a column of ``left`` whose hash picks the salt.
    """
    rows = left.count()
    if rows <= min_hot_rows:
        return left.join(right, on, how)
    limit = max(min_hot_rows, rows // HOT_KEYS)
    hot = left.groupBy(on).agg(F.count("*").alias("_m")).filter(F.col("_m") > limit).select(on, F.lit(True).alias("_hot"))
    hot = F.broadcast(hot)
    salted = left.join(hot, on, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(tie), F.lit(SALTS))).otherwise(F.lit(0).cast("bigint"))
    )
    salts = F.expr(f"CASE WHEN _hot THEN sequence(0L, {SALTS - 1}L) ELSE array(0L) END")
    spread = right.join(hot, on, "left").withColumn("_salt", F.explode(salts))
    return salted.drop("_hot").join(spread.drop("_hot"), [on, "_salt"], how).drop("_salt")
