"""Projections, filters and set operations with campaign semantics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from callwise.functions.scalars import nan_to_null


def feature_allowlist(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    return df.drop(*exclude)


def serving_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def split_label(df: DataFrame, key: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Features and label as two frames that share the key. Flows keep the label in the row instead."""
    return df.drop(label), df.select(key, label)


def column_routing(
    df: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Numeric columns as doubles, then the categorical ones in their own types; all others are dropped."""
    numbers = [F.col(c).cast("double").alias(c) for c in numeric]
    return df.select(key, *numbers, *categorical, *keep)


def dropna_any(df: DataFrame) -> DataFrame:
    """Rows without any missing value; NaN counts as missing."""
    return nan_to_null(df).na.drop("any")


def min_value_filter(df: DataFrame, column: str, floor: float) -> DataFrame:
    return df.filter(F.col(column) > F.lit(floor))


def fit_union(*parts: DataFrame) -> DataFrame:
    """Stack the rows of all parts by column name, duplicates kept."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
