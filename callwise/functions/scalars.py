"""Scalar column expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Wide expressions over many columns are written as SQL text: one call instead of one per operator.
DECISION_THRESHOLD = 0.53
MICROS_PER_DAY = 86_400_000_000


def ident(name: str) -> str:
    """Column name as SQL."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: object) -> str:
    """Python value as SQL."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return f"{value}L"
    if isinstance(value, float):
        if value != value or value in (float("inf"), float("-inf")):
            return f"double('{value}')"
        return f"{value!r}D"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def date_render(c: Column) -> Column:
    """Date or timestamp as ``yyyy-MM-dd`` text; null stays null."""
    return F.date_format(c, "yyyy-MM-dd")


def lenient_timestamp(c: Column) -> Column:
    """Parse text as a timestamp; text that is no timestamp becomes null instead of an error."""
    return F.try_to_timestamp(c)


def days_since(c: Column, reference: str) -> Column:
    """Whole 24-hour units from ``c`` to ``reference``. The reference date is explicit so that reruns agree."""
    ref = F.unix_micros(F.lit(reference).cast("timestamp"))
    return F.floor((ref - F.unix_micros(c.cast("timestamp"))) / F.lit(MICROS_PER_DAY)).cast("int")


def clamp(c: Column, lo: Column, hi: Column) -> Column:
    """Values below ``lo`` become ``lo``, values above ``hi`` become ``hi``.

    Written with ``when`` because ``greatest(null, lo)`` would turn a null into ``lo`` before it can be imputed.
    """
    return F.when(c < lo, lo).when(c > hi, hi).otherwise(c)


def threshold_classify(c: Column, t: float = DECISION_THRESHOLD) -> Column:
    return (c >= F.lit(t)).cast("int")


def linear_logistic(intercept: float, weights: Mapping[str, float]) -> Column:
    """Positive-class probability of a logistic model whose coefficients are known numbers."""
    margin = F.lit(float(intercept))
    for name, weight in weights.items():
        margin = margin + F.lit(float(weight)) * F.col(name)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def is_fractional(dtype: str) -> bool:
    return dtype in ("float", "double")


def is_integral(dtype: str) -> bool:
    return dtype in ("tinyint", "smallint", "int", "bigint")


def is_numeric(dtype: str) -> bool:
    return is_fractional(dtype) or is_integral(dtype) or dtype.startswith("decimal")


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN counts as missing everywhere in this library; Spark itself sorts it above all numbers."""
    wanted = set(df.columns if cols is None else cols)
    swaps = {
        name: F.expr(f"nanvl({ident(name)}, CAST(NULL AS {dtype}))")
        for name, dtype in df.dtypes
        if name in wanted and is_fractional(dtype)
    }
    return df.withColumns(swaps) if swaps else df


def as_doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})
