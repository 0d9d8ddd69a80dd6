"""Pseudo-random draws keyed by row id.

``rand(seed)`` depends on the partitioning and so changes on a retry or a rerun. These draws depend on the id and
the seed only, and any SQL engine with ``md5`` can repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DRAW_DIGITS = 15
DRAWS = 2.0 ** (4 * DRAW_DIGITS)
BUCKET_DIGITS = 4  # 65,536 hash buckets


def hash_key(key: Column, seed: int) -> Column:
    """32 hexadecimal digits; sorting by them shuffles the rows."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")).cast("binary"))


def hash_key_sql(key: str, seed: int) -> str:
    return f"md5(CAST(concat(CAST({key} AS STRING), '-{seed}') AS BINARY))"


def hash_bucket(hashed: Column) -> Column:
    return F.substring(hashed, 1, BUCKET_DIGITS)


def hash_integer(text: Column) -> Column:
    """Integer in [0, 2**60) from the first 15 hexadecimal digits: far more than rows, so a remainder is even."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_DIGITS), 16, 10).cast("bigint")
