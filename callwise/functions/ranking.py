"""Global order without a single-task sort.

A window without ``partitionBy`` pulls all rows into one task. The helpers here split the ordered domain into many
buckets, carry small per-bucket totals across, and let windows work inside one bucket only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from callwise.functions.keyed import hash_bucket, hash_key
from callwise.functions.scalars import literal
from callwise.sources.staging import local_rows, stage

MAX_CLASSES = 10_000
RANGE_ROWS = 1_000  # rows of a range that one task orders, as long as RANGE_BUCKETS ranges are enough
RANGE_BUCKETS = 8_192
RANGE_FANOUT = 64


def class_counts(df: DataFrame, label: str) -> dict[Any, int]:
    """Rows per class. The number of classes is checked, so what reaches the driver is bounded."""
    rows = df.groupBy(label).count().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values and is no class label")
    return {r[0]: r[1] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0]))}


def keys_at_hash_ranks(df: DataFrame, key: str, label: str, seed: int, ranks: Mapping[Any, Sequence[int]]) -> dict[tuple[Any, int], tuple[str, Any]]:
    """The (hash, key) pair that holds each wanted 1-based rank of the hash order inside each class. Ranks of 0 are skipped."""
    hashed = hash_key(F.col(key), seed)
    return _keys_at_ranks(df, key, label, ranks, hashed, hash_bucket(F.col("ord")))


def keys_at_ranks(df: DataFrame, key: str, label: str, ranks: Mapping[Any, Sequence[int]]) -> dict[tuple[Any, int], Any]:
    """The key that holds each wanted 1-based rank inside each class, in the order of the key's own type (number or text)."""
    edges = range_edges(df.filter(F.col(key).isNotNull()), key, ranges_for(df.count()))
    found = _keys_at_ranks(df, key, label, ranks, F.col(key), range_bucket(F.col("ord"), edges))
    return {at: k for at, (_, k) in found.items()}


def _keys_at_ranks(df: DataFrame, key: str, label: str, ranks: Mapping[Any, Sequence[int]], order: Column, bucket: Column) -> dict:
    """Counts per (class, bucket) locate the one bucket that contains a rank; only that part of the class is then sorted."""
    spark = df.sparkSession
    wanted = [(c, int(r)) for c, rs in ranks.items() for r in sorted(set(rs)) if r > 0]
    if not wanted:
        return {}
    keyed = df.select(F.col(label).alias("cls"), F.col(key).alias("key"), order.alias("ord")).withColumn("bucket", bucket)
    per_class = Window.partitionBy("cls").orderBy("bucket")
    counts = (
        keyed.groupBy("cls", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(per_class.rowsBetween(Window.unboundedPreceding, 0)))
    )
    cls_type = df.schema[label].dataType.simpleString()
    targets = local_rows(spark, wanted, f"cls {cls_type}, rank bigint")  # classes x cuts rows
    hits = counts.join(
        F.broadcast(targets.withColumnRenamed("cls", "t_cls")),
        F.col("cls").eqNullSafe(F.col("t_cls")) & (F.col("rank") > F.col("upto") - F.col("n")) & (F.col("rank") <= F.col("upto")),
    ).select(
        F.col("cls").alias("b_cls"),
        F.col("bucket").alias("b_bucket"),
        "rank",
        (F.col("rank") - F.col("upto") + F.col("n")).alias("local_rank"),
    )
    inside = keyed.join(
        F.broadcast(hits), F.col("cls").eqNullSafe(F.col("b_cls")) & (F.col("bucket") == F.col("b_bucket"))
    )
    sorted_part = Window.partitionBy("cls", "rank").orderBy("ord", "key")
    rows = (
        inside.withColumn("pos", F.row_number().over(sorted_part))
        .filter(F.col("pos") == F.col("local_rank"))
        .select("cls", "rank", "ord", "key")
        .collect()  # classes x cuts rows
    )
    return {(r["cls"], r["rank"]): (r["ord"], r["key"]) for r in rows}


def ranges_for(rows: int) -> int:
    """Ranges to cut so many rows into: about RANGE_ROWS each, RANGE_BUCKETS at most."""
    return max(1, min(RANGE_BUCKETS, -(-rows // RANGE_ROWS)))


def hash_position(df: DataFrame, key: str, seed: int, name: str = "pos", by: str | None = None) -> DataFrame:
    """Add a dense 0-based position in hash order, numbered inside 65,536 hash buckets; with ``by``, within each of its values."""
    keyed = df.withColumn("_h", hash_key(F.col(key), seed)).withColumn("_bucket", hash_bucket(F.col("_h")))
    group = [] if by is None else [by]
    ordered = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))  # at most 65,536 rows a group: fixed by the hash prefix
        .select(*group, "_bucket", F.coalesce(F.sum("_n").over(ordered), F.lit(0)).alias("_start"))
    )
    inner = Window.partitionBy(*group, "_bucket").orderBy("_h", key)
    return (
        keyed.withColumn("_row", F.row_number().over(inner))
        .join(F.broadcast(starts) if by is None else starts, [*group, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_row") - 1)
        .drop("_h", "_bucket", "_row", "_start")
    )


def range_bucket(c: Column, edges: Sequence[Any]) -> Column:
    """Number of edges (numbers or texts) below ``c``, found by two short scans (coarse, then fine) over literal arrays."""
    if not edges:
        return F.lit(0)
    coarse = edges[RANGE_FANOUT - 1 :: RANGE_FANOUT]
    below = F.size(F.filter(_literal_array(coarse), lambda e: e < c)) if coarse else F.lit(0)
    start = below * RANGE_FANOUT
    fine = F.slice(_literal_array(edges), start + 1, RANGE_FANOUT)
    return start + F.size(F.filter(fine, lambda e: e < c))


def _literal_array(values: Sequence[Any]) -> Column:
    return F.expr(f"array({', '.join(literal(v) for v in values)})")


def range_edges(table: DataFrame, column: str, buckets: int = RANGE_BUCKETS) -> list[Any]:
    """Values that cut ``column`` into about equally full ranges. Only the balance depends on them, no result does.

    Texts, which must be distinct, are cut at a hash sample of themselves.
    """
    if buckets < 2:
        return []
    if dict(table.dtypes)[column] == "string":
        return sorted(r[0] for r in table.select(column).orderBy(F.xxhash64(column), column).limit(buckets - 1).collect())
    probs = [i / buckets for i in range(1, buckets)]
    return sorted(set(table.stat.approxQuantile(column, probs, 1 / (4 * buckets))))


def running_totals(
    table: DataFrame,
    order: str,
    sums: Mapping[str, str],
    descending: bool = False,
    buckets: int | None = None,
    is_staged: bool = False,
) -> DataFrame:
    """Running sums over the whole table in the order of ``order``, a number or text whose values must be distinct.

    ``sums`` maps an output name to the column that is summed. The input is staged, so its size is known and both
    passes see the same rows. The rows are cut into ranges, more of them the more rows there are, and each range starts
    from the total of the ranges before it.
    """
    staged = table if is_staged else stage(table, "ordered")
    direction = F.col(order).desc() if descending else F.col(order).asc()
    buckets = buckets or ranges_for(staged.count())
    value = F.col(order) if dict(staged.dtypes)[order] == "string" else F.col(order).cast("double")
    cut = staged.withColumn("_r", range_bucket(value, range_edges(staged, order, buckets)))
    ranges = Window.orderBy(F.col("_r").desc() if descending else F.col("_r").asc())
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("_r").agg(*[F.sum(src).alias(f"_t_{out}") for out, src in sums.items()])
    starts = starts.select(
        "_r", *[F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_s_{out}") for out in sums]
    )  # at most `buckets` rows
    w = Window.partitionBy("_r").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.join(F.broadcast(starts), "_r")
        .withColumns({out: F.sum(src).over(w) + F.col(f"_s_{out}") for out, src in sums.items()})
        .drop("_r", *[f"_s_{out}" for out in sums])
    )


def with_previous(
    table: DataFrame,
    order: Sequence[str],
    columns: Sequence[str],
    buckets: int | None = None,
) -> DataFrame:
    """Add ``prev_<column>``: the value in the row before, in the order of ``order``, over the whole table.

    The first order column is numeric and decides the range; a range's first row takes the last row of the nearest
    range before it.
    """
    staged = stage(table, "lagged")
    row = F.struct(*columns)
    first = F.col(order[0]).cast("double")
    cut = staged.withColumn("_r", range_bucket(first, range_edges(staged, order[0], buckets or ranges_for(staged.count()))))
    lasts = cut.groupBy("_r").agg(F.max_by(row, F.struct(*order)).alias("_last"))
    lasts = lasts.select("_r", F.lag("_last").over(Window.orderBy("_r")).alias("_carry"))  # <= `buckets` rows
    inner = Window.partitionBy("_r").orderBy(*order)
    marked = cut.join(F.broadcast(lasts), "_r").withColumn("_prev", F.coalesce(F.lag(row).over(inner), F.col("_carry")))
    marked = marked.drop("_r", "_carry")
    return marked.withColumns({f"prev_{c}": F.col(f"_prev.{c}") for c in columns}).drop("_prev")


def running_totals_by(
    staged: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Mapping[str, str],
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Running sums inside every group of ``by``, in the order of the number ``order``, distinct within a group; with
    ``total_<output>``, the sum of the whole group.

    All groups share the ranges of ``order``, so a group that holds most of the rows is cut into as many tasks as the
    ranges it spans. The total before a range enters the range as a row of its own, ahead of the others: no join, and
    nothing that grows with the number of groups is broadcast. The input must be staged, as it is read three times.
    """
    buckets = buckets or ranges_for(staged.count())
    value = F.col(order).cast("double")
    cut = staged.withColumn("_r", range_bucket(value, range_edges(staged, order, buckets)))
    ranges = Window.partitionBy(*by).orderBy(F.col("_r").desc() if descending else F.col("_r").asc())  # at most `buckets` rows a group
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    per_range = cut.groupBy(*by, "_r").agg(*[F.sum(src).alias(f"_t_{out}") for out, src in sums.items()])
    carried = per_range.select(
        *by, "_r", F.lit(False).alias("_is_row"),
        *[F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_v_{out}") for out in sums],
        *[F.sum(f"_t_{out}").over(group).alias(f"_all_{out}") for out in sums],
    )
    rows = cut.withColumn("_is_row", F.lit(True)).withColumns({f"_v_{out}": F.col(src) for out, src in sums.items()})
    both = rows.unionByName(carried, allowMissingColumns=True)
    direction = F.col(order).desc() if descending else F.col(order).asc()
    inner = Window.partitionBy(*by, "_r").orderBy("_is_row", direction).rowsBetween(Window.unboundedPreceding, 0)
    summed = both.withColumns(
        {out: F.sum(f"_v_{out}").over(inner) for out in sums}
        | {f"total_{out}": F.first(f"_all_{out}", ignorenulls=True).over(inner) for out in sums}
    )
    return summed.filter("_is_row").drop("_r", "_is_row", *[f"_{k}_{out}" for out in sums for k in ("v", "all")])
