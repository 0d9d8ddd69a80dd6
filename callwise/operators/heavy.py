"""The most frequent values of columns with many values, exact, without a shuffle of all distinct values.

1. Every task keeps a frequent-items summary of fixed size per column; the summaries merge. They name candidates and
   bound how often any other value can occur.
2. A second scan counts the candidates exactly.
3. A column is settled when its k-th count lies above what an unnamed value can reach: above the error bound of the
   summary, or above the number of rows that no candidate covers. The others (flat columns, where the k-th value hardly
   differs from all the rest) are counted in full, as no summary of fixed size can tell their values apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from callwise.functions.scalars import ident, is_numeric, literal, nan_to_null
from callwise.operators.stats import tall, top_values
from callwise.sources.staging import hold, stage

TRACKED = 10_000
CANDIDATES_PER_RANK = 5
LEAST_CANDIDATES = 100


def _error_share(tracked: int) -> float:
    """Largest error of the summary as a share of the rows: 3.5 over the slots of its table, a power of two that is 3/4 full."""
    slots = 1
    while slots * 0.75 < tracked:
        slots *= 2
    return 3.5 / slots


def _candidates(df: DataFrame, cols: Sequence[str], by: Sequence[str], wanted: int, tracked: int) -> DataFrame:
    """``(by..., feature, rows, reach, items)``: up to ``wanted`` values and how often another value can occur at most.

    A value is listed when it surely lies above the error; what is not listed lies below twice the error, or below the
    last one listed where the list is full.
    """
    aggs, entries = [], []
    for i, c in enumerate(cols):
        text = f"CAST({ident(c)} AS STRING)"
        aggs += [f"count({text}) AS n_{i}", f"approx_top_k({text}, {wanted}, {tracked}) AS t_{i}"]
        entries.append(
            f"named_struct('feature', {literal(c)}, 'rows', n_{i}, 'reach', greatest({2 * _error_share(tracked)!r}D * n_{i}, "
            f"CASE WHEN size(t_{i}) >= {wanted} THEN CAST(element_at(t_{i}, -1).count AS DOUBLE) ELSE 0D END), 'items', transform(t_{i}, x -> x.item))"
        )
    return tall(df.groupBy(*by).agg(*map(F.expr, aggs)), by, entries)


def _same(left: DataFrame, right: DataFrame, by: Sequence[str], prefix: str, *columns: str) -> Column:
    same = None
    for c in [*by, *columns]:
        pair = left[c].eqNullSafe(right[f"{prefix}{c}"])
        same = pair if same is None else same & pair
    return same


def settled_values(df: DataFrame, cols: Sequence[str], k: int = 20, by: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    """``(by..., feature, rank, value, n, settled)``: exact counts of the best k candidates. Where ``settled`` is false, a
    value that is not listed may be as frequent. A column of a group without any candidate gives one row with rank 0."""
    df = nan_to_null(df, cols)
    types = dict(df.dtypes)
    wanted = min(tracked, max(LEAST_CANDIDATES, CANDIDATES_PER_RANK * k))
    found = hold(_candidates(df, cols, by, wanted, tracked).filter("rows > 0"), "candidates")  # a row per column and group
    named = found.select(*[F.col(b).alias(f"_{b}") for b in by], F.col("feature").alias("_feature"), F.explode("items").alias("_value"))
    entries = [
        f"named_struct('feature', {literal(c)}, 'value', CAST({ident(c)} AS STRING), "
        f"'num', CAST({ident(c) if is_numeric(types[c]) else 'NULL'} AS DOUBLE))"
        for c in cols
    ]
    values = tall(df, by, entries).filter("value IS NOT NULL")
    named = hold(named, "named")  # `wanted` rows per column and group, of checked size
    counted = values.join(named, _same(values, named, by, "_", "feature", "value"), "left_semi")
    counted = stage(counted.groupBy(*by, "feature", "value", "num").agg(F.count("*").alias("n")), "counted")  # as many rows as `named`
    best = Window.partitionBy(*by, "feature").orderBy(F.col("n").desc(), "num", "value")
    all_of = Window.partitionBy(*by, "feature")
    ranked = counted.withColumns({"rank": F.row_number().over(best), "_covered": F.sum("n").over(all_of)}).filter(F.col("rank") <= k)
    ranked = ranked.withColumn("_last", F.max(F.when(F.col("rank") == k, F.col("n"))).over(all_of))
    ranked = ranked.select(*[F.col(b).alias(f"_{b}") for b in by], F.col("feature").alias("_feature"), "rank", "value", "n", "_covered", "_last")
    joined = found.join(ranked, _same(found, ranked, by, "_", "feature"), "left")
    left_over = F.col("rows") - F.coalesce("_covered", F.lit(0))
    is_settled = (left_over == 0) | F.coalesce(F.col("_last") > F.least(F.col("reach"), left_over), F.lit(False))
    return joined.select(*by, "feature", F.coalesce("rank", F.lit(0)).alias("rank"), "value", "n", is_settled.alias("settled"))


def heavy_values(df: DataFrame, cols: Sequence[str], k: int = 20, by: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    """``(by..., feature, rank, value, n)``: the k most frequent values of each column, of equally frequent ones the smaller.

    The result is that of ``top_values``. What is shuffled does not depend on the number of distinct values, except for the
    columns that a summary cannot settle. Nulls and NaN do not count; a column without values gives no rows.
    """
    ranked = hold(settled_values(df, cols, k, by, tracked), "ranked")
    done = ranked.filter("settled").drop("settled")
    open_cols = sorted(r[0] for r in ranked.filter("NOT settled").select("feature").distinct().collect())  # names of columns
    if not open_cols:
        return done
    groups = ranked.filter("NOT settled").select(*[F.col(b).alias(f"_{b}") for b in by], F.col("feature").alias("_feature")).distinct()
    counted = top_values(df, open_cols, k, by)
    return done.unionByName(counted.join(groups, _same(counted, groups, by, "_", "feature"), "left_semi"))
