"""Feature statistics as tables: one row per feature, per histogram bucket or per frequent value.

All columns are measured in one aggregation, so the number of jobs does not grow with the number of columns, and
``by`` measures several data sets (splits, versions) in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from callwise.functions.quantiles import quantiles
from callwise.functions.scalars import ident, is_fractional, is_integral, is_numeric, literal, nan_to_null
from callwise.sources.staging import hold, local_rows, stage


def feature_type(dtype: str) -> str:
    """INT, FLOAT or BYTES, the three kinds the schema knows."""
    if dtype.startswith("array<"):
        return feature_type(dtype[6:-1])
    if is_integral(dtype) or dtype == "boolean":
        return "INT"
    if is_fractional(dtype) or dtype.startswith("decimal"):
        return "FLOAT"
    return "BYTES"


def features_of(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def tall(df: DataFrame, by: Sequence[str], structs: Sequence[str]) -> DataFrame:
    """One output row per struct (SQL text), the ``by`` columns repeated."""
    return df.select(*by, F.expr(f"inline(array({', '.join(structs)}))"))


def value_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by..., feature, value, num, n)`` for every distinct non-null value. ``num`` is set for numeric columns, so
    sorting by ``(num, value)`` is the order of the column's own type. Counts are combined before the shuffle."""
    df = nan_to_null(df, cols)
    types = dict(df.dtypes)
    entries = [
        f"named_struct('feature', {literal(c)}, 'value', CAST({ident(c)} AS STRING), "
        f"'num', CAST({ident(c) if is_numeric(types[c]) else 'NULL'} AS DOUBLE))"
        for c in cols
    ]
    return tall(df, by, entries).filter("value IS NOT NULL").groupBy(*by, "feature", "value", "num").agg(F.count("*").alias("n"))


def profile(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """What schema inference and validation need to know of each feature, from one pass over the data: type, presence,
    values per example, and the smallest and largest number."""
    df = nan_to_null(df, cols)
    types = dict(df.dtypes)
    aggs, entries = ["count(*) AS num_examples"], []
    for i, c in enumerate(cols):
        q, listed, number = ident(c), types[c].startswith("array<"), is_numeric(types[c])
        aggs.append(f"count({q}) AS n_{i}")
        if listed:
            aggs += [f"{f}(CASE WHEN {q} IS NOT NULL THEN size({q}) END) AS {k}_{i}" for f, k in (("min", "a"), ("max", "b"), ("sum", "t"))]
        if number:
            aggs += [f"CAST(min({q}) AS DOUBLE) AS lo_{i}", f"CAST(max({q}) AS DOUBLE) AS hi_{i}"]
        single = f"CASE WHEN n_{i} > 0 THEN 1L END"  # a scalar cell holds one value
        total = f"CAST(coalesce(t_{i}, 0) AS BIGINT)" if listed else f"n_{i}"
        entries.append(
            f"named_struct('feature', {literal(c)}, 'type', '{feature_type(types[c])}', 'num_examples', num_examples, "
            f"'num_features', {len(cols)}L, 'num_non_missing', n_{i}, 'num_missing', num_examples - n_{i}, "
            f"'min_num_values', {f'CAST(a_{i} AS BIGINT)' if listed else single}, "
            f"'max_num_values', {f'CAST(b_{i} AS BIGINT)' if listed else single}, "
            f"'avg_num_values', try_divide(CAST({total} AS DOUBLE), n_{i}), 'tot_num_values', {total}, "
            f"'lo', {f'lo_{i}' if number else 'CAST(NULL AS DOUBLE)'}, 'hi', {f'hi_{i}' if number else 'CAST(NULL AS DOUBLE)'})"
        )
    return tall(df.groupBy(*by).agg(*map(F.expr, aggs)), by, entries)


def stats_common(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Presence and values per example of each feature, with the number of examples and of features."""
    return profile(df, cols, by).drop("lo", "hi")


def numeric_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    types = dict(df.dtypes)
    return [c for c in cols if is_numeric(types[c])]


def stats_numeric(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean, population deviation, zeros, minimum, exact median and maximum of numeric features."""
    df = nan_to_null(df, cols)
    aggs, entries = [], []
    for i, c in enumerate(cols):
        v = f"CAST({ident(c)} AS DOUBLE)"
        aggs += [f"avg({v}) AS mean_{i}", f"stddev_pop({v}) AS sd_{i}", f"count(CASE WHEN {v} = 0 THEN 1 END) AS z_{i}"]
        aggs += [f"min({v}) AS lo_{i}", f"max({v}) AS hi_{i}"]
        entries.append(
            f"named_struct('feature', {literal(c)}, 'mean', mean_{i}, 'std_dev', sd_{i}, 'num_zeros', z_{i}, 'min', lo_{i}, 'max', hi_{i})"
        )
    moments = tall(df.groupBy(*by).agg(*map(F.expr, aggs)), by, entries)
    medians = quantiles(df, cols, [0.5], by).select(*by, "feature", F.col("value").alias("median"))
    return moments.join(medians, [*by, "feature"], "left")


def stats_string(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Unique values, average length and the most frequent value (of equal ones the smallest) of string features."""
    counts = value_counts(df, cols, by)
    # each distinct value is one row here, so `count` is the number of unique values
    return counts.groupBy(*by, "feature").agg(
        F.count("*").alias("num_unique"),
        (F.sum(F.length("value") * F.col("n")) / F.sum("n")).alias("avg_length"),
        F.min(F.struct((-F.col("n")).alias("m"), "value")).alias("top"),
    ).select(*by, "feature", "num_unique", "avg_length", F.col("top.value").alias("top_value"), (-F.col("top.m")).alias("top_count"))


def feature_stats(df: DataFrame, exclude: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Common, numeric and string statistics of every feature in one table."""
    cols = features_of(df, [*exclude, *by])
    types = dict(df.dtypes)
    numeric = numeric_columns(df, cols)
    text = [c for c in cols if c not in numeric and not types[c].startswith("array<")]
    out = stats_common(df, cols, by)
    on = [*by, "feature"]
    if numeric:
        out = out.join(stats_numeric(df, numeric, by), on, "left")
    if text:
        out = out.join(stats_string(df, text, by), on, "left")
    return out


def hist_equal_width(df: DataFrame, cols: Sequence[str], buckets: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Counts in equally wide buckets between minimum and maximum; empty buckets are listed, the last includes the
    maximum. A constant feature has all its values in the first bucket."""
    df = nan_to_null(df, cols)
    ends = [F.expr(f"{f}(CAST({ident(c)} AS DOUBLE)) AS {f}_{i}") for i, c in enumerate(cols) for f in ("min", "max")]
    limits = df.groupBy(*by).agg(*ends)
    spans = ", ".join(f"named_struct('feature', {literal(c)}, 'lo', min_{i}, 'width', (max_{i} - min_{i}) / {buckets})" for i, c in enumerate(cols))
    limits = stage(limits.select(*by, F.expr(f"inline(array({spans}))")).filter("lo IS NOT NULL"), "limits")  # a row per group and column
    frames = limits.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    values = [f"named_struct('feature', {literal(c)}, 'value', CAST({ident(c)} AS DOUBLE))" for c in cols]
    place = f"CASE WHEN width > 0 THEN least({buckets - 1}, CAST(floor((value - lo) / width) AS INT)) ELSE 0 END AS bucket"
    on = [*by, "feature"]
    counts = (
        tall(df, by, values)
        .filter("value IS NOT NULL")
        .join(limits, on)
        .groupBy(*on, F.expr(place))
        .agg(F.count("*").alias("n"))
    )
    return frames.join(counts, [*by, "feature", "bucket"], "left").select(
        *by,
        "feature",
        "bucket",
        (F.col("lo") + F.col("bucket") * F.col("width")).alias("low"),
        (F.col("lo") + (F.col("bucket") + 1) * F.col("width")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def hist_quantiles(df: DataFrame, cols: Sequence[str], buckets: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Buckets between exact quantiles and the values in each: from ``low`` on, below ``high``, the last includes it.

    Values that occur often make buckets uneven; a bucket without width is empty unless it is the last.
    """
    df = nan_to_null(df, cols)
    edges = hold(quantiles(df, cols, [i / buckets for i in range(buckets + 1)], by), "edges")
    limits = edges.groupBy(*by, "feature").agg(F.array_sort(F.collect_list(F.struct("prob", "value"))).alias("e"))  # buckets + 1 numbers
    limits = limits.select(*[F.col(b).alias(f"_{b}") for b in by], F.col("feature").alias("_f"), F.expr("transform(e, x -> x.value)").alias("e"))
    values = [f"named_struct('feature', {literal(c)}, 'value', CAST({ident(c)} AS DOUBLE))" for c in cols]
    same = F.col("feature") == F.col("_f")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_{b}"))
    place = F.expr(f"least({buckets - 1}, size(filter(e, x -> x <= value)) - 1)").alias("bucket")
    counts = tall(df, by, values).filter("value IS NOT NULL").join(limits, same).groupBy(*by, "feature", place).agg(F.count("*").alias("n"))
    frames = limits.select(*[F.col(f"_{b}").alias(b) for b in by], F.col("_f").alias("feature"), F.posexplode(F.slice("e", 1, buckets)).alias("bucket", "low"), "e")
    frames = frames.withColumn("high", F.element_at("e", F.col("bucket") + 2)).drop("e")
    again = counts.select(*[F.col(b).alias(f"_{b}") for b in by], F.col("feature").alias("_f"), F.col("bucket").alias("_b"), "n")
    same = same & (F.col("bucket") == F.col("_b"))
    return frames.join(again, same, "left").select(*by, "feature", "bucket", "low", "high", F.coalesce("n", F.lit(0)).alias("n"))


def top_values(df: DataFrame, cols: Sequence[str], k: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """The k most frequent values of each feature, ranked; of equally frequent values the smaller comes first.

    The rank filter is pushed below the shuffle, so a task ships at most k values of a feature.
    """
    w = Window.partitionBy(*by, "feature").orderBy(F.col("n").desc(), "num", "value")
    ranked = value_counts(df, cols, by).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select(*by, "feature", "rank", "value", "n")


def compare_stats(lhs: DataFrame, rhs: DataFrame, lhs_name: str = "lhs", rhs_name: str = "rhs") -> DataFrame:
    """Two statistics tables side by side, a feature of only one of them kept with nulls for the other."""

    def prefixed(stats: DataFrame, prefix: str) -> DataFrame:
        return stats.select("feature", *[F.col(c).alias(f"{prefix}_{c}") for c in stats.columns if c != "feature"])

    return prefixed(lhs, lhs_name).join(prefixed(rhs, rhs_name), "feature", "full_outer")


def cast_to_schema(df: DataFrame, schema: DataFrame) -> DataFrame:
    """Give each column the type its schema row declares; values that do not fit become null."""
    wanted = {"INT": "bigint", "FLOAT": "double", "BYTES": "string"}
    declared = {r["feature"]: r["type"] for r in schema.select("feature", "type").collect()}  # one row per column
    types = dict(df.dtypes)
    casts = {
        c: F.col(c).try_cast(wanted[declared[c]])
        for c in df.columns
        if c in declared and feature_type(types[c]) != declared[c] and not types[c].startswith("array<")
    }
    return df.withColumns(casts) if casts else df
