"""Statistics kept per day and merged for any span, so that earlier days are never read again.

Two tables hold the state of a day. Both are small beside the data and merge by adding up:

    moments  (day, feature, n, missing, zeros, mean, m2, lo, hi, distinct, spread): one row per day and feature;
             ``distinct`` is a HyperLogLog and ``spread`` a KLL sketch, the rest is exact
    counts   (day, feature, value, n): a row per bucket between fixed edges (numbers) or per value (texts)

NaN counts as missing. Rows without a day belong to no span and are left out. An empty table gives empty states.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from callwise.functions.scalars import ident, literal, nan_to_null
from callwise.operators.stats import tall

SKETCH_LG_K = 12  # HyperLogLog with 4,096 registers: a standard error of about 1.6 %
KLL_K = 400  # KLL: a rank error of about 0.7 %


def even_edges(df: DataFrame, cols: Sequence[str], buckets: int = 10) -> dict[str, list[float]]:
    """``buckets + 1`` evenly spaced edges from minimum to maximum of each column, to be fixed once and kept for all days.

    A column without values gets no edges; all its later values share one bucket.
    """
    df = nan_to_null(df, cols)
    ends = df.agg(*[F.expr(f"{f}(CAST({ident(c)} AS DOUBLE)) AS {f}_{i}") for i, c in enumerate(cols) for f in ("min", "max")]).first()
    edges = {}
    for i, c in enumerate(cols):
        lo, hi = ends[f"min_{i}"], ends[f"max_{i}"]
        edges[c] = [] if lo is None else [lo] if lo == hi else [lo + b * ((hi - lo) / buckets) for b in range(buckets)] + [hi]
    return edges


def day_moments(df: DataFrame, day: str, numeric: Sequence[str], text: Sequence[str] = ()) -> DataFrame:
    """The ``moments`` of every day in ``df`` from one aggregation over all columns."""
    df = nan_to_null(df, numeric).filter(F.col(day).isNotNull())
    aggs, entries = ["count(*) AS rows"], []
    for i, c in enumerate([*numeric, *text]):
        v, is_number = ident(c), i < len(numeric)
        aggs += [f"count({v}) AS n_{i}", f"hll_sketch_agg(CAST({v} AS STRING), {SKETCH_LG_K}) AS d_{i}"]
        if is_number:
            x = f"CAST({v} AS DOUBLE)"
            aggs += [f"count(CASE WHEN {x} = 0 THEN 1 END) AS z_{i}", f"avg({x}) AS m_{i}", f"var_pop({x}) AS v_{i}"]
            aggs += [f"min({x}) AS lo_{i}", f"max({x}) AS hi_{i}", f"kll_sketch_agg_double({x}, {KLL_K}) AS s_{i}"]
        number = lambda c: c if is_number else "CAST(NULL AS DOUBLE)"  # noqa: B023, E731
        entries.append(
            f"named_struct('feature', {literal(c)}, 'n', n_{i}, 'missing', rows - n_{i}, "
            f"'zeros', {f'z_{i}' if is_number else 'CAST(NULL AS BIGINT)'}, 'mean', {number(f'm_{i}')}, 'm2', {number(f'v_{i} * n_{i}')}, "
            f"'lo', {number(f'lo_{i}')}, 'hi', {number(f'hi_{i}')}, 'distinct', d_{i}, "
            f"'spread', {f's_{i}' if is_number else 'CAST(NULL AS BINARY)'})"
        )
    daily = df.withColumn("_day", F.col(day).cast("date")).groupBy(F.col("_day").alias("day")).agg(*map(F.expr, aggs))
    return tall(daily, ["day"], entries)


def day_counts(df: DataFrame, day: str, edges: Mapping[str, Sequence[float]], text: Sequence[str] = ()) -> DataFrame:
    """The ``counts`` of every day in ``df``. A number counts in the bucket whose number is the count of edges not above
    it: 0 lies below all edges, and days with values outside the edges stay comparable."""
    df = nan_to_null(df, list(edges)).filter(F.col(day).isNotNull())
    entries = []
    for c, cuts in edges.items():
        v = f"CAST({ident(c)} AS DOUBLE)"
        below = f"size(filter(array({', '.join(literal(float(e)) for e in cuts)}), e -> e <= {v}))" if cuts else "0"
        entries.append(f"named_struct('feature', {literal(c)}, 'value', CASE WHEN {v} IS NOT NULL THEN CAST({below} AS STRING) END)")
    entries += [f"named_struct('feature', {literal(c)}, 'value', CAST({ident(c)} AS STRING))" for c in text]
    dated = df.withColumn("_day", F.col(day).cast("date"))
    values = tall(dated, ["_day"], entries).filter("value IS NOT NULL")
    return values.groupBy(F.col("_day").alias("day"), "feature", "value").agg(F.count("*").alias("n"))


def save_days(states: DataFrame, path: str) -> None:
    """Write the days in ``states`` to a table partitioned by day; days that are there already are replaced, others stay."""
    states.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))


def merge_moments(moments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One state per feature (and per value of ``by``, such as a week) for all its days, again mergeable.

    Squared deviations are moved to the common mean before they are added, so no digits are lost between days far apart.
    """
    # a window holds one row per day of a feature
    days = Window.partitionBy(*by, "feature")
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(days), F.sum(F.when(F.col("mean").isNotNull(), F.col("n"))).over(days))
    moved = moments.withColumn("_mean", mean).withColumn("_m2", F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) ** 2)
    return moved.groupBy(*by, "feature").agg(
        *[F.sum(c).alias(c) for c in ("n", "missing", "zeros")],
        F.first("_mean").alias("mean"),
        F.sum("_m2").alias("m2"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.when(F.count("spread") > 0, F.kll_merge_agg_double("spread")).alias("spread"),
    )


def span_statistics(merged: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Statistics of merged states: counts, mean, population deviation, zeros, minimum and maximum are exact; ``unique_est``
    and ``quantiles_est`` come from the sketches (null for texts and for columns without a number)."""
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    by = [c for c in merged.columns if c not in STATE]
    return merged.select(
        *by, "feature", "n", "missing", "zeros", "mean", F.sqrt(F.col("m2") / F.when(F.col("m2").isNotNull(), F.col("n"))).alias("std_dev"),
        F.col("lo").alias("min"), F.col("hi").alias("max"), F.hll_sketch_estimate("distinct").alias("unique_est"),
        F.when(F.col("mean").isNotNull(), F.kll_sketch_get_quantile_double("spread", ranks)).alias("quantiles_est"),
    )


STATE = ("feature", "n", "missing", "zeros", "mean", "m2", "lo", "hi", "distinct", "spread")


def _distances(sides: DataFrame, at: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Distance of the counts ``p`` and ``q``: Jensen-Shannon divergence (base 2) of numbers, largest gap of texts."""
    cells = sides.groupBy(*at, "feature", "value").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    totals = cells.groupBy(*at, "feature").agg(F.sum("p").alias("_p"), F.sum("q").alias("_q")).filter("_p > 0 AND _q > 0")
    shares = cells.join(totals, [*at, "feature"]).withColumns({"p": F.col("p") / F.col("_p"), "q": F.col("q") / F.col("_q")})
    mid = (F.col("p") + F.col("q")) / 2
    term = lambda s: F.when(F.col(s) > 0, F.col(s) * F.log2(F.col(s) / mid)).otherwise(0.0)
    distance = F.when(F.col("feature").isin(*numeric), F.sum((term("p") + term("q")) / 2)).otherwise(F.max(F.abs(F.col("p") - F.col("q"))))
    return shares.groupBy(*at, "feature").agg(distance.alias("distance"))


def _side(counts: DataFrame, at: Column | None, is_now: bool) -> DataFrame:
    n, none = F.col("n"), F.lit(0).cast("bigint")
    on = [] if at is None else [at.alias("day")]
    return counts.select(*on, "feature", "value", (none if is_now else n).alias("p"), (n if is_now else none).alias("q"))


def drift_between(counts: DataFrame, earlier: Column, later: Column, numeric: Sequence[str]) -> DataFrame:
    """``(feature, distance)`` of two spans, given as conditions on ``day``. They may overlap. Features that lack values in
    one of them are left out."""
    return _distances(_side(counts.filter(earlier), None, False).unionByName(_side(counts.filter(later), None, True)), [], numeric)


def drift_by_day(counts: DataFrame, numeric: Sequence[str], days: int = 7, gap: int = 0) -> DataFrame:
    """``(day, feature, distance)`` of every day against the ``days`` days that end ``gap`` days before it, all in one job.

    Days without any row before them, or with none of their own, have no distance.
    """
    later = F.explode(F.sequence(F.date_add("day", gap + 1), F.date_add("day", gap + days)))
    return _distances(_side(counts, later, False).unionByName(_side(counts, F.col("day"), True)), ["day"], numeric)
