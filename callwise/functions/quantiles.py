"""Exact quantiles of columns of any size, for any number of groups, in two scans.

The first scan sketches a narrow bracket around each wanted rank. The ends of all brackets of a (group, feature) cut its
values into a few segments. The second scan counts: values inside a bracket by themselves, all others by their segment
only, so each value is one row whatever the number of ranks. Running sums over the segments find the one that holds a
rank. While a segment has more distinct values than one task should sort, it is cut into sub-buckets and narrowed to the
one with the rank. The result is exact: all counts are exact, and a bracket that missed its rank would raise an error,
never give another value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from callwise.functions.scalars import ident, literal, nan_to_null
from callwise.sources.staging import hold, stage

SKETCH_ACCURACY = 2_000
BRACKET_SLACK = 1e-3
SUB_BUCKETS = 1_024
SORT_ROWS = 100_000  # distinct values that one task sorts


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), sort_rows: int = SORT_ROWS) -> DataFrame:
    """Linearly interpolated quantiles as rows ``(by..., feature, prob, value)``, nulls and NaN left out.

    A column without values gives rows with a null value, in every group of ``by``.
    """
    df = nan_to_null(df, cols)
    groups = [f"_g{i}" for i in range(len(by))]
    near = ", ".join(f"{q!r}D" for p in probs for q in (max(0.0, p - BRACKET_SLACK), min(1.0, p + BRACKET_SLACK)))
    aggs, parts = [], []
    for i, c in enumerate(cols):
        v = f"CAST({ident(c)} AS DOUBLE)"
        aggs += [f"count({ident(c)}) AS n_{i}", f"min({v}) AS min_{i}", f"max({v}) AS max_{i}"]
        aggs.append(f"percentile_approx({v}, array({near}), {SKETCH_ACCURACY}) AS near_{i}")
        parts.append(f"named_struct('feature', {literal(c)}, 'n', n_{i}, 'low', min_{i}, 'high', max_{i}, 'near', near_{i})")
    named = [F.col(b).alias(g) for b, g in zip(by, groups, strict=True)]
    heads = df.groupBy(*named).agg(*map(F.expr, aggs)).select(*groups, F.expr(f"inline(array({', '.join(parts)}))"))

    def bracket(k: int, p: float) -> str:
        # the ends of the order need no search; where a bracket would be narrower than its ranks it is the whole range
        ends = ("low", "low") if p <= 0 else ("high", "high") if p >= 1 else tuple(
            f"IF(n * {BRACKET_SLACK}D >= 4, near[{2 * k + i}], {plain})" for i, plain in enumerate(("low", "high"))
        )
        return f"named_struct('prob', {float(p)!r}D, 'pos', {float(p)!r}D * (n - 1), 'lo', {ends[0]}, 'hi', {ends[1]})"

    brackets = f"array({', '.join(bracket(k, p) for k, p in enumerate(probs))})"
    heads = heads.select(*groups, "feature", "n", F.expr(brackets).alias("brackets"), F.monotonically_increasing_id().alias("head"))
    edges = F.expr("array_sort(array_distinct(flatten(transform(brackets, b -> array(b.lo, b.hi)))))").alias("edges")
    heads = hold(heads.select("*", edges), "quantile_heads")

    entries = ", ".join(f"named_struct('feature', {literal(c)}, 'value', CAST({ident(c)} AS DOUBLE))" for c in cols)
    tall = df.select(*named, F.expr(f"inline(array({entries}))")).filter("value IS NOT NULL")
    same = F.col("feature") == F.col("_f")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    cuts = heads.select(*[F.col(g).alias(f"_{g}") for g in groups], F.col("feature").alias("_f"), "head", "brackets", "edges")
    placed = tall.join(cuts, same).select(
        "head",
        F.expr("size(filter(edges, e -> e <= value))").alias("segment"),
        F.expr("IF(exists(brackets, b -> value >= b.lo AND value <= b.hi), value, NULL)").alias("value"),
    )
    # inside a segment, values outside all brackets lie above its lower edge, so null comes last
    counted = stage(placed.groupBy("head", "segment", "value").agg(F.count("*").alias("m")), "quantile_counts")
    upto = Window.partitionBy("head").orderBy("segment").rowsBetween(Window.unboundedPreceding, 0)  # two rows per rank at most
    segments = counted.groupBy("head", "segment").agg(F.sum("m").alias("m"), F.count("value").alias("rows"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    segments = segments.withColumn("before", F.sum("m").over(upto) - F.col("m"))
    wanted = heads.filter("n > 0").select("head", F.expr("inline(brackets)")).select("head", "prob", "pos", F.expr("explode(array_distinct(array(floor(pos), ceil(pos))))").alias("rank"))
    ranks = wanted.select("head", "rank").distinct()
    state = hold(ranks.join(segments, "head").filter("rank >= before AND rank < before + m").drop("m"), "quantile_state")
    while (state.agg(F.max(F.when(F.col("hi") > F.col("lo"), F.col("rows")))).first()[0] or 0) > sort_rows:
        state = _narrowed(counted, state)
    within = counted.join(state.drop("rows"), ["head", "segment"]).filter("value >= lo AND value <= hi")
    order = Window.partitionBy("head", "rank").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)  # sort_rows rows at most
    summed = within.withColumn("upto", F.col("before") + F.sum("m").over(order)).filter("upto > rank AND upto - m <= rank")
    hits = wanted.join(summed.select("head", "rank", "value"), ["head", "rank"], "left")
    missing = F.raise_error(F.lit("a quantile bracket missed its rank; raise BRACKET_SLACK")).cast("double")
    hits = hits.withColumn("value", F.coalesce("value", missing))
    pair = hits.groupBy("head", "prob").agg(F.min("value").alias("a"), F.max("value").alias("b"), F.max(F.expr("pos - floor(pos)")).alias("part"))
    pair = pair.select("head", "prob", F.expr("a + (b - a) * part").alias("value"))
    listed = heads.select(*[F.col(g).alias(b) for g, b in zip(groups, by, strict=True)], "head", "feature", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    return listed.join(pair, ["head", "prob"], "left").select(*by, "feature", "prob", "value")


def _narrowed(counted: DataFrame, state: DataFrame) -> DataFrame:
    """The sub-bucket of each segment that holds its rank, as a new segment between values that occur."""
    share = "CASE WHEN hi > lo THEN (value - lo) / (hi - lo) ELSE 0D END"
    sub = F.expr(f"CAST(least({SUB_BUCKETS - 1}, floor(({share}) * {SUB_BUCKETS})) AS INT)").alias("sub")
    cut = counted.join(state.drop("rows"), ["head", "segment"]).filter("value >= lo AND value <= hi")
    counts = cut.groupBy("head", "segment", "rank", "before", sub).agg(F.sum("m").alias("m"), F.count("*").alias("rows"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    upto = Window.partitionBy("head", "rank").orderBy("sub").rowsBetween(Window.unboundedPreceding, 0)  # SUB_BUCKETS rows at most
    summed = counts.withColumn("upto", F.col("before") + F.sum("m").over(upto)).filter("upto > rank AND upto - m <= rank")
    return hold(summed.select("head", "segment", "rank", (F.col("upto") - F.col("m")).alias("before"), "lo", "hi", "rows"), "quantile_state")
