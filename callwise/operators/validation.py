"""Data validation: each check turns statistics and constraints into rows of anomalies.

Report columns: ``feature, anomaly_type, severity, detail, observed, expected``. The schema has one row per column
of the table, so joins against it are joins of small tables; what is large (the data) is only aggregated.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from callwise.functions.scalars import is_numeric, nan_to_null
from callwise.operators.schema import expected_in
from callwise.operators.stats import cast_to_schema, features_of, profile, value_counts
from callwise.sources.staging import pin

DETAIL_EXAMPLES = 5
DRIFT_BUCKETS = 10


def _report(df: DataFrame, kind: str, severity: str, detail: Column, observed: Column, expected: Column) -> DataFrame:
    return df.select(
        "feature", F.lit(kind).alias("anomaly_type"), F.lit(severity).alias("severity"),
        detail.cast("string").alias("detail"), observed.cast("string").alias("observed"), expected.cast("string").alias("expected"),
    )


def anomaly_type(stats: DataFrame, schema: DataFrame) -> DataFrame:
    found = stats.select("feature", F.col("type").alias("seen")).join(schema.select("feature", "type"), "feature")
    return _report(found.filter(F.col("seen") != F.col("type")), "type", "ERROR", F.lit("unexpected type"), F.col("seen"), F.col("type"))


def anomaly_missing_column(stats: DataFrame, schema: DataFrame, environment: str | None = None) -> DataFrame:
    gone = expected_in(schema, environment).join(stats.select("feature"), "feature", "left_anti")
    return _report(gone, "missing_column", "ERROR", F.lit("column is missing"), F.lit("absent"), F.lit("present"))


def anomaly_new_column(stats: DataFrame, schema: DataFrame, ignore_columns: Sequence[str] = ()) -> DataFrame:
    extra = stats.filter(~F.col("feature").isin(*ignore_columns)) if ignore_columns else stats
    extra = extra.join(schema.select("feature"), "feature", "left_anti")
    return _report(extra, "new_column", "ERROR", F.lit("column is not in the schema"), F.lit("present"), F.lit("absent"))


def anomaly_presence(stats: DataFrame, schema: DataFrame) -> DataFrame:
    joined = stats.select("feature", "num_examples", "num_non_missing").join(
        schema.select("feature", "min_fraction", "min_count"), "feature"
    )
    share = F.coalesce(F.try_divide(F.col("num_non_missing").cast("double"), F.col("num_examples")), F.lit(0.0))
    low = joined.withColumn("share", share).filter(
        (F.col("share") < F.col("min_fraction")) | (F.col("num_non_missing") < F.col("min_count"))
    )
    told = F.when(F.col("share") < F.col("min_fraction"), "too few examples have a value").otherwise("too few values")
    return _report(low, "presence", "ERROR", told, F.col("num_non_missing"), F.col("min_fraction"))


def anomaly_domain(counts: DataFrame, schema: DataFrame) -> DataFrame:
    """Strings outside a closed domain: how many values and rows, with the first few of them as examples."""
    closed = schema.filter(F.col("domain").isNotNull())
    known = closed.select("feature", F.explode("domain").alias("value"))
    strange = counts.join(closed.select("feature"), "feature", "left_semi").join(known, ["feature", "value"], "left_anti")
    order = Window.partitionBy("feature").orderBy(F.col("n").desc(), "value")
    examples = (
        strange.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= DETAIL_EXAMPLES)
        .groupBy("feature")
        .agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("examples"))
    )
    totals = strange.groupBy("feature").agg(F.sum("n").alias("rows"), F.count("*").alias("kinds"))
    found = totals.join(examples, "feature")
    told = F.concat(F.lit("values outside the domain: "), F.col("examples"))
    return _report(found, "domain", "ERROR", told, F.concat_ws(" ", F.col("kinds"), F.lit("values in"), F.col("rows"), F.lit("rows")), F.lit("domain"))


def anomaly_bool(stats: DataFrame, schema: DataFrame) -> DataFrame:
    """Numbers other than 0 and 1 in a bool domain."""
    bad = stats.join(schema.filter("is_bool").select("feature"), "feature").filter((F.col("lo") < 0) | (F.col("hi") > 1))
    seen = F.concat_ws(" to ", F.col("lo").cast("bigint"), F.col("hi").cast("bigint"))
    return _report(bad, "bool", "ERROR", F.lit("values other than 0 and 1"), seen, F.lit("0 to 1"))


def anomaly_shape(stats: DataFrame, schema: DataFrame) -> DataFrame:
    """More or fewer values per cell than the fixed shape allows."""
    odd = stats.join(schema.select("feature", "shape_dim"), "feature").filter(
        (F.col("max_num_values") > F.col("shape_dim")) | (F.col("min_num_values") < F.col("shape_dim"))
    )
    seen = F.concat_ws(" to ", F.col("min_num_values"), F.col("max_num_values"))
    return _report(odd, "shape", "ERROR", F.lit("wrong number of values per cell"), seen, F.col("shape_dim"))


def value_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = value_counts(df, columns)
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))  # one row per column
    return counts.join(F.broadcast(totals), "feature").select("feature", "value", (F.col("n") / F.col("total")).alias("share"))


def linf_distance(lhs: DataFrame, rhs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Largest difference between the shares of one value in the two data sets, per categorical feature."""
    p = value_shares(lhs, columns).withColumnRenamed("share", "p")
    q = value_shares(rhs, columns).withColumnRenamed("share", "q")
    gap = F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("q", F.lit(0.0)))
    return p.join(q, ["feature", "value"], "full_outer").groupBy("feature").agg(F.max(gap).alias("distance"))


def jensen_shannon(lhs: DataFrame, rhs: DataFrame, columns: Sequence[str], buckets: int = DRIFT_BUCKETS) -> DataFrame:
    """Jensen-Shannon divergence (base 2) over equal-width buckets that span both data sets, per numeric feature."""
    def tall(df: DataFrame, side: int) -> DataFrame:
        df = nan_to_null(df, columns)
        entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
        return df.select(F.lit(side).alias("side"), F.inline(entries)).filter(F.col("value").isNotNull())

    both = tall(lhs, 0).unionByName(tall(rhs, 1))
    limits = both.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))  # one row per column
    width = (F.col("hi") - F.col("lo")) / F.lit(buckets)
    place = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(buckets - 1), F.floor((F.col("value") - F.col("lo")) / F.when(F.col("hi") > F.col("lo"), width)).cast("int"))).otherwise(0)
    counts = (
        both.join(F.broadcast(limits), "feature")
        .groupBy("feature", place.alias("bucket"))
        .agg(F.count(F.when(F.col("side") == 0, 1)).alias("a"), F.count(F.when(F.col("side") == 1, 1)).alias("b"))
    )
    w = Window.partitionBy("feature")  # `buckets` rows per feature
    shares = counts.select(
        "feature",
        F.try_divide(F.col("a").cast("double"), F.sum("a").over(w)).alias("p"),
        F.try_divide(F.col("b").cast("double"), F.sum("b").over(w)).alias("q"),
    )
    mid = (F.col("p") + F.col("q")) / 2
    part = F.when(F.col("p") > 0, F.col("p") * F.log2(F.col("p") / mid)).otherwise(0.0) + F.when(
        F.col("q") > 0, F.col("q") * F.log2(F.col("q") / mid)
    ).otherwise(0.0)
    return shares.groupBy("feature").agg((F.sum(part) / 2).alias("distance"))


def _distances(lhs: DataFrame, rhs: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame | None:
    parts = []
    if text:
        parts.append(linf_distance(lhs, rhs, text))
    if numeric:
        parts.append(jensen_shannon(lhs, rhs, numeric))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _compare(lhs: DataFrame, rhs: DataFrame, schema: DataFrame, threshold: str, kind: str, detail: str) -> DataFrame | None:
    on = {r["feature"] for r in schema.filter(F.col(threshold).isNotNull()).select("feature").collect()}  # one row per column
    types = dict(lhs.dtypes)
    cols = [c for c in lhs.columns if c in on and c in rhs.columns]
    numeric = [c for c in cols if is_numeric(types[c])]
    dist = _distances(lhs, rhs, numeric, [c for c in cols if c not in numeric])
    if dist is None:
        return None
    over = dist.join(schema.select("feature", threshold), "feature").filter(F.col("distance") > F.col(threshold))
    return _report(over, kind, "ERROR", F.lit(detail), F.round("distance", 6), F.col(threshold))


def skew(train: DataFrame, serving: DataFrame, schema: DataFrame) -> DataFrame | None:
    """Training against serving. None when the schema sets no skew threshold."""
    return _compare(train, serving, schema, "skew_threshold", "skew", "training and serving differ")


def drift(previous: DataFrame, current: DataFrame, schema: DataFrame) -> DataFrame | None:
    """Previous span against current span. None when the schema sets no drift threshold."""
    return _compare(previous, current, schema, "drift_threshold", "drift", "previous and current span differ")


def validate(
    df: DataFrame,
    schema: DataFrame,
    environment: str | None = None,
    exclude: Sequence[str] = (),
    ignore_columns: Sequence[str] = (),
    serving: DataFrame | None = None,
    previous: DataFrame | None = None,
    types_from_schema: bool = False,
) -> DataFrame:
    """All anomalies of a data set as rows. ``serving`` and ``previous`` add the skew and drift checks."""
    if types_from_schema:
        df = cast_to_schema(df, schema)
    cols = features_of(df, exclude)
    stats, schema = pin(profile(df, cols)), pin(schema)  # one row per column each; seven checks read them
    types = dict(df.dtypes)
    text = [c for c in cols if types[c] == "string"]
    parts = [
        anomaly_type(stats, schema),
        anomaly_missing_column(stats, schema, environment),
        anomaly_new_column(stats, schema, ignore_columns),
        anomaly_presence(stats, schema),
        anomaly_shape(stats, schema),
        anomaly_bool(stats, schema),
    ]
    closed = {r["feature"] for r in schema.filter("domain IS NOT NULL").select("feature").collect()}  # a local relation
    if closed.intersection(text):  # values of open columns are not counted
        parts.append(anomaly_domain(value_counts(df, [c for c in text if c in closed]), schema))
    if serving is not None:
        parts.append(skew(df, serving, schema))
    if previous is not None:
        parts.append(drift(previous, df, schema))
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def gate(report: DataFrame) -> bool:
    """Warn when there is any anomaly and say so; the run goes on."""
    bad = not report.isEmpty()
    if bad:
        warnings.warn("anomalies in the data, see the report", UserWarning, stacklevel=2)
    return bad
