"""Campaign tables derived from the driver's sales and event tables.

Label: the customer ordered on or after the cut date. Features use earlier orders only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from callwise.functions.scalars import linear_logistic
from callwise.operators.features import iqr_winsorizer, MedianImputer
from callwise.sources.staging import stage

KEY = "id"
LABEL = "response"
NUMERIC = ["income", "n_orders", "n_urgent", "n_high", "n_low", "spend_a", "spend_n", "spend_r"]
CATEGORICAL = ["segment", "nation", "complain"]
FEATURES = NUMERIC + CATEGORICAL
CUT = "2001-07-01 00:00:00"
SPAN_CUT = "2024-01-16 00:00:00"

# fixed coefficients of the scoring queries
INTERCEPT = -1.0
WEIGHTS = {"income": 0.0001, "n_orders": 0.05, "n_urgent": -0.2, "n_high": 0.15, "n_low": 0.1, "spend_a": 0.000002, "spend_n": -0.000003, "spend_r": 0.000001}
OLD_INTERCEPT = -0.5
OLD_WEIGHTS = {"income": 0.00005, "n_orders": 0.02, "spend_n": 0.000001}

_staged: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def campaign_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with planned nulls in ``segment`` and ``income``.

    Line items are summed per order before the join, so the join carries one row per order, and all order features
    and the label come from one grouping by customer.
    """
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    spend = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_extendedprice")).otherwise(0.0))
    per_order = lines.groupBy("l_orderkey").agg(spend("A").alias("a"), spend("N").alias("n"), spend("R").alias("r"))
    early = F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")
    priority = lambda p: F.count(F.when(early & (F.col("o_orderpriority") == p), 1)).cast("int")
    sums = lambda c: F.sum(F.when(early, F.coalesce(c, F.lit(0.0))))
    per_customer = (
        orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count(F.when(early, 1)).cast("int").alias("n_orders"),
            F.max(F.when(early, F.col("o_orderdate"))).alias("last_order"),
            priority("1-URGENT").alias("n_urgent"),
            priority("2-HIGH").alias("n_high"),
            priority("5-LOW").alias("n_low"),
            sums("a").alias("spend_a"),
            sums("n").alias("spend_n"),
            sums("r").alias("spend_r"),
            F.max((~early).cast("int")).alias("response"),
        )
    )
    complaints = table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select(F.col("user_id").alias("c_custkey")).distinct()
    complaints = complaints.withColumn("complain", F.lit(1))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    customer = table(spark, sf_dir, "customer")
    zero = lambda c: F.coalesce(c, F.lit(0))
    money = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 2)
    return (
        customer.join(nation, "c_nationkey")
        .join(per_customer, "c_custkey", "left")
        .join(complaints, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.when(F.col("c_custkey") % 50 != 7, F.col("c_mktsegment")).alias("segment"),
            "nation",
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("income"),
            F.col("last_order").cast("date").alias("last_order"),
            *[zero(c).alias(c) for c in ("n_orders", "n_urgent", "n_high", "n_low")],
            *[money(c).alias(c) for c in ("spend_a", "spend_n", "spend_r")],
            zero("complain").alias("complain"),
            zero("response").alias("response"),
        )
    )


def campaign_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table as the flows see it: written once per application and read back as a stored table."""
    return _once(spark, sf_dir, "campaign", lambda: campaign_base(spark, sf_dir))


def campaign_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, clamped and imputed numbers as doubles, label; stored once per application."""

    def build() -> DataFrame:
        base = campaign_table(spark, sf_dir).select(KEY, *NUMERIC, LABEL)
        clamped = iqr_winsorizer(NUMERIC).transform(base)
        return MedianImputer(cols=NUMERIC).fit(base).transform(clamped)

    return _once(spark, sf_dir, "features", build)


def campaign_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, label, score, old_score, n_orders, n_low)``: fixed coefficients, scores rounded so that ties occur."""
    features = campaign_features(spark, sf_dir)
    return features.select(
        KEY,
        F.col(LABEL).alias("label"),
        F.round(linear_logistic(INTERCEPT, WEIGHTS), 3).alias("score"),
        F.round(linear_logistic(OLD_INTERCEPT, OLD_WEIGHTS), 3).alias("old_score"),
        "n_orders",
        "n_low",
    )


def document_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: language, source, size in characters and words, two binary labels."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars", (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1).cast("int").alias("n_words")
    )
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select("doc_id", "lang", "source", "n_chars", "n_words", "toxic", "quality")


def event_spans(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Previous and current span of the events; the current one lost its error events."""
    events = table(spark, sf_dir, "events")
    cut = F.lit(SPAN_CUT).cast("timestamp_ntz")
    return events.filter(F.col("ts") < cut), events.filter((F.col("ts") >= cut) & (F.col("event_type") != "error"))


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        _staged[key] = stage(build(), name)
    return _staged[key]
