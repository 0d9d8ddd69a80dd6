import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from callwise.operators import heavy as H
from callwise.operators.stats import top_values


def table(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


@pytest.fixture(scope="module")
def zipf(spark):
    """Values 0 to 29 occur 3,000 times and more, 200,000 others once."""
    hot = spark.range(30).select(F.explode(F.sequence(F.lit(1), 3000 + 100 * F.col("id"))).alias("_"), F.col("id").alias("v")).select("v")
    return hot.unionByName(spark.range(1000, 201_000).select(F.col("id").alias("v"))).withColumn("s", F.concat(F.lit("x"), F.col("v").cast("string")))


def test_frequent_values_among_many(spark, zipf):
    ranked = H.settled_values(zipf, ["v", "s"], 10)
    assert ranked.filter("NOT settled").count() == 0
    assert table(ranked.drop("settled")) == table(top_values(zipf, ["v", "s"], 10))


def test_a_flat_column_is_counted_in_full(spark):
    flat = spark.range(50_000).select(F.col("id").alias("v"), (F.col("id") % 25_000).alias("w"))
    assert H.settled_values(flat, ["v", "w"], 5, tracked=1000).filter("settled").count() == 0
    assert table(H.heavy_values(flat, ["v", "w"], 5, tracked=1000)) == table(top_values(flat, ["v", "w"], 5))


def test_groups_are_settled_one_by_one(spark, zipf):
    flat = spark.range(50_000).select(F.lit(None).cast("string").alias("g"), F.col("id").alias("v"))
    both = zipf.select(F.lit("zipf").alias("g"), "v").unionByName(flat)
    states = {(r["g"], r["settled"]) for r in H.settled_values(both, ["v"], 10, ["g"], tracked=1000).collect()}
    assert states == {("zipf", True), (None, False)}
    assert table(H.heavy_values(both, ["v"], 10, ["g"], tracked=1000)) == table(top_values(both, ["v"], 10, ["g"]))


def test_missing_values_and_empty_tables(spark):
    df = spark.createDataFrame([(float("nan"), None), (None, None), (0.5, None)], "v double, t string")
    assert table(H.heavy_values(df, ["v", "t"], 3)) == [("v", "1", "0.5", "1")]
    assert H.heavy_values(df.limit(0), ["v", "t"], 3).count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 40)), max_size=120), k=st.integers(1, 6))
def test_same_as_full_counts(spark, values, k):
    df = spark.createDataFrame([(v, None if v is None else f"s{v % 7}") for v in values], "v bigint, t string")
    assert table(H.heavy_values(df, ["v", "t"], k, tracked=8)) == table(top_values(df, ["v", "t"], k))
