import math
from datetime import datetime

from pyspark.sql import functions as F

from callwise.functions import scalars as S


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0][0]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.5,), (9.0,)], "x double")
    out = [r[0] for r in df.select(S.clamp(F.col("x"), F.lit(0.0), F.lit(1.0))).collect()]
    assert out == [None, 0.0, 0.5, 1.0]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan"), "a"), (2, 1.0, None)], "id int, x double, s string")
    assert [r["x"] for r in S.nan_to_null(df).orderBy("id").collect()] == [None, 1.0]


def test_dates(spark):
    assert one(spark, S.date_render(F.lit(datetime(2013, 8, 20, 15)))) == "2013-08-20"
    assert one(spark, S.date_render(S.lenient_timestamp(F.lit("not a date")))) is None
    assert one(spark, S.date_render(S.lenient_timestamp(F.lit("2014-02-01")))) == "2014-02-01"


def test_days_since_counts_whole_days(spark):
    ref = "2014-01-03 12:00:00"
    assert one(spark, S.days_since(F.lit("2014-01-01 12:00:00").cast("timestamp"), ref)) == 2
    assert one(spark, S.days_since(F.lit("2014-01-01 12:00:01").cast("timestamp"), ref)) == 1
    # a later time counts down, as a floor
    assert one(spark, S.days_since(F.lit("2014-01-03 12:00:01").cast("timestamp"), ref)) == -1
    assert one(spark, S.days_since(F.lit(None).cast("timestamp"), ref)) is None


def test_threshold_includes_the_limit(spark):
    df = spark.createDataFrame([(0.529999,), (0.53,), (0.9,)], "p double")
    assert [r[0] for r in df.select(S.threshold_classify(F.col("p"))).collect()] == [0, 1, 1]


def test_linear_logistic(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    got = df.select(S.linear_logistic(-1.0, {"a": 0.5, "b": 0.25})).collect()[0][0]
    assert math.isclose(got, 1 / (1 + math.exp(-0.75)))


def test_literals_are_sql_safe(spark):
    for v in ("it's", "back\\slash", "line\nbreak", 7, -1.5, 1e300, True, None):
        assert spark.sql(f"SELECT {S.literal(v)}").collect()[0][0] == v
    assert spark.sql(f"SELECT 1 AS {S.ident('odd `name`')}").columns == ["odd `name`"]
