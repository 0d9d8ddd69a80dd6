import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from callwise.operators import span_states as SS
from callwise.operators.stats import stats_numeric
from callwise.operators.validation import linf_distance


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("day", F.to_date("ts")).cache()


def test_merged_days_equal_one_pass(spark, events):
    merged = SS.merge_moments(SS.day_moments(events, "day", ["value", "user_id"], ["event_type"]))
    got = {r["feature"]: r for r in SS.span_statistics(merged).collect()}
    for r in stats_numeric(events, ["value", "user_id"]).collect():
        g = got[r["feature"]]
        assert (g["min"], g["max"], g["zeros"]) == (r["min"], r["max"], r["num_zeros"])
        assert math.isclose(g["mean"], r["mean"], rel_tol=1e-12) and math.isclose(g["std_dev"], r["std_dev"], rel_tol=1e-10)
    assert got["event_type"]["mean"] is None and got["event_type"]["quantiles_est"] is None
    assert got["event_type"]["unique_est"] == events.select("event_type").distinct().count()


def test_sketches_stay_within_their_error(spark):
    days = spark.range(200_000).select(F.expr("date_add(date'2024-01-01', int(id % 30))").alias("day"), F.col("id").alias("v"))
    row = SS.span_statistics(SS.merge_moments(SS.day_moments(days, "day", ["v"])), [0.1, 0.5, 0.9]).first()
    assert abs(row["unique_est"] - 200_000) < 200_000 * 0.05
    for p, q in zip([0.1, 0.5, 0.9], row["quantiles_est"]):
        assert abs(q / 200_000 - p) < 0.02


def test_merging_in_steps_is_the_same(spark, events):
    moments = SS.day_moments(events, "day", ["value"]).withColumn("week", F.date_trunc("week", "day").cast("date"))
    steps = SS.merge_moments(SS.merge_moments(moments, ["week"])).first()
    at_once = SS.merge_moments(moments).first()
    assert steps["n"] == at_once["n"] and math.isclose(steps["m2"], at_once["m2"], rel_tol=1e-12)


def test_far_means_lose_no_digits(spark):
    rows = [(dt.date(2024, 1, 1), 1e9 + i) for i in range(10)] + [(dt.date(2024, 1, 2), 1e9 + 5 + i) for i in range(10)]
    row = SS.merge_moments(SS.day_moments(spark.createDataFrame(rows, "day date, v double"), "day", ["v"])).first()
    mean = sum(v for _, v in rows) / 20
    assert math.isclose(row["m2"], sum((v - mean) ** 2 for _, v in rows), rel_tol=1e-9)


def test_missing_values_and_days(spark):
    rows = [(dt.date(2024, 1, 1), float("nan"), None), (dt.date(2024, 1, 1), None, "a"), (None, 5.0, "b")]
    df = spark.createDataFrame(rows, "day date, v double, t string")
    got = {r["feature"]: r for r in SS.span_statistics(SS.merge_moments(SS.day_moments(df, "day", ["v"], ["t"]))).collect()}
    assert (got["v"]["n"], got["v"]["missing"], got["v"]["mean"], got["v"]["quantiles_est"]) == (0, 2, None, None)
    assert (got["t"]["n"], got["t"]["missing"]) == (1, 1)
    edges = SS.even_edges(df, ["v"])
    assert [tuple(r) for r in SS.day_counts(df, "day", edges, ["t"]).collect()] == [(dt.date(2024, 1, 1), "t", "a", 1)]
    empty = df.limit(0)
    assert SS.merge_moments(SS.day_moments(empty, "day", ["v"], ["t"])).count() == 0
    assert SS.drift_by_day(SS.day_counts(empty, "day", SS.even_edges(empty, ["v"]), ["t"]), ["v"]).count() == 0


def test_values_outside_the_edges_have_buckets_of_their_own(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), v) for v in (-1.0, 0.0, 0.9, 1.0, 2.0, 7.0)], "day date, v double")
    counts = {r["value"]: r["n"] for r in SS.day_counts(df, "day", {"v": [0.0, 1.0, 2.0]}).collect()}
    assert counts == {"0": 1, "1": 2, "2": 1, "3": 2}


def test_drift_of_spans_equals_the_data_itself(spark, events):
    cut = dt.date(2024, 1, 16)
    counts = SS.day_counts(events, "day", SS.even_edges(events, ["value"]), ["event_type", "props"])
    got = {r[0]: r[1] for r in SS.drift_between(counts, F.col("day") < cut, F.col("day") >= cut, ["value"]).collect()}
    want = linf_distance(events.filter(F.col("day") < cut), events.filter(F.col("day") >= cut), ["event_type", "props"])
    for feature, distance in want.collect():
        assert math.isclose(got[feature], distance, rel_tol=1e-9)
    assert 0 <= got["value"] <= 1


def test_drift_by_day_equals_each_pair_of_spans(spark, events):
    counts = SS.day_counts(events, "day", SS.even_edges(events, ["value"]), ["event_type"]).cache()
    got = {(r["day"], r["feature"]): r["distance"] for r in SS.drift_by_day(counts, ["value"], days=3, gap=1).collect()}
    for day in (dt.date(2024, 1, 4), dt.date(2024, 1, 12)):
        before = F.col("day").between(day - dt.timedelta(4), day - dt.timedelta(2))
        for feature, distance in SS.drift_between(counts, before, F.col("day") == day, ["value"]).collect():
            assert math.isclose(got[day, feature], distance, rel_tol=1e-9)
    first = min(r["day"] for r in counts.select("day").collect())
    assert (first, "value") not in got


def test_a_day_written_again_is_replaced(spark, events, tmp_path):
    path = str(tmp_path / "moments")
    moments = SS.day_moments(events, "day", ["value"])
    SS.save_days(moments, path)
    before = SS.read_days(spark, path).agg(F.sum("n"), F.count("*")).first()
    again = events.filter(F.col("day") == dt.date(2024, 1, 5))
    SS.save_days(SS.day_moments(again.unionByName(again), "day", ["value"]), path)
    after = SS.read_days(spark, path).agg(F.sum("n"), F.count("*")).first()
    assert after[1] == before[1] and after[0] == before[0] + again.count()
