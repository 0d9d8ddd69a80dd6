import warnings

import pytest
from pyspark.sql import functions as F

from callwise.operators import schema as SC
from callwise.operators import stats as ST
from callwise.operators import validation as V


@pytest.fixture(scope="module")
def train(spark):
    rows = [(i, 1950 + i, ["Basic", "Master", "PhD"][i % 3], 100.5 * i, f"2013-01-{i + 1:02d}", i % 2, i % 2) for i in range(20)]
    return spark.createDataFrame(rows, "Id long, Year int, Education string, Income double, Day string, Complain int, Response int")


@pytest.fixture(scope="module")
def schema(train):
    return SC.exclude_from(SC.infer_schema(train, ["Id"], domain_limit=10), "Response", "SERVING")


def kinds(report):
    return sorted((r["feature"], r["anomaly_type"]) for r in report.collect())


def test_inferred_constraints(schema):
    rows = {r["feature"]: r for r in schema.collect()}
    assert set(rows) == {"Year", "Education", "Income", "Day", "Complain", "Response"}
    assert rows["Education"]["domain"] == ["Basic", "Master", "PhD"] and rows["Education"]["type"] == "BYTES"
    assert rows["Day"]["domain"] is None  # 20 values, over the limit
    assert rows["Complain"]["is_bool"] and not rows["Year"]["is_bool"]
    assert rows["Income"]["type"] == "FLOAT" and rows["Income"]["min_fraction"] == 1.0 and rows["Income"]["shape_dim"] == 1
    assert rows["Response"]["not_in_environment"] == ["SERVING"]


def test_schema_round_trip(spark, schema, tmp_path):
    SC.write_schema(schema, str(tmp_path / "schema"))
    assert SC.read_schema(spark, str(tmp_path / "schema")).orderBy("feature").collect() == schema.orderBy("feature").collect()


def test_clean_data_has_no_anomaly(train, schema):
    assert kinds(V.validate(train, schema, "TRAINING", exclude=["Id"])) == []
    assert kinds(V.validate(train.drop("Response"), schema, "SERVING", exclude=["Id"])) == []


FAULTS = {
    "type": (lambda df: df.withColumn("Year", F.concat(F.lit("y"), "Year")), ("Year", "type")),
    "missing": (lambda df: df.drop("Income"), ("Income", "missing_column")),
    "new": (lambda df: df.withColumn("success_rate_v0.0.1", F.lit(0.5)), ("success_rate_v0.0.1", "new_column")),
    "presence": (lambda df: df.withColumn("Income", F.when(F.col("Id") > 3, F.col("Income"))), ("Income", "presence")),
    "nan": (lambda df: df.withColumn("Income", F.when(F.col("Id") > 3, F.col("Income")).otherwise(float("nan"))), ("Income", "presence")),
    "domain": (lambda df: df.withColumn("Education", F.when(F.col("Id") > 3, F.col("Education")).otherwise("2n Cycle")), ("Education", "domain")),
    "bool": (lambda df: df.withColumn("Complain", F.col("Complain") + 1), ("Complain", "bool")),
    "shape": (lambda df: df.withColumn("Year", F.array("Year", "Year")), ("Year", "shape")),
}


@pytest.mark.parametrize("fault", FAULTS)
def test_each_fault_is_found_and_nothing_else(train, schema, fault):
    spoil, expected = FAULTS[fault]
    assert kinds(V.validate(spoil(train), schema, "TRAINING", exclude=["Id"])) == [expected]


def test_label_missing_in_training_is_an_anomaly(train, schema):
    assert kinds(V.validate(train.drop("Response"), schema, "TRAINING", exclude=["Id"])) == [("Response", "missing_column")]


def test_score_columns_can_be_exempted(train, schema):
    scored = train.withColumn("rate", F.lit(0.5))
    assert kinds(V.validate(scored, schema, "TRAINING", exclude=["Id"], ignore_columns=["rate"])) == []


def test_types_from_schema(train, schema):
    text = train.select("Id", *[F.col(c).cast("string").alias(c) for c in train.columns if c != "Id"])
    assert kinds(V.validate(text, schema, "TRAINING", exclude=["Id"], types_from_schema=True)) == []


def test_gate_warns_and_goes_on(train, schema):
    with pytest.warns(UserWarning):
        assert V.gate(V.validate(train.drop("Income"), schema, "TRAINING", exclude=["Id"]))
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        assert not V.gate(V.validate(train, schema, "TRAINING", exclude=["Id"]))


def test_skew_and_drift_are_off_without_threshold(train, schema):
    assert V.skew(train, train, schema) is None and V.drift(train, train, schema) is None


def test_skew_and_drift_thresholds(train, schema):
    on = SC.with_thresholds(SC.with_thresholds(schema, "Education", skew=0.01), "Income", drift=0.01)
    shifted = train.filter("Id > 9").withColumn("Education", F.lit("PhD"))
    report = V.validate(train, on, "TRAINING", exclude=["Id"], serving=shifted, previous=shifted)
    assert kinds(report) == [("Education", "skew"), ("Income", "drift")]


def test_distances_by_hand(spark):
    a = spark.createDataFrame([("x", 0.0), ("x", 0.0), ("y", 10.0), ("y", 10.0)], "s string, v double")
    b = spark.createDataFrame([("x", 0.0), ("z", 0.0), ("z", 0.0), ("z", 0.0)], "s string, v double")
    assert V.linf_distance(a, b, ["s"]).collect()[0]["distance"] == 0.75
    # (1/2, 1/2) against (1, 0)
    assert V.jensen_shannon(a, b, ["v"]).collect()[0]["distance"] == pytest.approx(0.311278, abs=1e-6)
    assert V.jensen_shannon(a, a, ["v"]).collect()[0]["distance"] == 0.0


def test_statistics_by_hand(spark):
    df = spark.createDataFrame([(1, "aa", [1, 2]), (0, "b", [3]), (None, "b", None), (5, None, [])], "n int, s string, l array<int>")
    common = {r["feature"]: r for r in ST.stats_common(df, ["n", "s", "l"]).collect()}
    assert (common["n"]["num_non_missing"], common["n"]["num_missing"], common["n"]["type"]) == (3, 1, "INT")
    assert (common["l"]["min_num_values"], common["l"]["max_num_values"], common["l"]["tot_num_values"]) == (0, 2, 3)
    n = ST.stats_numeric(df, ["n"]).collect()[0]
    assert (n["mean"], n["median"], n["min"], n["max"], n["num_zeros"]) == (2.0, 1.0, 0.0, 5.0, 1)
    s = ST.stats_string(df, ["s"]).collect()[0]
    assert (s["num_unique"], s["avg_length"], s["top_value"], s["top_count"]) == (2, 4 / 3, "b", 2)
    full = ST.feature_stats(df)
    assert full.count() == 3 and "median" in full.columns and "top_value" in full.columns


def test_histograms(spark):
    df = spark.createDataFrame([(float(v), 1.0) for v in [0, 1, 1, 9, 10]], "x double, c double")
    hist = [tuple(r) for r in ST.hist_equal_width(df, ["x", "c"]).orderBy("feature", "bucket").select("feature", "bucket", "n").collect()]
    assert [h[2] for h in hist if h[0] == "x"] == [1, 2, 0, 0, 0, 0, 0, 0, 0, 2]
    assert [h[2] for h in hist if h[0] == "c"] == [5] + [0] * 9
    edges = ST.hist_quantiles(df, ["x"], buckets=2).orderBy("bucket").collect()
    assert [(e["low"], e["high"]) for e in edges] == [(0.0, 1.0), (1.0, 10.0)]


def test_top_values_tie_and_limit(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), ("c",)], "s string")
    assert [(r["rank"], r["value"]) for r in ST.top_values(df, ["s"], 2).orderBy("rank").collect()] == [(1, "a"), (2, "b")]


def test_compare_keeps_one_sided_features(spark):
    a, b = (spark.createDataFrame([(f, 1.0)], "feature string, mean double") for f in ("x", "y"))
    assert sorted((r["feature"], r["a_mean"], r["b_mean"]) for r in ST.compare_stats(a, b, "a", "b").collect()) == [("x", 1.0, None), ("y", None, 1.0)]
