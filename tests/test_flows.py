import pytest
from pyspark.sql import functions as F

from callwise.operators import models as MM
from callwise.operators import schema as SC
from callwise.operators import serving as SV
from callwise.operators import splits as SP
from callwise.operators import tracking as TR
from callwise.operators.resampling import Smoted
from callwise.operators.relational import dropna_any
from callwise.plans import flows
from callwise.sources import campaign as C
from callwise.sources import tables as T


@pytest.fixture(scope="module")
def base(spark, sf_dir):
    return C.campaign_table(spark, sf_dir)


@pytest.fixture(scope="module")
def prepared(base):
    return flows.prepare(base, C.KEY, C.LABEL, C.NUMERIC, C.CATEGORICAL, minimum=("n_orders", 2))


@pytest.fixture(scope="module")
def ensemble(prepared):
    train = prepared[0].filter("split = 'train'")
    return flows.train_ensemble(train, C.KEY, C.FEATURES, C.LABEL, trees=5, depth=4)


def test_fixture_sizes(base):
    got = base.agg(F.count("*"), F.sum("response"), F.sum("complain"), F.count("segment"), F.count("income")).collect()[0]
    assert tuple(got) == (150, 30, 15, 147, 139)
    assert dropna_any(base).count() == 136


def test_minimum_spares_the_serving_split(base, prepared):
    rows = SP.three_way_split(dropna_any(base), C.KEY, C.LABEL)
    serving = rows.filter("split = 'serving'").count()
    assert prepared[0].filter("split = 'serving'").count() == serving == 14
    assert prepared[0].filter("split <> 'serving'").count() == rows.filter("split <> 'serving' AND n_orders > 2").count()


def test_training_checks(base):
    rows = SP.three_way_split(dropna_any(base).drop("last_order"), C.KEY, C.LABEL)
    schema, report = flows.training_checks(rows, C.KEY, C.LABEL)
    assert schema.count() == 12
    # at this size a nation may be missing from the training rows; nothing else may be wrong
    assert {r["anomaly_type"] for r in report.collect()} <= {"domain"}


def test_saved_ensemble_scores_alike(spark, prepared, ensemble, tmp_path):
    features = prepared[0].filter("split = 'eval'")
    MM.save_version(ensemble, str(tmp_path), "v0.0.2")
    loaded = MM.load_version(spark, str(tmp_path), "v0.0.2")
    before = {r["id"]: r["score"] for r in ensemble.transform(features).collect()}
    after = {r["id"]: r["score"] for r in loaded.transform(features).collect()}
    assert before == after and all(0 <= s <= 1 for s in after.values())


def test_ensemble_is_the_mean_of_its_members(prepared, ensemble):
    features = prepared[0].filter("split = 'eval'")
    forest, logit = ensemble.stages[1], ensemble.stages[2]
    assembled = MM.assemble(features, C.FEATURES)
    p = {r["id"]: r["prob_rf"][1] for r in forest.transform(assembled).collect()}
    q = {r["id"]: r["prob_lr"][1] for r in logit.transform(assembled).collect()}
    for r in ensemble.transform(features).collect():
        assert r["score"] == pytest.approx((p[r["id"]] + q[r["id"]]) / 2)


def test_daily_run_twice_with_two_versions(spark, base, prepared, ensemble, tmp_path):
    models, scores = str(tmp_path / "models"), str(tmp_path / "scores")
    _, fitted = prepared
    MM.save_version(ensemble, models, "v1")
    MM.save_version(ensemble, models, "v2")
    customers = base.drop("response")
    schema = SC.exclude_from(SC.infer_schema(dropna_any(base), ["id"]), "response", "SERVING")
    with pytest.warns(UserWarning):  # the planned nulls
        first = flows.daily_run(spark, customers, schema, fitted, models, scores, "v1", "success_rate_v1")
    second = flows.daily_run(spark, first, schema, fitted, models, scores, "v2", "success_rate_v2", ignore_columns=["success_rate_v1"])
    assert second.columns[-2:] == ["success_rate_v1", "success_rate_v2"] and second.count() == 150
    assert second.filter("success_rate_v1 IS NULL OR success_rate_v2 <> success_rate_v1").count() == 0
    assert T.read_scores(spark, scores).groupBy("version").count().orderBy("version").collect() == [("v1", 150), ("v2", 150)]
    before = second.orderBy("id").collect()
    # a rerun of a day replaces its own version only
    again = flows.daily_run(spark, first, schema, fitted, models, scores, "v2", "success_rate_v2", ignore_columns=["success_rate_v1"])
    assert again.orderBy("id").collect() == before
    assert T.read_scores(spark, scores).count() == 300


def test_scores_need_no_row_order(spark, base):
    scores = SV.as_scores(base.withColumn("score", F.col("id") / 150), "v1").repartition(5)
    out = SV.attach_scores(base.select("id"), scores, "v1", "rate")
    assert out.filter(F.col("rate") != F.col("id") / 150).count() == 0
    wide = SV.attach_versions(base.select("id"), scores, {"v1": "rate", "v9": "other"})
    assert wide.filter("rate IS NULL OR other IS NOT NULL").count() == 0


def test_version_names_stay_text(spark, tmp_path):
    scores = spark.createDataFrame([(1, 0.5, "01"), (2, 0.5, "2024")], T.SCORES_SCHEMA)
    T.write_scores(scores, str(tmp_path / "scores"))
    assert {r["version"] for r in T.read_scores(spark, str(tmp_path / "scores")).collect()} == {"01", "2024"}


def test_table_replaces_itself_with_a_new_column(spark, tmp_path):
    path = str(tmp_path / "customer")
    spark.range(10).write.parquet(path)
    T.overwrite_with_column(spark, spark.read.parquet(path).withColumn("rate", F.col("id") * 2), path)
    assert spark.read.parquet(path).agg(F.sum("rate")).collect()[0][0] == 90


def test_catalog_table_replaces_itself(spark):
    spark.range(10).write.mode("overwrite").saveAsTable("customer_copy")
    for column in ("old_rate", "new_rate"):
        T.overwrite_with_column(spark, T.read_table(spark, "customer_copy").withColumn(column, F.col("id") * 2), "customer_copy")
    out = T.read_table(spark, "customer_copy")
    assert out.columns == ["id", "old_rate", "new_rate"] and out.agg(F.sum("new_rate")).collect()[0][0] == 90


def test_csv_round_trip_keeps_types_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,\"b\"", 1.5, None), (2, None, None, 7)], "id long, s string, x double, n int")
    T.write_csv(df.withColumn("row_index", F.col("id")), str(tmp_path / "csv"))
    back = T.read_csv(spark, str(tmp_path / "csv"), "id long, s string, x double, n int, row_index long", drop=["row_index"])
    assert back.schema == df.schema and back.orderBy("id").collect() == df.orderBy("id").collect()


def test_splits_prune(spark, base, tmp_path):
    path = str(tmp_path / "splits")
    T.write_splits(SP.three_way_split(base, C.KEY, C.LABEL), path)
    assert sum(T.read_split(spark, path, s).count() for s in ("train", "eval", "serving")) == 150
    plan = T.read_split(spark, path, "eval")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_call_list_order_and_exclusions(spark):
    scores = spark.createDataFrame([(i, s, "v") for i, s in ((3, 0.9), (1, 0.9), (2, 0.95), (4, 0.1))], "id long, score double, version string")
    outcomes = spark.createDataFrame([(2, 1)], "id long, result int")
    assert [r["id"] for r in SV.call_list(scores, outcomes, "v", 2).collect()] == [1, 3]


def test_leaderboard_ranks(spark, tmp_path):
    for name, recall in (("a", 0.5), ("b", 0.7), ("c", 0.7)):
        TR.log_run(TR.run_row(spark, name, {"n": 18}, {"recall": recall}), str(tmp_path / "runs"))
    board = TR.leaderboard(TR.read_runs(spark, str(tmp_path / "runs")))
    assert {(r["run_name"], r["rank"]) for r in board.collect()} == {("b", 1), ("c", 1), ("a", 3)}


def test_grid_search_with_folds(prepared):
    train = prepared[0].filter("split = 'train'")
    folds = SP.stratified_kfold(train, C.KEY, C.LABEL, 2).withColumn("label", F.col(C.LABEL).cast("double"))
    folds = MM.assemble(folds, C.FEATURES)
    smoted = Smoted(inner=MM.logistic(max_iter=5), key=C.KEY, cols=C.FEATURES, label=C.LABEL)
    found = MM.grid_search(smoted, {"C": [0.1, 10.0]}, "fold", 2).fit(folds)
    results = MM.grid_results(found)
    assert [s["C"] for s, _ in results] == [0.1, 10.0] and all(0 <= a <= 1 for _, a in results)
    assert found.bestModel.numFeatures == len(C.FEATURES)


def test_forest_and_network(prepared):
    train = prepared[0].filter("split = 'train'")
    for inner in (MM.random_forest(trees=3, depth=3), MM.mlp(len(C.FEATURES), hidden=4, max_iter=5)):
        model = Smoted(inner=inner, key=C.KEY, cols=C.FEATURES, label=C.LABEL).fit(train)
        out = MM.positive_probability(model, MM.assemble(train, C.FEATURES))
        assert out.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert set(MM.mlp_grid(18)["solver"]) == {"l-bfgs", "gd"}


def test_entry_points(spark, sf_dir):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).count() == 15
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    rows_only = set(entry_points.queries()) - set(entry_points.oracle_sql())
    trained = {"forest_search"}  # compared with plain versions in their tests
    assert rows_only <= set(entry_points.CORPUS) | trained  # every other query has its SQL twin
