import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from callwise.operators import newton as N
from callwise.operators import selection as SEL


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(2)
    rows = [(i, y := i % 2, i % 5, rng.gauss(y, 1), 1e8 + rng.gauss(0, 1e-2) + y * 5e-3, rng.random(), None if i % 7 == 0 else float(i % 3)) for i in range(300)]
    return spark.createDataFrame(rows, "id long, y int, fold int, a double, b double, c double, d double")


def test_scores_of_each_fold_equal_those_of_its_rows(table):
    got = {(r["left_out"], r["feature"]): r["f"] for r in SEL.fold_anova_f(table, list("abcd"), "y", "fold").collect()}
    for f in range(5):
        for r in SEL.anova_f(table.filter(F.col("fold") != f), list("abcd"), "y").collect():
            assert got[f, r["feature"]] == pytest.approx(r["f"], rel=1e-4)
    chosen = SEL.fold_choices(table, list("abcd"), "y", "fold", 2)
    assert chosen == {f: SEL.best_features(table.filter(F.col("fold") != f), list("abcd"), "y", 2) for f in range(5)}


def test_the_rows_are_read_once(table, spark, tmp_path):
    path = str(tmp_path / "t")
    table.write.parquet(path)
    plan = SEL.fold_anova_f(spark.read.parquet(path), list("abcd"), "y", "fold")._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan  # only sums of folds are left


def test_one_fold_alone_has_no_other_rows(table):
    assert SEL.fold_anova_f(table.filter("fold = 1"), ["a"], "y", "fold").count() == 0


def test_selector_is_a_saved_step(table, tmp_path):
    pipeline = Pipeline(stages=[SEL.KBestSelector(cols=list("abc"), label="y", k=2), N.NewtonLogistic()])
    model = pipeline.fit(table.withColumn("label", F.col("y").cast("double")))
    assert model.stages[0].getOrDefault("chosen") == SEL.best_features(table, list("abc"), "y", 2)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    score = lambda m: {r["id"]: r["probability"][1] for r in m.transform(table).collect()}
    assert score(model) == score(again)
