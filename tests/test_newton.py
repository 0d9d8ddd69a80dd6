import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from callwise.operators import models as MM
from callwise.operators import newton as N
from callwise.operators import resampling as RS

COLS = ["a", "b", "c"]


def plain(x, y, c):
    """Newton steps on one data set, to machine precision."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([1 / c] * (x.shape[1] - 1) + [0.0])
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (p - y) + ridge @ beta)
    return beta


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3)) * [1.0, 30_000.0, 0.001] + [0.0, 50_000.0, 0.0]
    y = (rng.random(400) < 1 / (1 + np.exp(-(x[:, 0] + (x[:, 1] - 50_000) / 20_000 - 1.2)))).astype(int)
    return x, y, np.arange(400) % 4


@pytest.fixture(scope="module")
def table(spark, data):
    x, y, fold = data
    return spark.createDataFrame([(i, *map(float, r), int(t), int(f)) for i, (r, t, f) in enumerate(zip(x, y, fold, strict=True))], "id long, a double, b double, c double, y int, fold int")


def weights(m):
    return [*m.coefficients, m.intercept]


def test_every_model_of_one_scan_equals_its_own_solution(table, data):
    x, y, fold = data
    rows = N.training_rows(table, COLS, "y", "fold")
    fits = [N.Fit(c, 100, f) for c in (0.01, 1.0, 50.0) for f in (0, 3, N.ALL)]
    for m in N.fit_many(rows, COLS, fits):
        keep = np.ones(len(y), bool) if m.fit.fold == N.ALL else fold != m.fit.fold
        assert weights(m) == pytest.approx(plain(x[keep], y[keep], m.fit.C), rel=1e-7, abs=1e-10)
        assert m.rows == keep.sum() and m.gradient <= N.TOLERANCE and m.iterations < 15


def test_partitioning_does_not_matter(table):
    rows = N.training_rows(table, COLS, "y", "fold")
    one, many = (weights(N.fit_many(rows.repartition(n), COLS, [N.Fit()])[0]) for n in (1, 13))
    assert one == pytest.approx(many, rel=1e-9)


def test_moments_tell_the_optimum(table, data):
    x, y, _ = data
    rows = N.training_rows(table, COLS, "y", "fold")
    (m,) = N.fit_many(rows, COLS, [N.Fit(2.0)])
    full = np.column_stack([x, np.ones(len(x))])
    labels = (full * y[:, None]).sum(0) / np.abs(full).sum(0)
    assert [v for *_, v in N.fitted_moments(rows, COLS, [m])] == pytest.approx(labels, abs=1e-9)
    m.coefficients[0] += 1e-4
    assert abs(N.fitted_moments(rows, COLS, [m])[0][2] - labels[0]) > 1e-6


def test_separable_rows_iteration_limit_and_empty_folds(spark):
    df = spark.createDataFrame([(i, float(i), int(i > 9), 0) for i in range(20)] + [(99, None, 1, 0), (98, math.nan, 1, 0)], "id long, a double, y int, fold int")
    rows = N.training_rows(df, ["a"], "y", "fold")
    whole, short, none = N.fit_many(rows, ["a"], [N.Fit(100.0), N.Fit(100.0, 2), N.Fit(1.0, 100, 0)])
    assert whole.gradient <= N.TOLERANCE and whole.rows == 20 and short.iterations == 2 < whole.iterations
    assert weights(none) == [0.0, 0.0] and none.rows == 0
    assert weights(whole) == pytest.approx(plain(np.arange(20.0)[:, None], (np.arange(20) > 9).astype(float), 100.0), rel=1e-4)


def test_synthetic_rows_of_all_folds_equal_separate_runs(table):
    rare = table.filter("y = 0 OR id % 3 = 0").unionByName(table.filter("id < 40").withColumns({"id": F.col("id") + 1000, "y": F.lit(1)}))
    made = RS.synthetic_by_fold(rare, "id", COLS, "y", "fold", [0, 1, 2, 3, RS.ALL]).collect()
    for f in (0, 2, RS.ALL):
        part = rare if f == RS.ALL else rare.filter(F.col("fold") != f)
        alone = RS.synthetic_rows(part, "id", COLS, "y").collect()
        assert sorted(map(tuple, alone)) == sorted(tuple(r)[1:] for r in made if r["for_fold"] == f) and alone


def test_fewer_rare_rows_than_neighbors(spark):
    df = spark.createDataFrame([(i, float(i), int(i in (0, 7, 14)), i % 2) for i in range(30)], "id long, a double, y int, fold int")
    made = RS.synthetic_by_fold(df, "id", ["a"], "y", "fold", [1, RS.ALL]).collect()
    for f, ids in ((1, {0, 14}), (RS.ALL, {0, 7, 14})):
        own = [r for r in made if r["for_fold"] == f]
        assert {r["base"] for r in own} <= ids and {r["neighbor"] for r in own} <= ids and own
    with pytest.raises(ValueError, match="at least two"):
        RS.synthetic_by_fold(df, "id", ["a"], "y", "fold", [0])


def test_search_equals_fits_one_by_one(table, data):
    x, y, fold = data
    grid = {"C": (0.01, 10.0), "max_iter": (50, 100)}
    found = N.logistic_search(table, "id", COLS, "y", "fold", grid, oversample=False)
    assert len(found.runs) == 16 and len(found.means) == 4
    for m, accuracy in found.runs:
        beta = plain(x[fold != m.fit.fold], y[fold != m.fit.fold], m.fit.C)
        test = fold == m.fit.fold
        right = (np.column_stack([x[test], np.ones(test.sum())]) @ beta > 0) == (y[test] == 1)
        assert accuracy == pytest.approx(right.mean())
    best = max(found.means, key=lambda s: s[1])[0]
    assert found.best.fit == N.Fit(best.C, best.max_iter, N.ALL)
    assert weights(found.best) == pytest.approx(plain(x, y, best.C), rel=1e-7, abs=1e-10)


def test_search_oversamples_each_fold_by_itself(table):
    found = N.logistic_search(table, "id", COLS, "y", "fold", {"C": (1.0,), "max_iter": (100,)})
    common = table.filter("y = 0").groupBy("fold").count().collect()
    sizes = {r["fold"]: 2 * (sum(q["count"] for q in common) - r["count"]) for r in common}
    majority = {f: n for f, n in sizes.items()}
    assert {m.fit.fold: m.rows for m, _ in found.runs} == majority


def test_estimator_saves_and_votes(spark, table, tmp_path):
    rows = MM.assemble(table, COLS, "y")
    model = N.NewtonLogistic(C=2.0).fit(rows)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = N.LinearLogisticModel.load(str(tmp_path / "m"))
    p = {r["id"]: r["score"] for r in MM.positive_probability(model, rows).collect()}
    assert p == {r["id"]: r["score"] for r in MM.positive_probability(again, rows).collect()}
    vote = MM.voting_model({"x": model, "y": MM.logistic(C=2.0, max_iter=300).fit(rows)}, COLS)
    MM.save_version(vote, str(tmp_path), "v1")
    for r in MM.load_version(spark, str(tmp_path), "v1").transform(table).collect():
        assert r["score"] == pytest.approx(p[r["id"]], abs=1e-3)


def test_rows_meet_only_the_models_they_train(spark):
    df = spark.createDataFrame([(0, None, 1.0), (1, None, 0.0), (N.ALL, 0, 1.0), (N.ALL, 0, 1.0), (N.ALL, 1, 0.0), (N.ALL, N.ALL, 1.0)], "_fold int, _only int, _y double").withColumn("a", F.lit(2.0))
    seen = N._summed(df, lambda fold, only, y, x, which: np.full((1, len(which)), float(len(y))), np.array([0, 1, N.ALL]), 1)
    assert seen.tolist() == [[4.0, 3.0, 3.0]]  # was 6 rows for each model


def test_fits_that_differ_in_iterations_share_their_steps(table, monkeypatch):
    rows = N.training_rows(table, COLS, "y", "fold")
    fits = [N.Fit(c, n, f) for c in (0.5, 9.0) for n in (100, 1, 2, 50) for f in (0, N.ALL)]
    alone = [N.fit_many(rows, COLS, [f])[0] for f in fits]
    summed, models = N._summed, []
    monkeypatch.setattr(N, "_summed", lambda rows, kernel, folds, width: (models.append(len(folds)), summed(rows, kernel, folds, width))[1])
    for together, own in zip(N.fit_many(rows, COLS, fits), alone, strict=True):
        assert weights(together) == pytest.approx(weights(own), rel=1e-9) and together.iterations == own.iterations and together.fit == own.fit
    assert max(models) == 4  # was 16
