import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from callwise.operators import models as MM
from callwise.operators import resampling as RS
from callwise.operators import neighbors
from callwise.operators.neighbors import minority_knn, nearest


def brute(points, k):
    out = {}
    for i, x in points.items():
        near = []
        for j, y in points.items():
            if i != j:
                d = 0.0
                for a, b in zip(x, y):
                    d += (a - b) * (a - b)
                near.append((d, j))
        out[i] = sorted(near)[:k]
    return out


def found(df):
    got = {}
    for r in df.orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((r["distance2"], r["neighbor"]))
    return got


@pytest.fixture(scope="module")
def cloud(spark):
    """Two dense clusters, scattered points, and a third of all rows being copies of one point."""
    rng = random.Random(11)
    points = {}
    for i in range(420):
        if i % 3 == 0:
            points[i] = (5.0, 5.0, 5.0)
        elif i % 3 == 1:
            points[i] = tuple(round(rng.gauss(100 * (i % 2), 1), 1) for _ in range(3))
        else:
            points[i] = tuple(float(rng.randrange(-300, 300)) for _ in range(3))
    df = spark.createDataFrame([(i, *p) for i, p in points.items()], "id long, a double, b double, c double")
    return df, points


@pytest.mark.parametrize("cell_points", [10**6, 40, 7])
def test_neighbors_equal_brute_force(cloud, cell_points):
    df, points = cloud
    assert found(nearest(df, "id", ["a", "b", "c"], 4, cell_points)) == brute(points, 4)


def test_large_cells_are_searched_in_parts(cloud, monkeypatch):
    df, points = cloud
    monkeypatch.setattr(neighbors, "HELD_ROWS", 9)
    monkeypatch.setattr(neighbors, "VISIT_ROWS", 11)
    for cell_points in (10**6, 40):
        assert found(nearest(df, "id", ["a", "b", "c"], 4, cell_points)) == brute(points, 4)


def test_neighbors_of_a_few_rows(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 1.0)], "id long, a double")
    assert found(nearest(df, "id", ["a"], 5)) == {1: [(0.0, 2), (1.0, 3)], 2: [(0.0, 1), (1.0, 3)], 3: [(1.0, 1), (1.0, 2)]}


def test_negative_zero_is_zero(spark):
    df = spark.createDataFrame([(1, 0.0), (2, -0.0)], "id long, a double")
    assert found(nearest(df, "id", ["a"], 1)) == {1: [(0.0, 2)], 2: [(0.0, 1)]}


def test_only_the_minority_is_searched(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (2, 0, 0.1), (3, 1, 5.0)], "id long, y int, a double")
    assert found(minority_knn(df, "id", ["a"], "y")) == {1: [(25.0, 3)], 3: [(25.0, 1)]}


@pytest.fixture(scope="module")
def unbalanced(spark):
    rng = random.Random(5)
    rows = [(i, int(i % 9 == 0), rng.gauss(i % 9 == 0, 1), rng.gauss(0, 1)) for i in range(300)]
    return spark.createDataFrame(rows, "id long, y int, a double, b double")


def test_smote_balances_and_repeats(unbalanced):
    out = RS.smote(unbalanced, "id", ["a", "b"], "y")
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 266, 1: 266}
    again = RS.smote(unbalanced.repartition(7), "id", ["a", "b"], "y")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_synthetic_rows_lie_between_neighbors(unbalanced):
    near = {(r["id"], r["neighbor"]) for r in minority_knn(unbalanced, "id", ["a", "b"], "y").collect()}
    at = {r["id"]: (r["a"], r["b"]) for r in unbalanced.collect()}
    made = RS.synthetic_rows(unbalanced, "id", ["a", "b"], "y").collect()
    assert sorted(r["j"] for r in made) == list(range(232))
    for r in made:
        assert (r["base"], r["neighbor"]) in near and 0 <= r["gap"] < 1
        for c, v in zip(("a", "b"), range(2)):
            lo, hi = at[r["base"]][v], at[r["neighbor"]][v]
            assert r[c] == pytest.approx(lo + r["gap"] * (hi - lo))


def test_balanced_data_stays_as_it_is(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 1, 2.0)], "id long, y int, a double")
    assert sorted(map(tuple, RS.smote(df, "id", ["a"], "y").collect())) == [(1.0, 0), (2.0, 1)]


def test_class_weights_sum_to_equal_parts(unbalanced):
    out = RS.class_weights(unbalanced, "y").groupBy("y").agg(F.sum("weight")).collect()
    assert all(r[1] == pytest.approx(150) for r in out)


def test_smoted_fits_on_balanced_rows_only(unbalanced):
    smoted = RS.Smoted(inner=MM.logistic(), key="id", cols=["a", "b"], label="y")
    model = smoted.fit(unbalanced)
    direct = MM.logistic().fit(smoted.balanced(unbalanced))
    assert model.coefficients.toArray() == pytest.approx(direct.coefficients.toArray())
    assert model.transform(MM.assemble(unbalanced, ["a", "b"])).count() == 300  # nothing is added when scoring


def test_penalty_follows_the_row_count(unbalanced):
    """C weighs the sum of losses: doubling the rows must equal doubling C."""
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(unbalanced).withColumn("label", F.col("y").cast("double"))
    twice = MM.logistic(C=1.0, max_iter=200).fit(rows.unionByName(rows)).coefficients.toArray()
    assert twice == pytest.approx(MM.logistic(C=2.0, max_iter=200).fit(rows).coefficients.toArray(), rel=1e-3)
