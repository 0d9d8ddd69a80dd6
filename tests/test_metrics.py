import math
import random

import pytest
from pyspark.sql import functions as F

from callwise.operators import metrics as M


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.8), (4, 0, 0.4), (5, 1, 0.3), (6, 0, 0.1)]
    return spark.createDataFrame(rows, "id long, label int, score double").withColumn("pred", (F.col("score") >= 0.5).cast("int"))


@pytest.fixture(scope="module")
def many(spark):
    """A third of the rows share one score."""
    rng = random.Random(3)
    rows = [(i, int(rng.random() < 0.3), 0.25 if i % 3 == 0 else rng.random() ** 4) for i in range(5000)]
    return spark.createDataFrame(rows, "id long, label int, score double")


def test_confusion_keeps_empty_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "label int, pred int")
    got = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion_matrix(df).collect()}
    assert got == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}


def test_report_by_hand(scored):
    got = {r["row"]: r for r in M.classification_report(scored).collect()}
    assert set(got) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert (got["1"]["precision"], got["1"]["recall"], got["1"]["support"]) == (2 / 3, 2 / 3, 3)
    assert got["accuracy"]["f1"] == got["macro avg"]["precision"] == 4 / 6
    assert got["weighted avg"]["support"] == 6


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, pred int")
    got = {r["row"]: r for r in M.classification_report(df).collect()}
    assert (got["1"]["precision"], got["1"]["recall"], got["1"]["f1"]) == (0.0, 0.0, 0.0)
    assert got["0"]["f1"] == pytest.approx(2 / 3)


def test_point_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, pred int")
    assert tuple(M.point_metrics(df).collect()[0]) == (0.0, 0.0, 1.0)


def test_curve_by_hand(scored):
    got = [tuple(r) for r in M.precision_recall_curve(scored).orderBy(F.col("threshold").desc_nulls_last()).collect()]
    assert got[0] == (0.9, 1.0, 1 / 3)
    assert got[1] == (0.8, 2 / 3, 2 / 3)  # the tie is one point
    assert got[-2] == (0.1, 0.5, 1.0)
    assert got[-1] == (None, 1.0, 0.0)


def test_labels_as_scores_give_three_points(scored):
    got = sorted((r["fpr"], r["tpr"]) for r in M.roc_curve(scored, score="pred").collect())
    assert got == [(0.0, 0.0), (1 / 3, 2 / 3), (1.0, 1.0)]
    area = M.auc(M.roc_curve(scored, score="pred"), "fpr", "tpr").collect()[0][0]
    assert area == pytest.approx((2 / 3 + 2 / 3) / 2)  # (TPR + TNR) / 2


def test_curves_in_ranges_equal_the_plain_ones(many):
    for curve in (M.precision_recall_curve, M.roc_curve):
        plain = sorted(map(str, curve(many).collect()))
        assert sorted(map(str, curve(many, buckets=64).collect())) == plain
        assert sorted(map(str, curve(many.repartition(11, "score")).collect())) == plain


def test_auc_in_ranges_and_against_pairs(many):
    rows = many.collect()
    pos = [r["score"] for r in rows if r["label"] == 1]
    neg = [r["score"] for r in rows if r["label"] == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    roc = M.roc_curve(many)
    assert M.auc(roc, "fpr", "tpr").collect()[0][0] == pytest.approx(wins, abs=1e-9)
    assert M.auc(roc, "fpr", "tpr", buckets=64).collect()[0][0] == pytest.approx(wins, abs=1e-9)


def test_best_threshold_objectives(spark):
    curve = spark.createDataFrame([(0.9, 1.0, 0.2), (0.5, 0.5, 0.5), (0.4, 0.5, 0.5), (None, 1.0, 0.0)], "threshold double, precision double, recall double")
    assert tuple(M.best_threshold(curve).collect()[0]) == (0.4, 1.5)
    assert tuple(M.best_threshold(curve, "f1").collect()[0]) == (0.4, 0.5)
    assert M.best_threshold(curve, "fbeta", beta=0.1).collect()[0]["threshold"] == 0.9


def test_best_threshold_nan_wins_and_the_lowest_of_them(spark):
    curve = spark.createDataFrame([(0.9, 0.0, 0.0), (0.8, 0.0, 0.0), (0.5, 0.5, 1.0)], "threshold double, precision double, recall double")
    got = M.best_threshold(curve).collect()[0]
    assert got["threshold"] == 0.8 and math.isnan(got["objective"])
    assert M.best_threshold(curve, "f1").collect()[0]["threshold"] == 0.5


def test_area_under_a_precision_recall_curve_needs_its_order(spark):
    points = spark.createDataFrame([(0.0, 1.0, 0.0), (1.0, 0.5, 0.5), (2.0, 0.25, 0.5), (3.0, 0.5, 1.0)], "at double, precision double, recall double")
    want = 0.5 * (1.0 + 0.5) / 2 + 0.5 * (0.25 + 0.5) / 2
    assert M.auc(points, "recall", "precision", order="at").collect()[0][0] == pytest.approx(want)
