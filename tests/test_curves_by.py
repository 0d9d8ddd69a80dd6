import math
import random

import pytest
from pyspark.sql import functions as F

from callwise.operators import metrics as M


def brute(rows):
    """Curve points, areas of one group by plain loops; rows are (score, label)."""
    p = sum(label for _, label in rows)
    n = len(rows) - p
    points, roc, pr, before = [], 0.0, 0.0, (0.0, 0.0, 0.0, 1.0)
    for t in sorted({s for s, _ in rows}, reverse=True):
        tp = sum(1 for s, label in rows if s >= t and label)
        fp = sum(1 for s, label in rows if s >= t and not label)
        now = (fp / n if n else 0.0, tp / p if p else 0.0, tp / p if p else 0.0, tp / (tp + fp))
        roc += (now[0] - before[0]) * (now[1] + before[1]) / 2
        pr += (now[2] - before[2]) * (now[3] + before[3]) / 2
        points.append((t, tp, fp))
        before = now
    return points, roc, pr


@pytest.fixture(scope="module")
def scored():
    rng = random.Random(3)
    rows = [("hot", 0, round(rng.random(), 3), int(rng.random() < 0.3)) for _ in range(3000)]
    rows += [("small", f, round(rng.random(), 1), int(rng.random() < 0.5)) for f in range(4) for _ in range(20)]
    return rows + [("no positives", 0, 0.2, 0), ("no negatives", 0, 0.2, 1), (None, 0, 0.5, 1), (None, 0, 0.4, 0), (None, None, 0.4, 0)]


@pytest.mark.parametrize("buckets", [None, 1, 40])
def test_curves_and_areas_of_every_group(spark, scored, buckets):
    df = spark.createDataFrame(scored, "version string, fold int, score double, label int")
    curves = M.curves_by(df, ["version", "fold"], buckets=buckets).cache()
    areas = {(r["version"], r["fold"]): r for r in M.areas_by(curves, ["version", "fold"]).collect()}
    groups = {}
    for version, fold, s, label in scored:
        groups.setdefault((version, fold), []).append((s, label))
    assert set(areas) == set(groups)
    got = {}
    for r in curves.collect():
        got.setdefault((r["version"], r["fold"]), []).append((r["threshold"], r["tp"], r["fp"]))
    for key, rows in groups.items():
        points, roc, pr = brute(rows)
        assert sorted(got[key], reverse=True) == points
        assert math.isclose(areas[key]["roc_auc"], roc, abs_tol=1e-9) and math.isclose(areas[key]["pr_auc"], pr, abs_tol=1e-9)
        assert areas[key]["positives"] + areas[key]["negatives"] == len(rows)


def test_areas_equal_those_of_single_curves(spark, scored):
    df = spark.createDataFrame([r for r in scored if r[0] == "hot"], "version string, fold int, score double, label int")
    area = M.areas_by(M.curves_by(df, ["version"]), ["version"]).first()
    assert math.isclose(area["roc_auc"], M.auc(M.roc_curve(df), "fpr", "tpr").first()[0], abs_tol=1e-9)
    pr = M.precision_recall_curve(df).withColumn("at", F.coalesce(-F.col("threshold"), F.lit(float("-inf"))))
    assert math.isclose(area["pr_auc"], M.auc(pr, "recall", "precision", order="at").first()[0], abs_tol=1e-9)


def test_best_threshold_per_group(spark, scored):
    df = spark.createDataFrame(scored, "version string, fold int, score double, label int").filter("version IN ('hot', 'small')")
    best = {r["version"]: r for r in M.best_threshold(M.curves_by(df, ["version"]), "f1", by=["version"]).collect()}
    for version in ("hot", "small"):
        alone = M.best_threshold(M.precision_recall_curve(df.filter(F.col("version") == version)), "f1").first()
        assert math.isclose(best[version]["threshold"], alone["threshold"]) and math.isclose(best[version]["objective"], alone["objective"])


def test_no_rows_and_no_scores(spark):
    df = spark.createDataFrame([("a", None, 1)], "version string, score double, label int")
    for frame in (df, df.limit(0)):
        curves = M.curves_by(frame, ["version"])
        assert curves.count() == 0 and M.areas_by(curves, ["version"]).count() == 0
