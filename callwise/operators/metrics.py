"""Classification quality as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from callwise.functions.ranking import running_totals, running_totals_by, with_previous
from callwise.sources.staging import stage


def _ratio(a: Column, b: Column) -> Column:
    """0 where the denominator is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """``(by..., actual, predicted, n)`` over all pairs of classes that occur, pairs without rows included as 0."""
    counts = df.groupBy(*by, F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(F.count("*").alias("n"))
    # one small row per group: the classes seen on either side, and the pairs made from them
    seen = counts.groupBy(*by).agg(
        F.array_sort(F.array_union(F.collect_set("actual"), F.collect_set("predicted"))).alias("classes"),
        F.map_from_entries(F.collect_list(F.struct(F.struct("actual", "predicted"), "n"))).alias("cells"),
    )
    pairs = seen.select(*by, "cells", "classes", F.explode("classes").alias("actual")).select(
        *by, "cells", "actual", F.explode("classes").alias("predicted")
    )
    cell = F.try_element_at("cells", F.struct("actual", "predicted"))
    return pairs.select(*by, "actual", "predicted", F.coalesce(cell, F.lit(0)).cast("bigint").alias("n"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro average and weighted average.

    The accuracy row carries the accuracy in all three measures.
    """
    cells = confusion_matrix(df, label, pred, by)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    # each cell counts once for its actual and once for its predicted class
    sides = cells.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("called"), hit.alias("tp")),
                F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("called"), F.lit(0).cast("bigint").alias("tp")),
            )
        ),
    )
    sums = sides.groupBy(*by, "cls").agg(*[F.sum(c).alias(c) for c in ("support", "called", "tp")])
    scored = sums.withColumns(
        {"precision": _ratio(F.col("tp"), F.col("called")), "recall": _ratio(F.col("tp"), F.col("support"))}
    ).withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
    n = F.sum("support")
    means = scored.groupBy(*by).agg(
        n.alias("n"),
        _ratio(F.sum("tp"), n).alias("acc"),
        *[F.avg(m).alias(f"macro_{m}") for m in MEASURES],
        *[_ratio(F.sum(F.col(m) * F.col("support")), n).alias(f"weighted_{m}") for m in MEASURES],
    )
    rows = F.array(
        _report_row("accuracy", {m: F.col("acc") for m in MEASURES}),
        _report_row("macro avg", {m: F.col(f"macro_{m}") for m in MEASURES}),
        _report_row("weighted avg", {m: F.col(f"weighted_{m}") for m in MEASURES}),
    )
    per_class = scored.select(*by, F.col("cls").cast("string").alias("row"), *MEASURES, "support")
    return per_class.unionByName(means.select(*by, F.inline(rows)))


MEASURES = ("precision", "recall", "f1")


def _report_row(name: str, values: dict[str, Column]) -> Column:
    return F.struct(F.lit(name).alias("row"), *[v.alias(m) for m, v in values.items()], F.col("n").alias("support"))


def point_aggregates(label: str, pred: str) -> list[Column]:
    tp = F.count(F.when((F.col(label) == 1) & (F.col(pred) == 1), 1))
    return [
        _ratio(tp, F.count(F.when(F.col(pred) == 1, 1))).alias("precision"),
        _ratio(tp, F.count(F.when(F.col(label) == 1, 1))).alias("recall"),
        _ratio(F.count(F.when(F.col(label) == F.col(pred), 1)), F.count("*")).alias("accuracy"),
    ]


def point_metrics(df: DataFrame, label: str = "label", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall of class 1, and accuracy, from one aggregation."""
    return df.groupBy(*by).agg(*point_aggregates(label, pred))


def score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score; ties and hot scores collapse before the shuffle."""
    positive = F.count(F.when(F.col(label) == 1, 1))
    return df.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        positive.alias("pos"), (F.count("*") - positive).alias("neg")
    )


def _cumulative(df: DataFrame, label: str, score: str, buckets: int | None) -> DataFrame:
    """Counts per score with running sums from the best score down, and the totals ``_t`` of both classes."""
    counts = stage(score_counts(df, label, score), "per-score")
    totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t")).scalar()
    curve = running_totals(counts, "threshold", {"tp": "pos", "fp": "neg"}, descending=True, buckets=buckets, is_staged=True)
    return curve.withColumn("_t", totals)


def precision_recall_curve(df: DataFrame, label: str = "label", score: str = "score", buckets: int | None = None) -> DataFrame:
    """``(threshold, precision, recall)`` at every distinct score, and the final point (1, 0) without threshold."""
    curve = _cumulative(df, label, score, buckets)
    points = curve.select(
        "threshold",
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.when(F.col("_t.p") > 0, _ratio(F.col("tp"), F.col("_t.p"))).otherwise(1.0).alias("recall"),
    )
    last = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(last)


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", buckets: int | None = None) -> DataFrame:
    """``(threshold, fpr, tpr)`` at every distinct score and the starting point (0, 0) without threshold.

    Ranking by the 0/1 prediction instead of a score gives the three-point curve.
    """
    curve = _cumulative(df, label, score, buckets)
    points = curve.select(
        "threshold", _ratio(F.col("fp"), F.col("_t.n")).alias("fpr"), _ratio(F.col("tp"), F.col("_t.p")).alias("tpr")
    )
    first = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(first)


def curves_by(df: DataFrame, by: Sequence[str], label: str = "label", score: str = "score", buckets: int | None = None) -> DataFrame:
    """The curves of all groups (model versions, folds) in one job: ``(by..., threshold, pos, neg, tp, fp, precision, recall,
    fpr, tpr, total_tp, total_fp)`` at every distinct score of a group.

    ``pos`` and ``neg`` are the rows at the score itself. The outer points, which are the same for every curve, are not
    listed. Rates of a class that a group lacks are 0, its recall is 1. Rows without a score are left out; a null in
    ``by`` is a group like any other.
    """
    counts = stage(score_counts(df.filter(F.col(score).isNotNull()), label, score, by), "per-score")
    curve = running_totals_by(counts, by, "threshold", {"tp": "pos", "fp": "neg"}, descending=True, buckets=buckets)
    p, n = F.col("total_tp"), F.col("total_fp")
    return curve.withColumns({
        "precision": _ratio(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": F.when(p > 0, _ratio(F.col("tp"), p)).otherwise(1.0),
        "fpr": _ratio(F.col("fp"), n),
        "tpr": _ratio(F.col("tp"), p),
    })


def areas_by(curves: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by..., roc_auc, pr_auc, positives, negatives)`` by trapezoids, from the rows of ``curves_by`` alone.

    The point before a row has the counts of the row without its own, so no row needs its neighbor and one grouping
    gives all areas, in any order. The precision-recall curve begins at recall 0 with precision 1.
    """
    tp, fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    was_right = F.when(tp + fp > 0, _ratio(tp, tp + fp)).otherwise(1.0)
    roc = _ratio(F.col("neg"), F.col("total_fp")) * (F.col("tpr") + _ratio(tp, F.col("total_tp"))) / 2
    recall = _ratio(F.col("pos"), F.col("total_tp")) * (F.col("precision") + was_right) / 2
    return curves.groupBy(*by).agg(
        F.sum(roc).alias("roc_auc"), F.sum(recall).alias("pr_auc"), F.max("total_tp").alias("positives"), F.max("total_fp").alias("negatives")
    )


def best_threshold(curve: DataFrame, objective: str = "reference", beta: float = 1.0, by: Sequence[str] = ()) -> DataFrame:
    """The threshold that maximizes the objective over a precision-recall curve, or over each of several; of equal ones the lowest.

    ``reference`` is ``(2r + p) / (r + p)``, where 0/0 is NaN and NaN wins, as in an argmax over floats. ``f1`` and
    ``fbeta`` are the usual measures, 0 where undefined.
    """
    p, r = F.col("precision"), F.col("recall")
    if objective == "reference":
        value = F.coalesce(F.try_divide(2 * r + p, r + p), F.lit(float("nan")))
    elif objective in ("f1", "fbeta"):
        b2 = 1.0 if objective == "f1" else beta * beta
        value = F.coalesce(F.try_divide((1 + b2) * p * r, b2 * p + r), F.lit(0.0))
    else:
        raise ValueError(objective)
    best = F.max_by(F.struct("threshold", "objective"), F.struct("objective", -F.col("threshold")))
    rated = curve.filter(F.col("threshold").isNotNull()).withColumn("objective", value)
    return rated.groupBy(*by).agg(best.alias("b")).select(*by, "b.threshold", "b.objective")


def auc(curve: DataFrame, x: str, y: str, order: str | None = None, buckets: int | None = None) -> DataFrame:
    """Area under a curve by trapezoids between neighbors.

    ``order`` names the numeric column whose ascending values run along the curve, such as the negated threshold; without
    it the points are taken in the order of x, then y, which fits a curve that never falls (ROC), not a
    precision-recall curve.
    """
    rows = curve.select(x, y) if order is None else curve.select(x, y, F.col(order).cast("double").alias("_at"))
    steps = with_previous(rows, [x, y] if order is None else ["_at", x, y], [x, y], buckets)
    area = (F.col(x) - F.col(f"prev_{x}")) * (F.col(y) + F.col(f"prev_{y}")) / 2
    return steps.agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("auc"))
