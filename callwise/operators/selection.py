"""Univariate feature selection by one-way analysis of variance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from callwise.functions.scalars import ident, literal, nan_to_null
from callwise.operators.stats import tall
from callwise.sources.staging import pin


def anova_f(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """``(feature, f)`` for each column against the class: infinite for a column that tells the classes apart without any
    spread inside them, null for a constant one.

    One pass gives count, mean and sum of squares about the mean per class; the sums of squares are taken about the
    class mean (as ``var_pop`` does) because raw sums of squares cancel badly on large values.
    """
    df = nan_to_null(df, cols)
    aggs, entries = [], []
    for i, c in enumerate(cols):
        v = f"CAST({ident(c)} AS DOUBLE)"
        aggs += [f"count({ident(c)}) AS n_{i}", f"avg({v}) AS m_{i}", f"var_pop({v}) AS v_{i}"]
        entries.append(f"named_struct('feature', {literal(c)}, 'n', n_{i}, 'm', m_{i}, 'v', v_{i})")
    per_class = tall(df.groupBy(label).agg(*map(F.expr, aggs)), [], entries).filter("n > 0")
    # classes x columns rows from here on
    whole = per_class.groupBy("feature").agg(
        F.expr("count(*) AS k"),
        F.expr("sum(n) AS total"),
        F.expr("sum(n * m) / sum(n) AS grand"),
        F.expr("sum(n * v) AS within"),
        F.expr("collect_list(named_struct('n', n, 'm', m)) AS classes"),
    )
    between = "aggregate(classes, 0D, (s, c) -> s + c.n * (c.m - grand) * (c.m - grand))"
    apart = "CASE WHEN b > 0 AND k > 1 THEN double('infinity') END"  # constant inside every class
    f = f"CASE WHEN within = 0 THEN {apart} ELSE try_divide(try_divide(b, k - 1), try_divide(within, total - k)) END AS f"
    return whole.withColumn("b", F.expr(between)).select("feature", F.expr(f))


def best_features(df: DataFrame, cols: Sequence[str], label: str, k: int) -> list[str]:
    """The k columns with the highest F in their original order; of equal F the later column, as a stable ascending sort has it."""
    scores = {r["feature"]: r["f"] for r in anova_f(df, cols, label).collect()}  # one number per column
    rank = sorted(range(len(cols)), key=lambda i: (-(scores.get(cols[i]) if scores.get(cols[i]) is not None else -1.0), -i))
    return [cols[i] for i in sorted(rank[:k])]


def select_k_best(df: DataFrame, key: str, cols: Sequence[str], label: str, k: int) -> DataFrame:
    return df.select(key, *best_features(df, cols, label, k), label)


def fold_anova_f(df: DataFrame, cols: Sequence[str], label: str, fold: str) -> DataFrame:
    """``(left_out, feature, f)``: for each fold the F of ``anova_f`` on all other folds, from one pass over the rows.

    The pass gives count, mean and variance per (fold, class). They are sufficient: the statistics of a training set are
    those of its folds put together, the squares taken about the new mean, so nothing is read again for another fold.
    """
    df = nan_to_null(df, cols)
    aggs, entries = [], []
    for i, c in enumerate(cols):
        v = f"CAST({ident(c)} AS DOUBLE)"
        aggs += [f"count({ident(c)}) AS n_{i}", f"avg({v}) AS m_{i}", f"var_pop({v}) AS v_{i}"]
        entries.append(f"named_struct('feature', {literal(c)}, 'n', n_{i}, 'm', m_{i}, 'v', v_{i})")
    named = df.select(F.col(fold).alias("_fold"), F.col(label).alias("_class"), *[F.col(c) for c in cols])
    parts = pin(tall(named.groupBy("_fold", "_class").agg(*map(F.expr, aggs)), ["_fold", "_class"], entries))  # folds x classes x columns rows
    folds = parts.select(F.col("_fold").alias("left_out")).distinct()
    rest = parts.filter("n > 0").join(F.broadcast(folds), ~F.col("_fold").eqNullSafe(F.col("left_out")))
    per_class = rest.groupBy("left_out", "feature", "_class").agg(
        F.expr("sum(n) AS n"), F.expr("sum(n * m) / sum(n) AS m"), F.expr("collect_list(named_struct('n', n, 'm', m, 'v', v)) AS folds")
    )
    joined = "aggregate(folds, 0D, (s, p) -> s + p.n * p.v + p.n * (p.m - m) * (p.m - m))"
    whole = per_class.withColumn("inner", F.expr(joined)).groupBy("left_out", "feature").agg(
        F.expr("count(*) AS k"), F.expr("sum(n) AS total"), F.expr("sum(n * m) / sum(n) AS grand"), F.expr("sum(inner) AS within"), F.expr("collect_list(named_struct('n', n, 'm', m)) AS classes")
    )
    between = "aggregate(classes, 0D, (s, c) -> s + c.n * (c.m - grand) * (c.m - grand))"
    f = "CASE WHEN within = 0 THEN CASE WHEN b > 0 AND k > 1 THEN double('infinity') END ELSE try_divide(try_divide(b, k - 1), try_divide(within, total - k)) END AS f"
    return whole.withColumn("b", F.expr(between)).select("left_out", "feature", F.expr(f))


def fold_choices(df: DataFrame, cols: Sequence[str], label: str, fold: str, k: int) -> dict[object, list[str]]:
    """The k best columns for each fold that is left out, in their original order; ties as in ``best_features``."""
    scores: dict = {}
    for r in fold_anova_f(df, cols, label, fold).collect():  # folds x columns numbers
        scores.setdefault(r["left_out"], {})[r["feature"]] = r["f"]
    out = {}
    for left_out, f in scores.items():
        rank = sorted(range(len(cols)), key=lambda i: (-(f[cols[i]] if f.get(cols[i]) is not None else -1.0), -i))
        out[left_out] = [cols[i] for i in sorted(rank[:k])]
    return out


class KBestSelector(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """The k best columns by F as a step of a pipeline: the fitted model assembles them into ``features``."""

    cols = Param(Params._dummy(), "cols", "columns to choose from", TypeConverters.toListString)
    label = Param(Params._dummy(), "label", "class column", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "columns to keep", TypeConverters.toInt)
    outputCol = Param(Params._dummy(), "outputCol", "vector of the chosen columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, cols: Sequence[str] | None = None, label: str = "label", k: int = 10, outputCol: str = "features"):
        super().__init__()
        self._setDefault(label="label", k=10, outputCol="features")
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> KBestModel:
        o = self.getOrDefault
        return KBestModel(chosen=best_features(dataset, o("cols"), o("label"), o("k")), outputCol=o("outputCol"))


class KBestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    chosen = Param(Params._dummy(), "chosen", "the columns kept, in order", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector of the chosen columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, chosen: Sequence[str] | None = None, outputCol: str = "features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=self.getOrDefault("chosen"), outputCol=self.getOrDefault("outputCol")).transform(dataset)
