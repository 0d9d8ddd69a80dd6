"""Many penalised logistic regressions in one scan per step, each solved to a gradient that certifies the optimum.

A search fits one model for each setting and fold. All of them see the same rows, so a step reads the stored rows once:
a task forms the scores of its rows under every model, and from them the gradient and Hessian sums of every model as two
matrix products. For k models on d features that is k (d + 1)(d + 4) / 2 numbers per task, which Spark sums by model and
place; the driver gets only the sums and solves k small systems. A model leaves the scan when its gradient is below the
tolerance. Newton steps need some ten scans where first-order steps need hundreds, whatever the scales of the features.

A row belongs to the training set of a model by two columns: ``fold``, the fold that it tests (a model of that fold does
not train on it), and ``only``, set for synthetic rows, the fold they were made for. Fold ``ALL`` trains on all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from callwise.functions.scalars import ident
from callwise.functions.workers import with_library
from callwise.operators.resampling import ALL, synthetic_by_fold
from callwise.sources.staging import stage

TOLERANCE = 1e-8
STRIP = 4_096  # rows scored at once
LEAST_STEP = 2.0**-30


@dataclass(frozen=True)
class Fit:
    """What is to be fitted: ``C`` weighs the summed loss against half the squared norm of the coefficients."""

    C: float = 1.0
    max_iter: int = 100
    fold: int = ALL


@dataclass
class Fitted:
    fit: Fit
    coefficients: np.ndarray
    intercept: float
    rows: int
    iterations: int
    gradient: float  # largest entry of the penalised mean gradient
    loss: float


def training_rows(df: DataFrame, cols: Sequence[str], label: str, fold: str | None = None) -> DataFrame:
    """``(fold, only, y, cols...)`` as doubles; rows with a missing feature or label take no part."""
    values = [F.expr(f"nanvl(CAST({ident(c)} AS DOUBLE), NULL) AS {ident(c)}") for c in cols]
    own = F.lit(ALL) if fold is None else F.coalesce(F.col(fold).cast("int"), F.lit(ALL))
    only = F.col("for_fold").cast("int") if "for_fold" in df.columns else F.lit(None).cast("int")
    rows = df.select(own.alias("_fold"), only.alias("_only"), F.col(label).cast("double").alias("_y"), *values)
    return rows.na.drop(subset=["_y", *cols])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(fold, only, y, x)`` in strips of rows with one value of ``only``; x ends with the ones of the intercept, ``only`` is
    below ALL for real rows."""
    for batch in batches:
        only = batch.column(1).fill_null(ALL - 1).to_numpy(zero_copy_only=False)
        order = np.argsort(only, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(only[order])) + 1):
            for at in range(0, len(rows), STRIP):
                part = batch.take(pa.array(rows[at : at + STRIP]))
                x = np.column_stack([*(part.column(i).to_numpy() for i in range(3, part.num_columns)), np.ones(part.num_rows)])
                yield part.column(0).to_numpy(), only[rows[at : at + STRIP]], part.column(2).to_numpy(), x


def _member(fold: np.ndarray, only: np.ndarray, folds: np.ndarray) -> np.ndarray:
    """1 where a row is in the training set of a model, per row and model."""
    real = (only < ALL)[:, None]
    return np.where(real, (fold[:, None] != folds) | (folds == ALL), only[:, None] == folds).astype(float)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    e = np.exp(-np.abs(z))
    return np.where(z >= 0, 1.0, e) / (1.0 + e)


def _summed(rows: DataFrame, kernel, folds: np.ndarray, width: int) -> np.ndarray:
    """Sum ``kernel(fold, only, y, x, which) -> (width, which)`` over all rows: added in the task, then by (model, place).

    ``folds`` has the fold of each model. A synthetic row concerns the models of one fold only, a real one all of them;
    ``which`` numbers those.
    """
    models = len(folds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, models))
        seen = False
        for block in _blocks(batches):
            only = block[1][0]
            which = np.flatnonzero((folds == only) | (only < ALL))
            if len(which):
                total[:, which] += kernel(*block, which)
                seen = True
        if seen:
            place, model = np.divmod(np.arange(width * models), models)
            yield pa.RecordBatch.from_arrays([pa.array(model.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(total.ravel())], names=["model", "place", "value"])

    out = np.zeros((width, models))
    sums = with_library(rows).mapInArrow(run, "model int, place int, value double").groupBy("model", "place").agg(F.sum("value").alias("value"))
    found = sums.toArrow()  # models x width numbers
    out[found["place"].to_numpy(), found["model"].to_numpy()] = found["value"].to_numpy()
    return out


def fit_many(rows: DataFrame, cols: Sequence[str], fits: Sequence[Fit], tolerance: float = TOLERANCE) -> list[Fitted]:
    """Solve every fit on the stored ``rows`` of ``training_rows``. An empty training set gives zero coefficients.

    Fits that differ in ``max_iter`` alone take the same steps: the longest takes them, the others stop on its way.
    """
    d = len(cols) + 1
    squares = rows.agg(*[F.expr(f"avg({ident(c)} * {ident(c)})") for c in cols]).first()
    scale = np.array([*(np.sqrt(s) if s else 1.0 for s in squares), 1.0])  # conditions the systems; no result depends on it
    upper = np.triu_indices(d)
    width = len(upper[0]) + d + 2

    def sums(active: list[int], weights: np.ndarray) -> np.ndarray:
        folds = np.array([fits[m].fold for m in active])

        def kernel(fold, only, y, x, which):
            x = x / scale
            inside = _member(fold, only, folds[which])
            z = x @ weights[:, which]
            p = _sigmoid(z)
            squared = x[:, upper[0]] * x[:, upper[1]]
            loss = inside * (np.logaddexp(0.0, z) - y[:, None] * z)
            return np.vstack([squared.T @ (inside * p * (1.0 - p)), x.T @ (inside * (p - y[:, None])), loss.sum(axis=0), inside.sum(axis=0)])

        return _summed(rows, kernel, folds, width)

    at = np.zeros((d, len(fits)))  # where each model stands, in scaled features
    state = [{"loss": np.inf, "step": 1.0, "move": np.zeros(d), "gradient": np.inf, "rows": 0, "steps": 0} for _ in fits]
    alike: dict[tuple, list[int]] = {}
    for m in sorted(range(len(fits)), key=lambda m: -fits[m].max_iter):
        alike.setdefault((fits[m].C, fits[m].fold), []).append(m)
    waiting = {own[0]: own[1:] for own in alike.values()}  # by the longest of its kind
    active = sorted(waiting)
    while active:
        tried = np.column_stack([at[:, m] - state[m]["step"] * state[m]["move"] for m in active])
        found = sums(active, tried)
        still = []
        for i, m in enumerate(active):
            s, beta, total = state[m], tried[:, i], found[:, i]
            n = total[-1]
            if not n:
                for each in (m, *waiting[m]):
                    state[each] |= {"gradient": 0.0, "loss": 0.0}
                continue
            penalty = np.append(1.0 / (fits[m].C * n) / scale[:-1] ** 2, 0.0)
            loss = total[-2] / n + 0.5 * penalty @ beta**2
            s["steps"] += 1
            if loss > s["loss"] * (1 + 1e-12) and s["step"] > LEAST_STEP:
                s["step"] /= 2  # a step that made it worse is halved
                still.append(m)
                continue
            gradient = total[-2 - d : -2] / n + penalty * beta
            hessian = np.zeros((d, d))
            hessian[upper] = total[: len(upper[0])] / n
            hessian += np.triu(hessian, 1).T + np.diag(penalty)
            at[:, m] = beta
            s |= {"loss": loss, "step": 1.0, "rows": int(n), "gradient": float(np.abs(gradient * scale).max())}
            for other in [o for o in waiting[m] if s["gradient"] <= tolerance or s["steps"] > fits[o].max_iter]:
                at[:, other], state[other] = beta, dict(s)
                waiting[m].remove(other)
            if s["gradient"] > tolerance and s["steps"] <= fits[m].max_iter:
                s["move"] = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
                still.append(m)
        active = still
    beta = at / scale[:, None]
    return [Fitted(f, beta[:-1, m], float(beta[-1, m]), s["rows"], max(0, s["steps"] - 1), s["gradient"], s["loss"]) for m, (f, s) in enumerate(zip(fits, state, strict=True))]


def _weights(models: Sequence[Fitted]) -> np.ndarray:
    return np.column_stack([np.append(m.coefficients, m.intercept) for m in models])


def accuracies(rows: DataFrame, models: Sequence[Fitted]) -> list[float | None]:
    """Share of right decisions at 0.5 of each model on the real rows of its own fold; None without such rows."""
    weights, folds = _weights(models), np.array([m.fit.fold for m in models])

    def kernel(fold, only, y, x, which):
        tested = (only < ALL)[:, None] & (fold[:, None] == folds[which])
        right = tested & ((x @ weights[:, which] > 0) == (y[:, None] > 0))
        return np.vstack([right.sum(axis=0), tested.sum(axis=0)]).astype(float)

    right, tested = _summed(rows, kernel, folds, 2)
    return [float(r / t) if t else None for r, t in zip(right, tested, strict=True)]


def fitted_moments(rows: DataFrame, cols: Sequence[str], models: Sequence[Fitted]) -> list[tuple[Fitted, str, float]]:
    """``(model, feature, moment)``: at the optimum, and only there, the moment equals that of the labels.

    The moment of the fit is sum(p x) + coefficient / C, that of the labels sum(y x), both divided by sum(|x|).
    """
    weights, folds, d = _weights(models), np.array([m.fit.fold for m in models]), len(cols) + 1

    def kernel(fold, only, y, x, which):
        inside = _member(fold, only, folds[which])
        return np.vstack([x.T @ (inside * _sigmoid(x @ weights[:, which])), np.abs(x).T @ inside])

    sums = _summed(rows, kernel, folds, 2 * d)
    penalty = np.vstack([weights[:-1] / np.array([m.fit.C for m in models]), np.zeros(len(models))])
    moments = (sums[:d] + penalty) / np.where(sums[d:] == 0, 1.0, sums[d:])
    return [(m, name, float(moments[j, i])) for i, m in enumerate(models) for j, name in enumerate([*cols, "intercept"])]


LOGISTIC_GRID: Mapping[str, Sequence] = {"C": (0.1, 13.0, 15.0, 20.0, 40.0), "max_iter": (500, 1000)}


@dataclass
class Search:
    """Every (setting, fold) with its accuracy, the settings by mean accuracy, and the best one fitted on all rows."""

    runs: list[tuple[Fitted, float | None]]
    means: list[tuple[Fit, float]]
    best: Fitted
    rows: DataFrame


def logistic_search(df: DataFrame, key: str, cols: Sequence[str], label: str, fold: str, grid: Mapping[str, Sequence] = LOGISTIC_GRID, oversample: bool = True, k: int = 5, seed: int = 250) -> Search:
    """All settings of the grid on all folds of the column ``fold``, and the refit, in one series of scans.

    With ``oversample`` each fold's training rows are balanced by their own synthetic rows, which no fold is tested on. Of
    equal means the first setting of the grid wins.
    """
    folds = sorted(r[0] for r in df.select(F.col(fold).cast("int")).distinct().limit(1001).collect())
    if len(folds) > 1000:
        raise ValueError(f"{fold} has over 1000 values and numbers no folds")
    rows = training_rows(df, cols, label, fold)
    if oversample:
        made = synthetic_by_fold(df, key, cols, label, fold, [*folds, ALL], k, seed)
        rows = rows.unionByName(training_rows(made, cols, label))
    rows = stage(rows, "search")
    settings = [Fit(C=c, max_iter=n) for c, n in product(grid["C"], grid["max_iter"])]
    fits = [Fit(s.C, s.max_iter, f) for s in settings for f in [*folds, ALL]]
    models = fit_many(rows, cols, fits)
    tested = [m for m in models if m.fit.fold != ALL]
    runs = list(zip(tested, accuracies(rows, tested), strict=True))
    means = []
    for s in settings:
        own = [a for m, a in runs if (m.fit.C, m.fit.max_iter) == (s.C, s.max_iter) and a is not None]
        means.append((s, float(np.mean(own)) if own else float("nan")))
    top = max(means, key=lambda m: m[1])[0]
    return Search(runs, means, next(m for m in models if m.fit == Fit(top.C, top.max_iter, ALL)), rows)


class LinearLogisticModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Class probabilities from coefficients; saved, loaded and voted like Spark's own models."""

    coefficients = Param(Params._dummy(), "coefficients", "one per feature", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)
    featuresCol = Param(Params._dummy(), "featuresCol", "feature vector", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "vector of both probabilities; empty: none", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "decision at 0.5; empty: none", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, coefficients: Sequence[float] | None = None, intercept: float | None = None):
        super().__init__()
        self._setDefault(intercept=0.0, featuresCol="features", probabilityCol="probability", predictionCol="prediction")
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def setProbabilityCol(self, name: str) -> LinearLogisticModel:
        return self._set(probabilityCol=name)

    def setPredictionCol(self, name: str) -> LinearLogisticModel:
        return self._set(predictionCol=name)

    def setRawPredictionCol(self, name: str) -> LinearLogisticModel:
        """There is no such column."""
        return self

    def _transform(self, dataset: DataFrame) -> DataFrame:
        o = self.getOrDefault
        weights = F.array(*[F.lit(float(c)) for c in o("coefficients")])
        products = F.zip_with(vector_to_array(o("featuresCol")), weights, lambda x, w: x * w)
        margin = F.aggregate(products, F.lit(float(o("intercept"))), lambda s, v: s + v)
        p = F.when(margin >= 0, 1.0 / (1.0 + F.exp(-margin))).otherwise(F.exp(margin) / (1.0 + F.exp(margin)))
        out = dataset
        if o("probabilityCol"):
            out = out.withColumn(o("probabilityCol"), array_to_vector(F.array(1.0 - p, p)))
        if o("predictionCol"):
            out = out.withColumn(o("predictionCol"), (margin > 0).cast("double"))
        return out


class NewtonLogistic(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """One logistic regression as an estimator over ``features`` and ``label``; fits inside ``Smoted`` and pipelines."""

    C = Param(Params._dummy(), "C", "inverse strength of the penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, C: float = 1.0, maxIter: int = 100):
        super().__init__()
        self._setDefault(C=1.0, maxIter=100)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LinearLogisticModel:
        size = dataset.select(F.size(vector_to_array("features")).alias("n")).first()
        cols = [f"x{i}" for i in range(size["n"] if size else 0)]
        wide = dataset.select(F.col("label").cast("double").alias("_label"), vector_to_array("features").alias("_x"))
        wide = wide.select("_label", *[F.col("_x")[i].alias(c) for i, c in enumerate(cols)])
        rows = stage(training_rows(wide, cols, "_label"), "newton")
        (found,) = fit_many(rows, cols, [Fit(self.getOrDefault("C"), self.getOrDefault("maxIter"))])
        return LinearLogisticModel(coefficients=[float(c) for c in found.coefficients], intercept=found.intercept)
