"""Classifiers, soft voting, grid search and versioned model storage on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callwise.operators.splits import SEED


class RidgeLogistic(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Logistic regression with an L2 penalty of inverse strength C on unscaled features.

    C weighs the summed loss. Spark averages the loss, so the penalty is 1 / (C * total weight) and is known only
    when the rows are: at fit, after any oversampling.
    """

    C = Param(Params._dummy(), "C", "inverse strength of the penalty", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    weightCol = Param(Params._dummy(), "weightCol", "row weights", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, C: float = 1.0, maxIter: int = 100, weightCol: str | None = None):
        super().__init__()
        self._setDefault(C=1.0, maxIter=100)
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> Model:
        weight = self.getOrDefault("weightCol") if self.isSet("weightCol") else None
        total = dataset.agg(F.sum(weight) if weight else F.count("*")).collect()[0][0]
        solver = LogisticRegression(
            featuresCol="features",
            labelCol="label",
            elasticNetParam=0.0,
            standardization=False,
            regParam=1.0 / (self.getOrDefault("C") * total),
            maxIter=self.getOrDefault("maxIter"),
        )
        return (solver.setWeightCol(weight) if weight else solver).fit(dataset)


def logistic(C: float = 1.0, max_iter: int = 100, weight: str | None = None) -> RidgeLogistic:
    return RidgeLogistic(C=C, maxIter=max_iter, weightCol=weight)


def random_forest(
    trees: int = 100, depth: int = 15, features: str = "sqrt", seed: int = SEED, weight: str | None = None
) -> RandomForestClassifier:
    """``depth`` is bounded because Spark grows trees level by level; 30 is its ceiling."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy=features, seed=seed
    )
    return forest.setWeightCol(weight) if weight else forest


def mlp(inputs: int, hidden: int = 100, max_iter: int = 300, solver: str = "l-bfgs", seed: int = SEED) -> MultilayerPerceptronClassifier:
    """One hidden layer of sigmoid units and two outputs."""
    return MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="label", layers=[inputs, hidden, 2], maxIter=max_iter, solver=solver, seed=seed
    )


def assemble(df: DataFrame, cols: Sequence[str], label: str | None = None) -> DataFrame:
    out = VectorAssembler(inputCols=list(cols), outputCol="features").transform(df)
    return out if label is None else out.withColumn("label", F.col(label).cast("double"))


def soft_vote(cols: Sequence[str]) -> Column:
    """Mean of the members' probabilities."""
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return total / F.lit(float(len(cols)))


def positive_probability(model: Model, df: DataFrame, name: str = "score") -> DataFrame:
    """Add the probability of class 1 and drop the model's own output columns."""
    scored = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return scored.drop(*[c for c in ("rawPrediction", "probability", "prediction") if c not in df.columns])


class SoftVote(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Average the class-1 probabilities of several probability columns into one score."""

    cols = Param(Params._dummy(), "cols", "probability vectors", TypeConverters.toListString)
    name = Param(Params._dummy(), "name", "score column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, cols: Sequence[str] | None = None, name: str = "score"):
        super().__init__()
        self._setDefault(name="score")
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.getOrDefault("cols")
        member = {f"_p{i}": vector_to_array(c)[1] for i, c in enumerate(cols)}
        scored = dataset.withColumns(member).withColumn(self.getOrDefault("name"), soft_vote(list(member)))
        return scored.drop(*member, *cols)


def voting_model(models: Mapping[str, Model], cols: Sequence[str]) -> PipelineModel:
    """One model from several: assemble the features, run each member, average the probabilities into ``score``."""
    stages: list = [VectorAssembler(inputCols=list(cols), outputCol="features")]
    for name, model in models.items():
        # drop the outputs nobody reads; each member writes its own probability column
        stages.append(model.copy().setProbabilityCol(f"prob_{name}").setRawPredictionCol("").setPredictionCol(""))
    stages.append(SoftVote(cols=[f"prob_{name}" for name in models]))
    return PipelineModel(stages=stages)


def save_version(model: PipelineModel, root: str, version: str) -> str:
    path = f"{root.rstrip('/')}/{version}"
    model.write().overwrite().save(path)
    return path


def load_version(spark: SparkSession, root: str, version: str) -> PipelineModel:
    return PipelineModel.read().session(spark).load(f"{root.rstrip('/')}/{version}")


LOGISTIC_GRID = {"C": [0.1, 13.0, 15.0, 20.0, 40.0], "maxIter": [500, 1000]}
FOREST_GRID = {"maxDepth": [3, 4, 5, 10], "numTrees": [40, 50, 60, 200], "featureSubsetStrategy": ["auto", "sqrt", "log2"]}
MLP_HIDDEN = (50, 100, 150)
MLP_SOLVERS = ("l-bfgs", "gd")


def mlp_grid(inputs: int) -> dict[str, list]:
    return {"layers": [[inputs, h, 2] for h in MLP_HIDDEN], "solver": list(MLP_SOLVERS)}


def grid_search(estimator: Estimator, grid: Mapping[str, Sequence], fold_col: str, folds: int, parallelism: int = 4) -> CrossValidator:
    """Every setting of the grid on every given fold, mean accuracy, best setting refit on all rows.

    ``estimator`` may be a ``Smoted`` wrapper: the grid then belongs to what it wraps.
    """
    tuned = getattr(estimator, "inner", estimator)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(tuned.getParam(name), list(values))
    return CrossValidator(
        estimator=estimator,
        estimatorParamMaps=builder.build(),
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy", labelCol="label"),
        numFolds=folds,
        foldCol=fold_col,
        parallelism=parallelism,
    )


def grid_results(model: CrossValidatorModel) -> list[tuple[dict, float]]:
    """Settings with their mean accuracy."""
    return [({p.name: v for p, v in m.items()}, a) for m, a in zip(model.getEstimatorParamMaps(), model.avgMetrics)]
