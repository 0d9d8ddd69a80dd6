"""Feature preparation: quartile clamping, imputation, category codes, standardization.

Each step is a Spark ML Estimator or Transformer that saves and loads like the built-in ones. Fitted numbers enter the plan
as literals. Category codes are a table of any size, saved with the model and joined; Spark broadcasts it where its size
allows, so that a pipeline with usual dictionaries is one narrow projection without a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from callwise.functions.quantiles import quantiles
from callwise.functions.scalars import ident, is_integral, is_numeric, literal, nan_to_null
from callwise.operators.stats import value_counts
from callwise.sources.staging import fresh_path, stage


class _Cols(Params):
    cols = Param(Params._dummy(), "cols", "columns to work on", TypeConverters.toListString)

    def get_cols(self) -> list[str]:
        return self.getOrDefault(self.cols)


class _Fitted(_Cols):
    """Fitted parameters as one JSON text, so that the default reader and writer can keep them."""

    fitted = Param(Params._dummy(), "fitted", "fitted parameters, JSON", TypeConverters.toString)

    def values(self):
        return json.loads(self.getOrDefault(self.fitted))


Fences = dict[str, tuple[float, float]]


def _fences(df: DataFrame, cols: Sequence[str], factor: float, group: str | None = None) -> dict[object, Fences]:
    """Lower and upper clamp per column, for the whole table (key None) or per group. A column without any value has
    none. Two numbers per group and column reach the driver."""
    found: dict[object, dict[str, dict[float, float]]] = {None: {}} if group is None else {}
    for r in quantiles(df, cols, [0.25, 0.75], [group] if group else []).collect():
        if r["value"] is not None:
            found.setdefault(r[group] if group else None, {}).setdefault(r["feature"], {})[r["prob"]] = r["value"]
    return {
        g: {c: (q[0.25] - factor * (q[0.75] - q[0.25]), q[0.75] + factor * (q[0.75] - q[0.25])) for c, q in per.items()}
        for g, per in found.items()
    }


def _apply_clamp(df: DataFrame, fences: dict[object, Fences], group: str | None = None) -> DataFrame:
    cols = sorted({c for per in fences.values() for c in per})
    df = nan_to_null(df, cols)
    out = {}
    for c in cols:
        cases = []
        for g, per in fences.items():
            if c in per:
                mine = clamp_sql(c, *per[c])
                cases.append(mine if group is None else f"WHEN {ident(group)} <=> {literal(g)} THEN {mine}")
        out[c] = F.expr(cases[0] if group is None else f"CASE {' '.join(cases)} ELSE CAST({ident(c)} AS DOUBLE) END")
    return df.withColumns(out) if out else df


def clamp_sql(c: str, lo: float, hi: float) -> str:
    x = f"CAST({ident(c)} AS DOUBLE)"
    return f"(CASE WHEN {x} < {literal(lo)} THEN {literal(lo)} WHEN {x} > {literal(hi)} THEN {literal(hi)} ELSE {x} END)"


class BatchWinsorizer(Transformer, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Clamp to the quartile fences of the very batch that is transformed, or of each batch in a table that holds
    several, told apart by the column ``group``."""

    factor = Param(Params._dummy(), "factor", "fence width in interquartile ranges", TypeConverters.toFloat)
    group = Param(Params._dummy(), "group", "column that tells batches apart, if the table has it", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, cols: Sequence[str] | None = None, factor: float = 1.5, group: str | None = None):
        super().__init__()
        self._setDefault(factor=1.5)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        group = self.getOrDefault(self.group) if self.isSet(self.group) else None
        group = group if group in dataset.columns else None
        return _apply_clamp(dataset, _fences(dataset, self.get_cols(), self.getOrDefault(self.factor), group), group)


class FittedWinsorizer(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Clamp to the quartile fences of the fit set."""

    factor = Param(Params._dummy(), "factor", "fence width in interquartile ranges", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, cols: Sequence[str] | None = None, factor: float = 1.5):
        super().__init__()
        self._setDefault(factor=1.5)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> WinsorizerModel:
        fences = _fences(dataset, self.get_cols(), self.getOrDefault(self.factor))[None]
        return WinsorizerModel()._set(cols=self.get_cols(), fitted=json.dumps(fences))


class WinsorizerModel(Model, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        return _apply_clamp(dataset, {None: {c: tuple(b) for c, b in self.values().items()}})


def iqr_winsorizer(
    cols: Sequence[str], factor: float = 1.5, bounds: str = "batch", group: str | None = None
) -> Transformer | Estimator:
    """``bounds="batch"`` takes the fences from each batch it is applied to, ``"fitted"`` freezes them at fit."""
    if bounds not in ("batch", "fitted"):
        raise ValueError(bounds)
    if bounds == "batch":
        return BatchWinsorizer(cols=list(cols), factor=factor, group=group)
    return FittedWinsorizer(cols=list(cols), factor=factor)


class MedianImputer(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Null or NaN becomes the exact median of the fit set."""

    @keyword_only
    def __init__(self, *, cols: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ImputerModel:
        rows = quantiles(dataset, self.get_cols(), [0.5]).collect()  # one number per column
        fitted = {r["feature"]: r["value"] for r in rows if r["value"] is not None}
        return ImputerModel()._set(cols=self.get_cols(), fitted=json.dumps(fitted))


class ModeImputer(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Null becomes the most frequent value of the fit set; of equally frequent values the smallest."""

    @keyword_only
    def __init__(self, *, cols: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ImputerModel:
        rows = modes(dataset, self.get_cols()).collect()  # one value per column
        types = dict(dataset.dtypes)
        fitted = {r["feature"]: _typed(r["value"], types[r["feature"]]) for r in rows}
        return ImputerModel()._set(cols=self.get_cols(), fitted=json.dumps(fitted))


def _typed(text: str, dtype: str) -> str | int | float:
    """A whole number keeps all of its digits."""
    return int(text) if is_integral(dtype) else float(text) if is_numeric(dtype) else text


class ImputerModel(Model, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = nan_to_null(dataset, self.get_cols())
        types = dict(df.dtypes)
        fills = {}
        for c, v in self.values().items():
            # the median of whole numbers may be a fraction
            to = types[c] if not isinstance(v, float) or v.is_integer() else "double"
            fills[c] = F.expr(f"coalesce(CAST({ident(c)} AS {to}), CAST({literal(v)} AS {to}))")
        return df.withColumns(fills) if fills else df


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, value, n)`` of the most frequent value; a plain aggregate, combined before the shuffle."""
    best = F.min(F.struct((-F.col("n")).alias("m"), "num", "value"))
    return value_counts(df, cols).groupBy("feature").agg(best.alias("b")).select("feature", "b.value", (-F.col("b.m")).alias("n"))


def label_dictionary(df: DataFrame, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``(feature, value, num, code)``: each value's 0-based rank in the order of its own type (numbers as numbers).

    All columns in one pass: the distinct values are sorted by ranges, ranked inside each range, and the ranges of a column
    add up what lies before them, so no task holds a whole dictionary.
    """
    values = value_counts(df, cols).select("feature", "value", "num")
    order = ["feature", "num", "value"]
    ranged = values.repartitionByRange(*([partitions] if partitions else []), *order).withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "dictionary")
    before = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = ranged.groupBy("feature", "part").count().select("feature", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("feature", "part").orderBy("num", "value")
    ranked = ranged.withColumn("row", F.row_number().over(inside) - 1).join(starts, ["feature", "part"])
    return ranked.select("feature", "value", "num", (F.col("start") + F.col("row")).alias("code"))


class LabelEncoder(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Value to its rank among the sorted values of the fit set. An unseen value is an error, or -1 on request."""

    unseen = Param(Params._dummy(), "unseen", "error or code", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, cols: Sequence[str] | None = None, unseen: str = "error"):
        super().__init__()
        self._setDefault(unseen="error")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> LabelEncoderModel:
        path = fresh_path(dataset.sparkSession, "codes")
        label_dictionary(dataset, self.get_cols()).write.parquet(path)
        empty = set(self.get_cols()) - {r[0] for r in dataset.sparkSession.read.parquet(path).select("feature").distinct().collect()}
        if empty:
            raise ValueError(f"no values in {sorted(empty)}")
        return LabelEncoderModel()._set(cols=self.get_cols(), table=path, unseen=self.getOrDefault(self.unseen))


class _CodesWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.dictionary(SparkSession.active()).write.parquet(f"{path}/codes")


class _CodesReader(DefaultParamsReader):
    def load(self, path: str) -> LabelEncoderModel:
        return super().load(path)._set(table=f"{path}/codes")


class LabelEncoderModel(Model, _Cols, MLReadable, MLWritable):
    """The dictionary is a stored table ``(feature, value, num, code)``; saving the model copies it beside the parameters."""

    unseen = Param(Params._dummy(), "unseen", "error or code", TypeConverters.toString)
    table = Param(Params._dummy(), "table", "path of the dictionary", TypeConverters.toString)

    def write(self) -> DefaultParamsWriter:
        return _CodesWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _CodesReader(cls)

    def dictionary(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.getOrDefault(self.table))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        codes = self.dictionary(dataset.sparkSession)
        for c in self.get_cols():
            dataset = encode_with(dataset, codes, c, self.getOrDefault(self.unseen))
        return dataset


def encode_with(df: DataFrame, dictionary: DataFrame, col: str, unseen: str = "error") -> DataFrame:
    """Encode by joining a dictionary table of any size, the columns staying in their order. Spark broadcasts it if its
    size allows; beyond that a hot value is split by the skew join, as every row meets one code at most."""
    codes = dictionary.filter(F.col("feature") == col).select(F.col("value").alias("_v"), F.col("code").cast("double").alias("_code"))
    joined = df.join(codes, F.col(col).cast("string") == F.col("_v"), "left")
    if unseen == "error":
        text = F.coalesce(F.col(col).cast("string"), F.lit("null"))
        told = F.raise_error(F.concat(F.lit(f"unseen value in {col}: "), text)).cast("double")
    else:
        told = F.lit(-1.0)
    return joined.withColumn(col, F.coalesce("_code", told)).drop("_v", "_code")


def unseen_values(df: DataFrame, dictionary: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values of ``df`` that the dictionary lacks, with their counts."""
    known = dictionary.select("feature", "value")
    return value_counts(df, cols).join(known, ["feature", "value"], "left_anti").select("feature", "value", "n")


class Standardizer(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population standard deviation; a constant column becomes 0."""

    @keyword_only
    def __init__(self, *, cols: Sequence[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> StandardizerModel:
        cols = self.get_cols()
        df = nan_to_null(dataset, cols)
        moments = [x for i, c in enumerate(cols) for x in (F.avg(c).alias(f"m_{i}"), F.stddev_pop(c).alias(f"s_{i}"))]
        row = df.agg(*moments).collect()[0]  # two numbers per column
        fitted = {c: [row[f"m_{i}"], row[f"s_{i}"]] for i, c in enumerate(cols)}
        return StandardizerModel()._set(cols=cols, fitted=json.dumps(fitted))


class StandardizerModel(Model, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = nan_to_null(dataset, self.get_cols())
        return df.withColumns(
            {c: (F.col(c) - F.lit(m)) / F.lit(s or 1.0) for c, (m, s) in self.values().items() if m is not None}
        )


class FeatureTable(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Last step: the key, the features as doubles in their fixed order, and the columns to keep beside them."""

    key = Param(Params._dummy(), "key", "row id", TypeConverters.toString)
    cols = Param(Params._dummy(), "cols", "feature columns in order", TypeConverters.toListString)
    keep = Param(Params._dummy(), "keep", "other columns to keep when present", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, key: str | None = None, cols: Sequence[str] | None = None, keep: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(keep=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept = [c for c in self.getOrDefault(self.keep) if c in dataset.columns]
        features = [F.expr(f"CAST({ident(c)} AS DOUBLE) AS {ident(c)}") for c in self.getOrDefault(self.cols)]
        return dataset.select(self.getOrDefault(self.key), *features, *kept)


def feature_pipeline(
    key: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    keep: Sequence[str] = (),
    factor: float = 1.5,
    bounds: str = "batch",
    unseen: str = "error",
    group: str | None = None,
) -> Pipeline:
    """Numeric columns: clamp, then median. Categorical columns: most frequent value, then code.

    Clamping never moves a median (it lies between the quartiles, the fences lie outside them), so the medians are
    fitted on the raw columns and the fit needs no second pass over clamped data. ``group`` names a column that tells
    apart several batches in one table; each is then clamped by its own quartiles in the same pass.
    """
    numeric, categorical = list(numeric), list(categorical)
    return Pipeline(
        stages=[
            _ClampThenImpute(cols=numeric, factor=factor, bounds=bounds, group=group),
            _ImputeThenEncode(cols=categorical, unseen=unseen),
            FeatureTable(key=key, cols=numeric + categorical, keep=list(keep)),
        ]
    )


class _ClampThenImpute(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    factor = Param(Params._dummy(), "factor", "fence width in interquartile ranges", TypeConverters.toFloat)
    group = Param(Params._dummy(), "group", "column that tells batches apart", TypeConverters.toString)
    bounds = Param(Params._dummy(), "bounds", "batch or fitted", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, cols: Sequence[str] | None = None, factor: float = 1.5, bounds: str = "batch", group: str | None = None):
        super().__init__()
        self._setDefault(factor=1.5, bounds="batch")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        cols, factor = self.get_cols(), self.getOrDefault(self.factor)
        imputer = MedianImputer(cols=cols).fit(dataset)
        group = self.getOrDefault(self.group) if self.isSet(self.group) else None
        clamp_step = iqr_winsorizer(cols, factor, self.getOrDefault(self.bounds), group)
        if isinstance(clamp_step, Estimator):
            clamp_step = clamp_step.fit(dataset)
        return PipelineModel(stages=[clamp_step, imputer])


class _ImputeThenEncode(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """A mode is itself a category, so imputing adds none, and the codes are fitted on the same rows."""

    unseen = Param(Params._dummy(), "unseen", "error or code", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, cols: Sequence[str] | None = None, unseen: str = "error"):
        super().__init__()
        self._setDefault(unseen="error")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        cols = self.get_cols()
        encoder = LabelEncoder(cols=cols, unseen=self.getOrDefault(self.unseen)).fit(dataset)
        return PipelineModel(stages=[ModeImputer(cols=cols).fit(dataset), encoder])
