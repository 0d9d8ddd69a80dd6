"""Balancing a rare class by synthetic rows, at fit time only."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame, functions as F

from callwise.functions.scalars import ident
from callwise.functions.keyed import DRAWS, hash_integer
from callwise.functions.skew import join_spread
from callwise.functions.ranking import class_counts, hash_position
from callwise.operators.neighbors import feature_arrays, nearest_staged
from callwise.operators.splits import SEED
from callwise.sources.staging import local_rows, stage


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add ``n / (classes * n_class)``, so that every class weighs the same in total."""
    counts = df.groupBy(F.col(label).alias("_cls")).agg(F.count("*").alias("_m"))
    n, k = counts.agg(F.sum("_m"), F.count("*")).first()
    weights = counts.select("_cls", (F.lit(n or 0) / (F.lit(k) * F.col("_m"))).alias(name))
    plain = df.drop(name)
    return plain.join(weights, plain[label].eqNullSafe(weights["_cls"])).drop("_cls")


def synthetic_rows(df: DataFrame, key: str, cols: Sequence[str], label: str, k: int = 5, seed: int = SEED) -> DataFrame | None:
    """``(j, base, neighbor, gap, cols..., label)``: the rows that bring the rare class to the size of the common one.

    Synthetic row j lies on the segment from a rare row to one of its k nearest rare neighbors. Base row, neighbor
    and position on the segment come from hashes of (seed, j), so the result does not depend on partitioning.
    Columns are interpolated as they are, category codes included.
    """
    counts = class_counts(df, label)
    if len(counts) != 2:
        raise ValueError(f"two classes expected in {label}, found {len(counts)}")
    rare = min(counts, key=lambda c: (counts[c], c))
    missing = sum(counts.values()) - 2 * counts[rare]
    if missing == 0:
        return None
    if counts[rare] < 2:
        raise ValueError("the rare class needs at least two rows")
    spark = df.sparkSession
    minority = stage(feature_arrays(df.filter(F.col(label) == F.lit(rare)), key, cols), "minority")
    pairs = stage(nearest_staged(minority, k), "pairs")
    ends = minority.select(F.col("id").alias("neighbor"), F.col("x").alias("to"))
    # a row with many copies is the neighbor of all of them, hence the spread join
    around = join_spread(pairs, ends, "neighbor", tie="id").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "neighbor", "to"))).alias("around")
    )
    bases = hash_position(minority, "id", seed).join(around, "id")
    tag = lambda part: F.concat(F.lit(f"{seed}-"), F.col("j").cast("string"), F.lit(f"-{part}"))
    drawn = spark.range(missing).select(
        F.col("id").alias("j"),
        F.pmod(hash_integer(tag("base")), F.lit(counts[rare])).alias("pos"),
        hash_integer(tag("neighbor")).alias("pick"),
        (hash_integer(tag("gap")) / F.lit(DRAWS)).alias("gap"),
    )
    joined = drawn.join(bases, "pos").withColumn("end", F.element_at("around", (F.pmod("pick", F.size("around")) + 1).cast("int")))
    made = [F.expr(f"x[{i}] + gap * (end.to[{i}] - x[{i}]) AS {ident(c)}") for i, c in enumerate(cols)]
    label_type = df.schema[label].dataType
    return joined.select(
        "j", F.col("id").alias("base"), F.col("end.neighbor").alias("neighbor"), "gap", *made, F.lit(rare).cast(label_type).alias(label)
    )


#: The training set that leaves out no fold.
ALL = -1


def synthetic_by_fold(
    df: DataFrame, key: str, cols: Sequence[str], label: str, fold: str, folds: Sequence[int], k: int = 5, seed: int = SEED
) -> DataFrame:
    """``(for_fold, j, base, neighbor, gap, cols..., label)``: for each fold the rows of ``synthetic_rows`` on all other folds.

    One search serves all folds: each rare row is there once for every fold that trains on it, and a coordinate more, equal
    within a fold, keeps the folds further apart than any two rows are. Ids are numbered per fold in the order of the keys.
    """
    spark = df.sparkSession
    counts = {(r["l"], r["f"]): r["count"] for r in df.groupBy(F.col(label).alias("l"), F.col(fold).cast("int").alias("f")).count().limit(100_001).collect()}
    classes = sorted({c for c, _ in counts})
    if len(classes) != 2:
        raise ValueError(f"two classes expected in {label}, found {len(classes)}")
    sizes = {f: {c: sum(n for (l, g), n in counts.items() if l == c and (f == ALL or g != f)) for c in classes} for f in folds}
    rare = {f: min(classes, key=lambda c: (n[c], c)) for f, n in sizes.items()}
    if any(n[rare[f]] < 2 and len(set(n.values())) > 1 for f, n in sizes.items()):
        raise ValueError("the rare class needs at least two rows in each training set")
    wanted = [(f, str(rare[f]), sizes[f][rare[f]], abs(sizes[f][classes[0]] - sizes[f][classes[1]])) for f in folds]
    plan = F.broadcast(local_rows(spark, wanted, "for_fold int, rare string, rows bigint, missing bigint"))  # a row per fold
    x = feature_arrays(df.withColumns({"_fold": F.coalesce(F.col(fold).cast("int"), F.lit(ALL - 1)), "_rare": F.col(label).cast("string")}), key, cols, ["_fold", "_rare"])
    spans = x.agg(*[F.expr(f"max(x[{i}]) - min(x[{i}])") for i in range(len(cols))]).first()
    apart = 4.0 * (1.0 + sum((s or 0.0) ** 2 for s in spans) ** 0.5)
    copies = x.join(plan, (F.col("_rare") == F.col("rare")) & ((F.col("for_fold") == ALL) | (F.col("_fold") != F.col("for_fold"))))
    number = F.col("id") * (max(folds) - min(folds) + 1) + F.col("for_fold") - min(folds)
    minority = stage(copies.select("for_fold", F.col("id").alias("own"), number.alias("id"), "x", "rows"), "minority")
    placed = minority.select("id", F.concat("x", F.array(F.col("for_fold") * F.lit(apart))).alias("x"))
    pairs = stage(nearest_staged(stage(placed, "placed"), k), "pairs")
    ends = minority.select(F.col("id").alias("neighbor"), F.col("for_fold").alias("end_fold"), F.col("own").alias("end_own"), F.col("x").alias("to"))
    around = join_spread(pairs, ends, "neighbor", tie="id").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "end_own", "to", "end_fold"))).alias("around"))
    bases = hash_position(minority, "own", seed, by="for_fold").join(around, "id")
    bases = bases.withColumn("around", F.filter("around", lambda e: e["end_fold"] == F.col("for_fold"))).select("for_fold", "pos", "own", "x", "around", "rows")
    tag = lambda part: F.concat(F.lit(f"{seed}-"), F.col("j").cast("string"), F.lit(f"-{part}"))
    most = max((m for *_, m in wanted), default=0)
    drawn = spark.range(most).withColumnRenamed("id", "j").join(plan, F.col("j") < F.col("missing")).select(
        "for_fold", "j", F.pmod(hash_integer(tag("base")), F.col("rows")).alias("pos"), hash_integer(tag("neighbor")).alias("pick"), (hash_integer(tag("gap")) / F.lit(DRAWS)).alias("gap"), "rare"
    )
    joined = drawn.join(bases.drop("rows"), ["for_fold", "pos"]).withColumn("end", F.element_at("around", (F.pmod("pick", F.size("around")) + 1).cast("int")))
    made = [F.expr(f"x[{i}] + gap * (end.to[{i}] - x[{i}]) AS {ident(c)}") for i, c in enumerate(cols)]
    return joined.select("for_fold", "j", F.col("own").alias("base"), F.col("end.end_own").alias("neighbor"), "gap", *made, F.col("rare").cast(df.schema[label].dataType).alias(label))


def smote(df: DataFrame, key: str, cols: Sequence[str], label: str, k: int = 5, seed: int = SEED) -> DataFrame:
    """``(cols..., label)`` of the original rows and the synthetic ones: both classes are equally large."""
    original = df.select(*[F.col(c).cast("double").alias(c) for c in cols], label)
    extra = synthetic_rows(df, key, cols, label, k, seed)
    return original if extra is None else original.unionByName(extra.select(*cols, label))


def smote_keyed(df: DataFrame, key: str, cols: Sequence[str], label: str, k: int = 5, seed: int = SEED, fold: str | None = None, folds: Sequence[int] = (ALL,)) -> DataFrame:
    """As ``smote``, with the key kept: a synthetic row has the key -1 - j, counted on over the folds. With ``fold`` the rows
    keep that column, and ``for_fold`` tells for which fold a synthetic row was made (null: a real row)."""
    values = [F.col(c).cast("double").alias(c) for c in cols]
    own = F.lit(ALL) if fold is None else F.col(fold).cast("int")
    real = df.select(F.col(key).cast("bigint").alias(key), own.alias("fold"), F.lit(None).cast("int").alias("for_fold"), *values, label)
    made = synthetic_by_fold(df.withColumn("_own", own), key, cols, label, "_own", folds, k, seed)
    place = {f: i for i, f in enumerate(folds)}
    number = F.create_map(*[F.lit(x) for f, i in place.items() for x in (f, i)])[F.col("for_fold")]
    extra = made.select((-1 - (F.col("j") * len(place) + number)).alias(key), F.lit(ALL).alias("fold"), "for_fold", *cols, label)
    return real.unionByName(extra)


class Smoted(Estimator):
    """Fit an estimator on oversampled rows and return its model as it is.

    The oversampling exists in ``fit`` only. As a Transformer in a Pipeline it would also run on the rows that are
    scored, and evaluation folds would hold synthetic rows.
    """

    key = Param(Params._dummy(), "key", "row id", TypeConverters.toString)
    cols = Param(Params._dummy(), "cols", "feature columns in order", TypeConverters.toListString)
    label = Param(Params._dummy(), "label", "class column", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "neighbors", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        inner: Estimator | None = None,
        key: str | None = None,
        cols: Sequence[str] | None = None,
        label: str = "label",
        k: int = 5,
        seed: int = SEED,
    ):
        super().__init__()
        self.inner = inner
        self._setDefault(label="label", k=5, seed=SEED)
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None and n != "inner"})

    def balanced(self, dataset: DataFrame) -> DataFrame:
        o = self.getOrDefault
        rows = smote(dataset, o("key"), o("cols"), o("label"), o("k"), o("seed"))
        rows = VectorAssembler(inputCols=o("cols"), outputCol="features").transform(rows)
        return stage(rows.select("features", F.col(o("label")).cast("double").alias("label")), "smoted")

    def _fit(self, dataset: DataFrame):
        return self.inner.fit(self.balanced(dataset))

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence) -> Iterator:
        # one oversampling serves all settings of a grid
        return self.inner.fitMultiple(self.balanced(dataset), paramMaps)

    def copy(self, extra=None):
        that = super().copy(extra)
        that.inner = self.inner.copy(extra)
        return that
