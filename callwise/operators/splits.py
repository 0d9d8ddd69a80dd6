"""Reproducible splits with exact class proportions.

Rows are put in the order of a hash of their id. A split is then a rank cut inside each class, and a rank cut is a
comparison with the (hash, id) pairs of its class, which are broadcast (classes x cuts of them), so the wide table is never
shuffled: only (id, label) is read to find the cuts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil
from typing import Any

from pyspark.sql import DataFrame, functions as F

from callwise.functions.keyed import hash_key
from callwise.functions.ranking import class_counts, keys_at_hash_ranks, keys_at_ranks
from callwise.sources.staging import local_rows

SEED = 250
SERVING_SHARE = 0.1
EVAL_SHARE = 0.2


def allocate(counts: Mapping[Any, int], share: float) -> dict[Any, int]:
    """``ceil(share * n)`` rows over the classes: the floor of each class's part, then the largest remainders."""
    n = sum(counts.values())
    total = min(n, ceil(share * n))
    parts = {c: divmod(total * m, n) if n else (0, 0) for c, m in counts.items()}
    left = total - sum(p[0] for p in parts.values())
    order = sorted(parts, key=lambda c: (-parts[c][1], c is not None, c))
    return {c: parts[c][0] + (order.index(c) < left) for c in counts}


def _runs(sizes: Sequence[Mapping[Any, int]]) -> dict[Any, list[int]]:
    """Rank at which each part ends, per class."""
    return {c: [sum(s[c] for s in sizes[: i + 1]) for i in range(len(sizes))] for c in sizes[0]}


def _part(df: DataFrame, label: str, me: str, kind: str, ends: Mapping[Any, Sequence[Any]], name: str) -> DataFrame:
    """Add ``name``: how many of its class's ends a row lies beyond. An end of None is one that nothing lies before."""
    cls_type = df.schema[label].dataType.simpleString()
    table = local_rows(df.sparkSession, [(c, list(e)) for c, e in ends.items()], f"_cls {cls_type}, _ends array<{kind}>")
    joined = df.join(F.broadcast(table), df[label].eqNullSafe(table["_cls"]), "left")
    return joined.withColumn(name, F.expr(f"size(filter(_ends, e -> e IS NULL OR e < {me}))")).drop("_cls", "_ends")


def cut_by_hash(df: DataFrame, key: str, label: str, names: Sequence[str], rest: str, sizes: Sequence[Mapping[Any, int]], seed: int, name: str = "split") -> DataFrame:
    """Add the split of each row: ``names[i]`` gets the next ``sizes[i][class]`` rows of its class, ``rest`` the others."""
    runs = _runs(sizes)
    cuts = keys_at_hash_ranks(df, key, label, seed, runs)
    ends = {c: [{"h": cuts[(c, r)][0], "k": cuts[(c, r)][1]} if r else None for r in ranks] for c, ranks in runs.items()}
    key_type = df.schema[key].dataType.simpleString()
    marked = df.withColumn("_me", F.struct(hash_key(F.col(key), seed).alias("h"), F.col(key).alias("k")))
    parted = _part(marked, label, "_me", f"struct<h:string,k:{key_type}>", ends, "_part").drop("_me")
    said = F.array(*[F.lit(n) for n in (*names, rest)])
    return parted.withColumn(name, F.coalesce(F.element_at(said, F.col("_part") + 1), F.lit(rest))).drop("_part")


def stratified_holdout(df: DataFrame, key: str, label: str, share: float, seed: int = SEED) -> DataFrame:
    """Add ``is_holdout`` for a share of the rows that keeps the class proportions."""
    sizes = [allocate(class_counts(df, label), share)]
    return cut_by_hash(df, key, label, ["holdout"], "rest", sizes, seed, "is_holdout").withColumn("is_holdout", F.col("is_holdout") == "holdout")


def three_way_split(df: DataFrame, key: str, label: str, serving: float = SERVING_SHARE, evaluation: float = EVAL_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``split``: a serving holdout, then an evaluation holdout of what remains, the rest for training.

    Holding out twice in the same hash order is the same as cutting that order at two ranks, so one pass does both.
    """
    counts = class_counts(df, label)
    first = allocate(counts, serving)
    second = allocate({c: n - first[c] for c, n in counts.items()}, evaluation)
    return cut_by_hash(df, key, label, ["serving", "eval"], "train", [first, second], seed)


def serving_emulation(split_df: DataFrame, label: str) -> DataFrame:
    """The serving split as it would arrive in production: without its label."""
    return split_df.filter(F.col("split") == "serving").drop(label, "split")


def fold_sizes(counts: Sequence[tuple[Any, int]], k: int) -> dict[Any, list[int]]:
    """Rows of each class in each fold. The classes are laid end to end and dealt out to the folds in turn, so every
    class is even to one row and so are the folds."""
    sizes, start = {}, 0
    for c, n in counts:
        sizes[c] = [(start + n - 1 - i) // k - (start - 1 - i) // k for i in range(k)]
        start += n
    return sizes


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 10, name: str = "fold") -> DataFrame:
    """Add the fold number 0..k-1. Folds are unshuffled: in each class a fold is a run of consecutive ids.

    Ids are numbers or texts, in the order of their type. Classes are laid out in the order of their smallest id. The cut
    ids are order statistics, found for all classes in one job, so the table itself is not sorted.
    """
    counts = class_counts(df, label)
    first = {r[0]: r[1] for r in df.groupBy(label).agg(F.min(key)).collect()}  # a row per class, which class_counts has bounded
    sizes = fold_sizes([(c, counts[c]) for c in sorted(counts, key=lambda c: first[c])], k)
    runs = {c: [sum(s[: i + 1]) for i in range(k - 1)] for c, s in sizes.items()}
    cuts = keys_at_ranks(df, key, label, runs)
    ends = {c: [cuts[(c, r)] if r else None for r in ranks] for c, ranks in runs.items()}
    marked = df.withColumn("_me", F.col(key))
    return _part(marked, label, "_me", df.schema[key].dataType.simpleString(), ends, name).drop("_me")
