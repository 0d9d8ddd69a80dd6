"""Hard-negative mining: exact integer scores by the method of the Four Russians.

Components become integers ``floor(scale * x)``. An anchor's dimensions are taken in groups of eight; for each group a
table holds the sums of all 256 subsets of its eight components. A candidate is stored as bit planes in two's complement:
a byte for each plane and group, whose bits tell which of the eight components have that bit. A score is built from the
sign plane down: shift what there is, add one table lookup for each group (the sign plane counts negative). No product of
components is formed and no score is approximate.

Candidates and anchors are packed into blocks once and written. A task meets an anchor block with a few candidate blocks,
so every (anchor block, candidate block) pair is scored in one place, whatever the labels or the number of equal vectors.
It sends the best few rows for each anchor. Two sweeps: the first finds the positives, the second the negatives in each
positive's range of scores.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no part, nor do those with
a component beyond ``LIMIT`` after scaling, whose scores would not fit a long; equal rows count once; an anchor meets
rows with another id only; vectors of unlike length are not compared; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from callwise.llm.common import reachable
from callwise.sources.staging import pin, stage

GROUP = 8
ANCHOR_BLOCK = 512
BLOCK = 4_096
STRIP = 1_024
#: Candidate blocks that meet an anchor block in one task.
TOGETHER = 4
LIMIT = 1 << 26
POSITIVES = 5
NEGATIVES = 5
SCALE = 256
#: A negative's share of the positive's score, as percentages.
LOWEST, HIGHEST = 80, 100

BLOCKS = "dims int, block bigint, ids array<bigint>, labels array<bigint>, planes int, packed binary"
ANCHORS = "dims int, block bigint, ids array<bigint>, labels array<bigint>, parts array<bigint>"


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Bytes ``(plane, group, row)`` of integers ``(row, dimension)``; the last plane is the sign."""
    n, dims = values.shape
    wide = np.zeros((n, -(-dims // GROUP) * GROUP), np.int64)
    wide[:, :dims] = values
    planes = int(np.maximum(wide, ~wide).max(initial=0)).bit_length() + 1
    out = np.empty((planes, wide.shape[1] // GROUP, n), np.uint8)
    for p in range(planes):
        out[p] = np.packbits(((wide >> p) & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables ``(group, subset, anchor)``: the sum of the components whose bits are set in the subset's number."""
    a, dims = anchors.shape
    groups = -(-dims // GROUP)
    wide = np.zeros((groups * GROUP, a), np.int64)
    wide[:dims] = anchors.T
    out = np.zeros((groups, 1 << GROUP, a), np.int64)
    for bit in range(GROUP):
        half = 1 << bit
        out[:, half : 2 * half] = out[:, :half] + wide[bit::GROUP][:, None, :]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products ``(row, anchor)``: shift, then add a lookup for each group, from the sign plane down."""
    total = np.zeros((planes.shape[2], tables.shape[2]), np.int64)
    looked = np.empty_like(total)
    for p in range(planes.shape[0] - 1, -1, -1):
        total <<= 1
        for g in range(planes.shape[1]):
            np.take(tables[g], planes[p, g], axis=0, out=looked, mode="clip")
            if p == planes.shape[0] - 1:
                total -= looked
            else:
                total += looked
    return total


def _rows(table: DataFrame, id_col: str, label: Column, vector: str, scale: float) -> DataFrame:
    x = F.transform(F.col(vector), lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    sound = F.forall(F.col(vector), lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double") * F.lit(float(scale))) < F.lit(float(LIMIT))))
    kept = table.filter(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & sound)
    return kept.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), x.alias("v")).distinct()


def _numbered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, list, list, np.ndarray]]:
    """Blocks of at most ``rows`` rows of one dimension, sorted by id."""
    held: dict[int, list] = {}

    def block(dims):
        ids, labels, values = zip(*sorted(held.pop(dims), key=lambda r: r[0]), strict=True)
        return dims, list(ids), list(labels), np.array(values, np.int64).reshape(len(ids), dims)

    for batch in batches:
        vectors = batch.column(2)
        flat, at = vectors.flatten().to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
        at = at - at[0]
        for i, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            dims = int(at[i + 1] - at[i])
            held.setdefault(dims, []).append((a, b, flat[at[i] : at[i + 1]]))
            if len(held[dims]) >= rows:
                yield block(dims)
    for dims in list(held):
        yield block(dims)


def _packed(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, ids, labels, values in _numbered(batches, rows):
            planes = bit_planes(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims], pa.int32()), pa.array([0], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.int64())), pa.array([planes.shape[0]], pa.int32()), pa.array([planes.tobytes()], pa.binary())],
                names=["dims", "block", "ids", "labels", "planes", "packed"],
            )

    return run


def _anchored(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, ids, labels, values in _numbered(batches, rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims], pa.int32()), pa.array([0], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.int64())), pa.array([values.ravel()], pa.list_(pa.int64()))],
                names=["dims", "block", "ids", "labels", "parts"],
            )

    return run


def _in_order(blocks: DataFrame) -> DataFrame:
    """Blocks numbered from 0 within their length of vectors; only their names are sorted, one for thousands of rows."""
    named = stage(blocks.withColumn("block", F.monotonically_increasing_id()), "blocks")
    names = named.select("dims", "block").withColumn("number", F.row_number().over(Window.partitionBy("dims").orderBy("block")).cast("bigint") - 1)
    return named.join(names, ["dims", "block"]).drop("block").withColumnRenamed("number", "block")


def _meetings(candidates: DataFrame, anchors: DataFrame, together: int) -> DataFrame:
    """One row per anchor block and candidate block; a task gets an anchor block with ``together`` candidate blocks."""
    c = candidates.select("dims", F.col("block").alias("c_block"), F.col("ids").alias("c_ids"), F.col("labels").alias("c_labels"), "planes", "packed")
    # one row per length of vectors, checked and small
    m = F.broadcast(pin(anchors.groupBy("dims").agg((F.max("block") + 1).alias("m"))))
    n = F.broadcast(pin(c.groupBy("dims").agg(F.max(F.floor(F.col("c_block") / F.lit(together))).alias("last"))))
    spread_c = c.join(m, "dims").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1))).drop("m")
    spread_c = spread_c.withColumn("salt", F.floor(F.col("c_block") / F.lit(together)))
    spread_a = anchors.join(n, "dims").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last")))).drop("last")
    return spread_c.join(spread_a.hint("shuffle_hash"), ["dims", "block", "salt"])


def _meet(row: dict) -> Iterator[tuple[int, np.ndarray]]:
    """``(anchor's place, its scores with the candidate block's rows)``."""
    dims, n = row["dims"], len(row["c_ids"])
    anchors = np.array(row["parts"], np.int64).reshape(len(row["ids"]), dims)
    tables = subset_sums(anchors)
    planes = np.frombuffer(row["packed"], np.uint8).reshape(row["planes"], -1, n)
    found = np.empty((len(anchors), n), np.int64)
    for at in range(0, n, STRIP):
        found[:, at : at + STRIP] = scores(tables, planes[:, :, at : at + STRIP]).T
    return enumerate(found)


def _best(values: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest, ties by place."""
    if len(values) > 4 * k:
        least = np.partition(values, len(values) - k)[len(values) - k]
        places = np.flatnonzero(values >= least)
        return places[np.argsort(-values[places], kind="stable")[:k]]
    return np.argsort(-values, kind="stable")[:k]


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = np.array(row["c_ids"], np.int64), np.array(row["c_labels"], np.int64)
                slots, others, found = [], [], []
                for slot, s in _meet(row):
                    places = np.flatnonzero((labels == row["labels"][slot]) & (ids != row["ids"][slot]))
                    places = places[_best(s[places], k)]
                    slots += [slot] * len(places)
                    others += ids[places].tolist()
                    found += s[places].tolist()
                blocks = [row["block"]] * len(slots)
                yield pa.RecordBatch.from_arrays([pa.array([row["dims"]] * len(slots), pa.int32()), *[pa.array(x, pa.int64()) for x in (blocks, slots, others, found)]], names=["dims", "block", "slot", "other", "score"])

    return run


def _negatives(k: int, lowest: int, highest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = np.array(row["c_ids"], np.int64), np.array(row["c_labels"], np.int64)
                targets: dict[int, list[int]] = {}
                for t in row["targets"]:
                    targets.setdefault(t["slot"], []).append(t["score"])
                out: tuple[list, ...] = ([], [], [], [])
                for slot, s in _meet(row):
                    for target in targets.get(slot, ()):
                        places = np.flatnonzero((labels != row["labels"][slot]) & (100 * s >= lowest * target) & (100 * s <= highest * target))
                        places = places[_best(s[places], k)]
                        for values, new in zip(out, ([slot] * len(places), [target] * len(places), ids[places].tolist(), s[places].tolist()), strict=True):
                            values += new
                size = len(out[0])
                yield pa.RecordBatch.from_arrays([pa.array([row["dims"]] * size, pa.int32()), *[pa.array(x, pa.int64()) for x in ([row["block"]] * size, *out)]], names=["dims", "block", "slot", "target", "other", "score"])

    return run


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best rows of each key with their rank; Spark limits each task's rows before they are shuffled."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    table: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label: Column | None = None,
    vector: str = "embedding",
    scale: float = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    anchor_block: int = ANCHOR_BLOCK,
    block: int = BLOCK,
    together: int = TOGETHER,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on the columns ``id`` and ``label``. A positive is one of the first rows of the anchor's
    label by score; its negatives are the first rows of other labels with ``lowest`` to ``highest`` percent of its score.
    """
    reachable(table.sparkSession)
    rows = _rows(table, id_col, F.col("label") if label is None else label, vector, scale)
    rows = stage(rows, "vectors")
    dealt = lambda part, size: part.repartition(max(1, -(-part.count() // size)))
    candidates = _in_order(dealt(rows, block).mapInArrow(_packed(block), BLOCKS))
    anchors = _in_order(dealt(rows.filter(is_anchor), anchor_block).mapInArrow(_anchored(anchor_block), ANCHORS))
    met = _meetings(candidates, anchors, together)
    best = "dims int, block bigint, slot bigint, other bigint, score bigint"
    at = ["dims", "block", "slot"]
    liked = stage(_first(met.mapInArrow(_positives(positives), best), at, positives), "positives")
    targets = liked.select("dims", "block", "slot", "score").distinct().groupBy("dims", "block").agg(F.collect_list(F.struct("slot", "score")).alias("targets"))
    ranged = _meetings(candidates, anchors.join(targets, ["dims", "block"]), together)
    found = _first(ranged.mapInArrow(_negatives(negatives, lowest, highest), "dims int, block bigint, slot bigint, target bigint, other bigint, score bigint"), [*at, "target"], negatives)
    named = anchors.select("dims", "block", F.posexplode("ids").alias("slot", "anchor_id"))
    positive = liked.join(named, at).select(*at, "anchor_id", F.col("other").alias("positive_id"), F.col("score").alias("target"))
    return positive.join(found, [*at, "target"]).select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), F.col("target").alias("positive_score"), F.col("score").alias("negative_score")
    )
