"""Exact k nearest neighbors among the rows of one class, without comparing all pairs.

1. Copies collapse: rows with equal features become one point. A point keeps its k + 1 smallest ids, since no row
   can have more of its copies among its k neighbors when ties go to the smaller id. The number of copies is free.
2. Points are spread over cells around pivots that are themselves a hash sample of the points, so dense regions get
   more pivots and cells stay small.
3. A first pass searches each cell alone. The distance to the k-th neighbor found there bounds the true one.
4. A point then visits only those other cells that no bound rules out: the triangle inequality, the plane midway between
   the two pivots, and the box around the cell along the principal axes. Visits to a busy cell are
   cut into chunks and the points of a large cell into parts; each chunk meets each part, and the best of all parts are
   merged. So no task holds an unbounded group, however many points a cell has.

Nothing is dropped on the way: a cell is skipped only when none of its points can be nearer.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from callwise.functions.scalars import ident
from callwise.functions.skew import join_spread
from callwise.functions.workers import with_library
from callwise.sources.staging import stage

CELL_POINTS = 2_000
MAX_PIVOTS = 65_536
VISIT_ROWS = 20_000
HELD_ROWS = 8_000
MATRIX_ROWS = 512  # rows of a distance matrix held at once
AXES = 12  # leading principal axes along which cells have boxes
SLACK = 1e-9  # relative; keeps rounding in the bounds from excluding a tie


def minority_knn(
    df: DataFrame, key: str, cols: Sequence[str], label: str, k: int = 5, minority: object = 1, cell_points: int = CELL_POINTS
) -> DataFrame:
    """``(id, neighbor, rank, distance2)``: the k nearest other rows of the minority class by squared Euclidean
    distance, ties to the smaller id."""
    return nearest(df.filter(F.col(label) == F.lit(minority)), key, cols, k, cell_points)


def nearest(df: DataFrame, key: str, cols: Sequence[str], k: int, cell_points: int = CELL_POINTS) -> DataFrame:
    return nearest_staged(stage(feature_arrays(df, key, cols), "knn_rows"), k, cell_points)


def feature_arrays(df: DataFrame, key: str, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``(id, x, keep...)``; adding 0.0 turns -0.0 into 0.0, so equal points have equal arrays."""
    values = ", ".join(f"CAST({ident(c)} AS DOUBLE) + 0D" for c in cols)
    return df.select(F.col(key).cast("bigint").alias("id"), F.expr(f"array({values}) AS x"), *keep)


def nearest_staged(rows: DataFrame, k: int, cell_points: int = CELL_POINTS) -> DataFrame:
    """As ``nearest``, for rows ``(id, x)`` in a stored table."""
    few = Window.partitionBy("x").orderBy("id")
    points = stage(
        with_library(rows).withColumn("r", F.row_number().over(few))
        .filter(F.col("r") <= k + 1)  # pushed below the shuffle: a task ships at most k + 1 copies
        .groupBy("x")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("p", F.element_at("ids", 1)),
        "knn_points",
    )
    pivots = _pivots(points, ceil(points.count() / cell_points))
    cells = stage(_assign(points, pivots), "knn_cells") if len(pivots) > 1 else points.withColumns({"cell": F.lit(0), "far": F.lit(0.0)})
    local = _best(_search(cells.select("p", "x", "cell"), cells, k, own=True), k)
    if len(pivots) > 1:
        local = stage(local, "knn_local")
        visits = _visits(cells, local, pivots, k)
        wider = _search(visits, cells, k, own=False)
        local = _best(local.unionByName(wider), k)
    # from points back to rows: the copies of a row come first, then the ids of its neighbor points
    near = local.groupBy("p").agg(F.collect_list(F.struct("d2", "q")).alias("near"))  # k entries per point
    answers = points.select("x", "p", F.col("ids").alias("own")).join(near, "p", "left")
    found = join_spread(rows, answers, "x", tie="id")
    own = F.transform("own", lambda i: F.struct(F.lit(0.0).alias("d2"), i.alias("q")))
    others = F.filter(F.concat(own, F.coalesce("near", F.array().cast("array<struct<d2:double,q:bigint>>"))), lambda e: e["q"] != F.col("id"))
    ranked = found.select("id", F.posexplode(F.slice(F.array_sort(others), 1, k)).alias("pos", "e"))
    return ranked.select("id", F.col("e.q").alias("neighbor"), (F.col("pos") + 1).alias("rank"), F.col("e.d2").alias("distance2"))


def _pivots(points: DataFrame, wanted: int) -> np.ndarray:
    """A hash sample of the points, bounded by MAX_PIVOTS. It shapes the cells and never the result."""
    wanted = max(1, min(MAX_PIVOTS, wanted))
    if wanted == 1:
        return np.zeros((1, 1))
    rows = points.select("x").orderBy(F.xxhash64("x"), "x").limit(wanted).collect()
    return np.array([r["x"] for r in rows])


def _assign(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    shared = points.sparkSession.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centers = shared.value
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy())
                which, far = np.empty(len(x), dtype=np.int32), np.empty(len(x))
                for s in range(0, len(x), MATRIX_ROWS):
                    d = _distances(x[s : s + MATRIX_ROWS], centers)
                    which[s : s + MATRIX_ROWS] = d.argmin(axis=1)
                    far[s : s + MATRIX_ROWS] = np.sqrt(d.min(axis=1))
                yield pdf.assign(cell=which, far=far)

    return points.mapInPandas(place, "x array<double>, ids array<bigint>, p bigint, cell int, far double")


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, summed one dimension after the other: the same order as the SQL expression."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j][:, None] - b[:, j][None, :]
        out += gap * gap
    return out


def _search(queries: DataFrame, cells: DataFrame, k: int, own: bool) -> DataFrame:
    """Best k neighbor rows of each query point in each part of its cell, per (cell, chunk, part) group.

    Queries of a cell are cut into chunks of about VISIT_ROWS and its points into parts of about HELD_ROWS.
    """
    sizes = queries.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(VISIT_ROWS)).cast("int").alias("chunks"))
    held_sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(HELD_ROWS)).cast("int").alias("parts"))
    sizes = F.broadcast(sizes.join(held_sizes, "cell"))  # one row per cell, at most MAX_PIVOTS
    left = queries.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("p"), F.col("chunks")).cast("int"))
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("chunks", "parts")
    # fresh names for the columns: both sides may come from the same table
    right = cells.join(sizes, "cell").select(
        *[F.col(c).alias(c) for c in ("cell", "x", "ids", "p")],
        F.pmod(F.xxhash64("p"), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    )

    def look(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"p": np.array([], dtype="int64"), "q": np.array([], dtype="int64"), "d2": np.array([], dtype="float64")})
        if not len(asked) or not len(held):
            return empty
        x, y = np.stack(asked["x"].to_numpy()), np.stack(held["x"].to_numpy())
        ap, hp = asked["p"].to_numpy(), held["p"].to_numpy()
        number = np.array([len(i) for i in held["ids"]])
        flat, first = np.concatenate(held["ids"].to_list()), np.cumsum(number) - number
        width = min(k + 1, len(y))
        got = []
        for s in range(0, len(x), MATRIX_ROWS):
            d = _distances(x[s : s + MATRIX_ROWS], y)
            if own:
                d[ap[s : s + MATRIX_ROWS][:, None] == hp[None, :]] = np.inf
            edge = np.partition(d, width - 1, axis=1)[:, width - 1]
            i, j = np.nonzero((d <= edge[:, None]) & (d < np.inf))  # all ties of the last place stay in
            pair = np.repeat(np.arange(len(i)), number[j])  # a point stands for all of its ids
            inner = np.arange(len(pair)) - np.repeat(np.cumsum(number[j]) - number[j], number[j])
            q, who, d2 = flat[first[j][pair] + inner], i[pair], d[i, j][pair]
            order = np.lexsort((q, d2, who))
            place = np.arange(len(order)) - np.searchsorted(who[order], who[order])
            best = order[place < k]
            got.append(pd.DataFrame({"p": ap[s + who[best]], "q": q[best], "d2": d2[best]}))
        return pd.concat(got) if got else empty

    on = ["cell", "chunk", "part"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(look, "p bigint, q bigint, d2 double")


def _axes(pivots: np.ndarray) -> np.ndarray:
    """Orthonormal leading axes of the pivots, as columns. They shape the boxes and never the result."""
    return np.linalg.svd(pivots - pivots.mean(axis=0), full_matrices=False)[2][:AXES].T


def _boxes(cells: DataFrame, axes: np.ndarray) -> DataFrame:
    """``(cell, far, lo, hi)``: the largest distance from the pivot and the ends along every axis, one row per cell."""
    shared = cells.sparkSession.sparkContext.broadcast(axes)

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                order = np.argsort(pdf["cell"].to_numpy(), kind="stable")
                cell = pdf["cell"].to_numpy()[order]
                at = (np.stack(pdf["x"].to_numpy()) @ shared.value)[order]
                first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
                lo, hi = np.minimum.reduceat(at, first), np.maximum.reduceat(at, first)
                yield pd.DataFrame({"cell": cell[first], "far": np.maximum.reduceat(pdf["far"].to_numpy()[order], first), "lo": list(lo), "hi": list(hi)})

    width = range(axes.shape[1])
    found = cells.select("cell", "x", "far").mapInPandas(ends, "cell int, far double, lo array<double>, hi array<double>")
    return found.groupBy("cell").agg(
        F.max("far").alias("far"),
        F.array(*[F.min(F.col("lo")[i]) for i in width]).alias("lo"),
        F.array(*[F.max(F.col("hi")[i]) for i in width]).alias("hi"),
    )


def _visits(cells: DataFrame, local: DataFrame, pivots: np.ndarray, k: int) -> DataFrame:
    """``(p, x, cell)`` for each other cell that may hold something nearer than the k-th neighbor found so far."""
    axes = _axes(pivots)
    table = _boxes(cells, axes).orderBy("cell").toPandas()  # one row per pivot
    known = table["cell"].to_numpy(np.int32)
    lows, highs = np.array(table["lo"].to_list()), np.array(table["hi"].to_list())
    shared = cells.sparkSession.sparkContext.broadcast((known, pivots[known], table["far"].to_numpy(), axes, lows, highs))
    bound = local.groupBy("p").agg(F.when(F.count("*") >= k, F.max("d2")).alias("kth"))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, centers, radius, axes, lo, hi = shared.value
        for pdf in batches:
            if not len(pdf):
                continue
            x, mine = np.stack(pdf["x"].to_numpy()), pdf["cell"].to_numpy()
            kth = np.sqrt(pdf["kth"].fillna(np.inf).to_numpy(dtype="float64"))
            for s in range(0, len(x), MATRIX_ROWS):
                block, reach, own = x[s : s + MATRIX_ROWS], kth[s : s + MATRIX_ROWS], np.searchsorted(names, mine[s : s + MATRIX_ROWS])
                away2 = _distances(block, centers)
                away = np.sqrt(away2)
                # rounding is relative to the size of the distances involved
                may = away - radius[None, :] <= reach[:, None] + SLACK * (1.0 + away + radius[None, :])
                may[np.arange(len(block)), own] = False
                i, j = np.nonzero(may)
                if not len(i):
                    continue
                # a point of the other cell is nearer to its pivot than to this one: it lies behind the plane midway
                gap = np.sqrt(((centers[own[i]] - centers[j]) ** 2).sum(axis=1))
                near2, far2 = away2[i, own[i]], away2[i, j]
                beyond = (far2 - near2) <= 2 * gap * reach[i] + SLACK * (1.0 + far2 + radius[j] ** 2 + gap * gap)
                i, j = i[beyond], j[beyond]
                at = block @ axes
                outside2 = np.zeros(len(i))
                for axis in range(axes.shape[1]):
                    y = at[i, axis]
                    outside2 += np.maximum(np.maximum(lo[j, axis] - y, y - hi[j, axis]), 0.0) ** 2
                size = 1.0 + away[i, j] + radius[j] + np.abs(at[i]).max(axis=1)
                inside = np.sqrt(outside2) <= reach[i] + SLACK * size
                i, j = i[inside], j[inside]
                part = pdf.iloc[s + i]
                yield pd.DataFrame({"p": part["p"].to_numpy(), "x": part["x"].to_numpy(), "cell": names[j]})

    asked = cells.select("p", "x", "cell").join(bound, "p", "left")
    return asked.mapInPandas(choose, "p bigint, x array<double>, cell int")


def visited_share(rows: DataFrame, k: int, cell_points: int = CELL_POINTS) -> float:
    """Pairs of points that the search of ``nearest_staged`` compares, as a share of all pairs of points."""
    points = stage(rows.groupBy("x").agg(F.min("id").alias("p"), F.sort_array(F.collect_set("id")).alias("ids")).select("x", "ids", "p"), "knn_points")
    total = points.count()
    pivots = _pivots(points, ceil(total / cell_points))
    if len(pivots) < 2:
        return 1.0
    cells = stage(_assign(points, pivots), "knn_cells")
    local = stage(_best(_search(cells.select("p", "x", "cell"), cells, k, own=True), k), "knn_local")
    asked = _visits(cells, local, pivots, k).select("cell").unionByName(cells.select("cell")).groupBy("cell").agg(F.count("*").alias("asked"))
    held = cells.groupBy("cell").agg(F.count("*").alias("held"))
    return asked.join(held, "cell").agg(F.sum(F.col("asked") * F.col("held"))).first()[0] / total**2


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("p").orderBy("d2", "q")
    return found.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).drop("r")
