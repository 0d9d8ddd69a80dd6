"""Near-duplicate embeddings: an exact metric range join over pivot cells.

Vectors are scaled to length one; a cosine of at least c is a distance of at most eps = sqrt(2 - 2 c), and an angle of at
most acos(c). Every vector is at home in the cell of its nearest pivot. A pair whose homes differ is met in the cell with
the smaller number: the other vector visits that cell unless the triangle inequality rules out all of its residents
(distance to the bisecting plane above eps, or the angle to the pivot outside the residents' range by more than acos(c)).
Cells are then independent. A large cell is cut into blocks, and each pair of blocks is one small task, so neither a hot
cell nor data without structure makes a large one. A task sends back counts and one link per vector, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callwise.llm.common import components, join_groups, reachable
from callwise.sources.staging import stage

COSINE = 0.95
CELL_ROWS = 2_048
VISIT_ROWS = 16_384
PIVOTS = 1_024  # the most there are, so what is broadcast is bounded; the number of pivots changes the work only
STRIP = 256
SLACK = 1e-9


def unit(column: pa.Array) -> list[np.ndarray]:
    """Vectors in double precision, scaled to length one; the largest component goes first, so nothing overflows."""
    out = []
    flat, at = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), column.offsets.to_numpy()
    for a, b in zip(at[:-1] - at[0], at[1:] - at[0], strict=True):
        v = flat[a:b] / np.abs(flat[a:b]).max()
        out.append(v / math.sqrt(v @ v))
    return out


def usable(name: str) -> str:
    """Not null, all components there and finite, one of them not zero."""
    bad = "x IS NULL OR isnan(x) OR abs(CAST(x AS DOUBLE)) = double('infinity')"
    return f"coalesce(NOT exists({name}, x -> {bad}) AND exists({name}, x -> x <> 0), false)"


def _stack(vectors: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and their matrix, by dimension."""
    size = np.array([len(v) for v in vectors])
    return {int(d): (np.flatnonzero(size == d), np.stack([vectors[i] for i in np.flatnonzero(size == d)])) for d in np.unique(size)}


def block_links(left: np.ndarray, right: np.ndarray | None, left_n: np.ndarray, right_n: np.ndarray | None, cosine: float):
    """Links between two blocks, or inside one: for each vector the members it links to, and the root of its local component.

    Works in strips of rows, so memory is bounded by the strip, and keeps labels instead of pairs.
    """
    other = left if right is None else right
    weight = (left_n if right is None else right_n).astype(np.float64)
    shift = 0 if right is None else len(left)
    labels = np.arange(len(left) + (0 if right is None else len(right)))
    links = np.zeros(len(labels), np.int64)
    for a in range(0, len(left), STRIP):
        near = left[a : a + STRIP] @ other.T >= cosine
        if right is None:
            near[np.arange(near.shape[0]), a + np.arange(near.shape[0])] = False
        links[a : a + near.shape[0]] += np.rint(near @ weight).astype(np.int64)
        if right is not None:
            links[shift:] += np.rint(left_n[a : a + near.shape[0]].astype(np.float64) @ near).astype(np.int64)
        for r in np.flatnonzero(near.any(1)):
            joined = np.unique(np.append(labels[shift + np.flatnonzero(near[r])], labels[a + r]))
            if len(joined) > 1:
                labels[np.isin(labels, joined)] = joined[0]
    return links, labels


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE, cell_rows: int = CELL_ROWS, visit_rows: int = VISIT_ROWS, pivots: int = PIVOTS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    n_links counts the other rows linked directly, component_id is the smallest vec_id reachable. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, nor do vectors of different dimension, nor rows
    without vec_id. Equal vectors collapse to one before the join. A repeated row counts as a row of its own.
    """
    spark = vectors.sparkSession
    reachable(spark)
    key = [F.xxhash64(F.lit(k), F.col("v")).alias(f"k{k}") for k in (1, 2)]
    read = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("v"))
    read = read.withColumn("ok", F.expr(usable("v")) & F.col("vec_id").isNotNull())
    rows = stage(read.select("vec_id", "ok", *key), "vectors")
    classes = read.filter("ok").select("vec_id", "v", *key).groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.count("*").alias("members"), F.first("v").alias("v"))
    classes = stage(classes, "classes")

    n = classes.count()
    wanted = max(1, min(pivots, -(-n // cell_rows)))
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(wanted).select("v").toArrow()["v"].combine_chunks()
    table = spark.sparkContext.broadcast({d: m for d, (_, m) in _stack(unit(sample) if len(sample) else []).items()})
    angle, eps = math.acos(cosine), math.sqrt(2 - 2 * cosine)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, off = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            size = np.zeros(batch.num_rows, np.int64)
            for d, (at, matrix) in _stack(unit(batch.column(1))).items() if batch.num_rows else ():
                size[at] = d
                if d in table.value:  # a dimension without a pivot is one cell
                    near = matrix @ table.value[d].T
                    home[at] = near.argmax(1)
                    off[at] = np.arccos(np.clip(near.max(1), -1, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(home), pa.array(off)], ["id", "dim", "home", "off"])

    residents = stage(classes.select("id", "v").mapInArrow(homes, "id bigint, dim bigint, home bigint, off double"), "homes")
    cells = residents.groupBy("dim", "home").agg(F.count("*").alias("n"), F.min("off").alias("low"), F.max("off").alias("high"))
    ranges = spark.sparkContext.broadcast({(r["dim"], r["home"]): (r["n"], r["low"], r["high"]) for r in cells.collect()})  # a row per pivot and dimension

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"at": [], "dim": [], "cell": [], "resident": []}
            for d, (at, matrix) in _stack(unit(batch.column(1))).items() if batch.num_rows else ():
                points = table.value.get(d)
                near = matrix @ points.T if points is not None else np.ones((len(at), 1))
                home = near.argmax(1)
                for j in range(near.shape[1]):
                    n_home, low, high = ranges.value.get((d, j), (0, 0.0, 0.0))
                    stays = home == j
                    goes = np.zeros(len(at), bool)
                    if n_home and points is not None:
                        gap = np.linalg.norm(points - points[j], axis=1)[home]
                        off = np.arccos(np.clip(near[:, j], -1, 1))
                        plane = (near[np.arange(len(at)), home] - near[:, j]) / np.maximum(gap, 1e-12)
                        goes = (home > j) & (plane <= eps + SLACK) & (off <= high + angle + SLACK) & (off >= low - angle - SLACK)
                    for flag, which in ((True, stays), (False, goes)):
                        k = np.flatnonzero(which)
                        out["at"].append(at[k])
                        out["dim"].append(np.full(len(k), d))
                        out["cell"].append(np.full(len(k), j))
                        out["resident"].append(np.full(len(k), flag))
            if out["at"]:
                at = pa.array(np.concatenate(out["at"]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in (0, 1, 2)), *(pa.array(np.concatenate(out[c])) for c in ("dim", "cell", "resident"))], ["id", "v", "members", "dim", "cell", "resident"])

    kind = dict(classes.dtypes)["v"]
    placed = classes.select("id", "v", "members").mapInArrow(visits, f"id bigint, v {kind}, members bigint, dim bigint, cell bigint, resident boolean")
    # blocks: residents against residents (once per pair of blocks) and residents against visitors
    counts = stage(placed.groupBy("dim", "cell").agg(F.count_if("resident").alias("r"), F.count_if(~F.col("resident")).alias("w")), "cells")
    counts = counts.select("dim", "cell", F.ceil(F.col("r") / cell_rows).alias("nr"), F.ceil(F.col("w") / visit_rows).alias("nw"))
    part = placed.join(F.broadcast(counts), ["dim", "cell"]).withColumn("b", F.pmod(F.xxhash64("id"), F.when(F.col("resident"), F.col("nr")).otherwise(F.col("nw"))))
    resident_tasks = "concat(transform(sequence(0L, nr - 1), o -> struct(least(b, o) AS x, greatest(b, o) AS y, true AS own)), IF(nw > 0, transform(sequence(0L, nw - 1), o -> struct(b AS x, o AS y, false AS own)), array()))"
    visitor_tasks = "transform(sequence(0L, nr - 1), o -> struct(o AS x, b AS y, false AS own))"
    tasks = part.select("id", "v", "members", "dim", "cell", "resident", "b", F.explode(F.expr(f"IF(resident, {resident_tasks}, {visitor_tasks})")).alias("t"))

    def task(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, members = group["id"].to_numpy(), group["members"].to_numpy()
        matrix = np.stack(unit(group["v"].combine_chunks()))
        own, x, y = group["t"][0].as_py()["own"], group["t"][0].as_py()["x"], group["t"][0].as_py()["y"]
        b = group["b"].to_numpy()
        first = (b == x) if own else group["resident"].to_numpy(zero_copy_only=False)
        if own and x == y:
            order = np.arange(len(ids))
            links, labels = block_links(matrix, None, members, None, cosine)
        else:
            order = np.concatenate([np.flatnonzero(first), np.flatnonzero(~first)])
            links, labels = block_links(matrix[first], matrix[~first], members[first], members[~first], cosine)
        live = np.flatnonzero(links)
        return pa.table({"id": ids[order[live]], "links": links[live], "root": ids[order[labels[live]]]})

    linked = stage(tasks.groupBy("dim", "cell", "t").applyInArrow(task, "id bigint, links bigint, root bigint"), "links")
    found = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    totals = linked.groupBy("id").agg(F.sum("links").alias("links"))
    named = (
        classes.select("k1", "k2", "id", "members")
        .join(totals, "id", "left")
        .join(found, F.col("id") == F.col("node"), "left")
        .select("k1", "k2", "members", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    good = join_groups(rows.filter("ok"), stage(named, "named"), ["k1", "k2"], "members", "vec_id").select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT ok").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
