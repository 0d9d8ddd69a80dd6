"""What the corpus operators share: reading texts as Arrow batches, joins that survive hot keys, connected components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callwise.sources.staging import stage

#: A key is split when it holds more rows than this, or more than this share of all rows (so few keys ever are).
HOT_ROWS = 20_000
HOT_SHARE = 1_000
#: Links of one node in a task of ``components``, as long as this is above that share.
STAR_ROWS = 1_000


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reachable(spark: SparkSession) -> None:
    """Let Python workers find this library where the driver found it; an installed or shipped one is found as well."""
    known = spark.sparkContext.environment
    if ROOT not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(x for x in (known.get("PYTHONPATH"), ROOT) if x)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id bigint, text string)``: all other columns are left behind, whatever their names; null text is empty."""
    reachable(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def text_key(text: Column) -> Column:
    """Hash of a text; with the id it names a document, so that two texts of one id, or of none, stay apart."""
    return F.xxhash64(F.lit(7), F.octet_length(text), text)


def map_texts(docs: DataFrame, each: Callable[[list, list], dict], schema: str, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """Run ``each(ids, texts)`` over Arrow batches; it returns the columns of ``schema``, not necessarily a row per text.

    Texts come as UTF-8 bytes, whole. A batch is bounded by rows and by bytes, so memory does not grow with the table.
    """
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, raw = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
                out = each(ids, raw)
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in (out[n] for n in names)], names)

    return docs.select(*columns).mapInArrow(run, schema)


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], members: str, tie: str, total: int | None = None, hot_rows: int | None = None
) -> DataFrame:
    """Inner join of ``rows`` to ``groups`` (one row per key, ``members`` rows of ``rows`` each) with hot keys split.

    A key with over ``max(hot_rows, all / HOT_SHARE)`` rows (HOT_ROWS unless given) is cut by the hash of ``tie`` into parts of that size. At
    most HOT_SHARE keys can be so large, so the list of them is small enough to broadcast at any size. Null keys join.
    ``total`` is the number of all rows where it is known.
    """
    if total is None:
        total = groups.agg(F.sum(members)).first()[0] or 0
    limit = max(HOT_ROWS if hot_rows is None else hot_rows, total // HOT_SHARE)
    parts = F.ceil(F.col(members) / F.lit(limit))
    hot = groups.filter(F.col(members) > limit).select(*[F.col(k).alias(f"_h_{k}") for k in keys], parts.alias("_parts"))
    same = lambda left, right: _all(F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}{k}")) for k in keys)
    salted = rows.join(F.broadcast(hot), same("", "_h_"), "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(tie), F.col("_parts")), F.lit(0).cast("bigint"))
    )
    spread = groups.withColumn("_g_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.lit(1), parts) - 1)))
    spread = spread.select(*[F.col(k).alias(f"_g_{k}") for k in keys], "_g_salt", *[c for c in groups.columns if c not in keys])
    joined = salted.join(spread, same("", "_g_") & (F.col("_salt") == F.col("_g_salt")))
    return joined.drop("_salt", "_g_salt", "_parts", *[f"_h_{k}" for k in keys], *[f"_g_{k}" for k in keys])


def _all(conditions):
    out = None
    for c in conditions:
        out = c if out is None else out & c
    return out


def _to_lowest(links: DataFrame, lowest: DataFrame, total: int) -> DataFrame:
    return join_groups(links, lowest, ["v"], "members", "u", total, STAR_ROWS)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)`` but the smallest of each component.

    Alternating large-star and small-star steps: each node hooks its neighbors to the smallest one it knows. The rounds
    grow with the logarithm of the longest chain. A round ends as a written table, so no lineage builds up, and only a
    row count and a checksum reach the driver. The links of a node that holds many of them (the center of a star) are dealt
    to several tasks; sums and minima per node combine before they are shuffled.
    """
    pairs = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u < v").distinct()
    pairs, seen = stage(pairs, "edges"), None
    while True:
        mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return pairs.select(F.col("v").alias("node"), F.col("u").alias("component"))
        seen = mark
        both = pairs.unionByName(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        lowest = both.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("members")).select("v", F.least("v", "m").alias("m"), "members")
        large = _to_lowest(both.filter("u > v"), lowest, 2 * mark[0]).select(F.col("u").alias("v"), F.col("m").alias("u")).filter("u < v").distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("members"))
        hooked = _to_lowest(large, least, mark[0]).select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(least.select("v", F.col("m").alias("u")))
        pairs = stage(hooked.filter("u < v").distinct(), "edges")
