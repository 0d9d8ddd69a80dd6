"""Mixing sources to target weights by iterative proportional fitting.

The tokens are summed per cell (source, language, topic). Raking scales the cells so that the sums by source, by language
and by topic meet their targets in turn, again and again; no cell may get more tokens than it has. What a cell is to give
over what it has is the probability by which its documents are sampled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from callwise.llm.common import join_groups, reachable, text_key
from callwise.llm.words import groups, scan, VISIBLE, word_hashes
from callwise.sources.staging import stage

DIMENSIONS = ("source", "lang", "topic")
TOPICS = 8
TOPIC_BYTES = 6  # shorter words say little about the subject
TEMPERATURE = 0.8
SHARE = 0.7
SWEEPS = 30
TOLERANCE = 1e-4
CELLS_PER_TASK = 100_000
NONE = "(none)"


def row_key(docs: DataFrame) -> Column:
    """Hash of what a row is sampled by, besides its id; null source, language and text count as such."""
    return F.xxhash64(text_key(F.coalesce(docs["text"].cast("string"), F.lit(""))), *[F.coalesce(docs[c].cast("string"), F.lit(NONE)) for c in ("source", "lang")])


def described(docs: DataFrame, topics: int = TOPICS) -> DataFrame:
    """``(doc_id, key, source, lang, topic, n_tokens)`` of every row; ``key`` is a hash of its text, source and language; null source or language becomes ``(none)``.

    n_tokens is the number of words. The words of TOPIC_BYTES and more are dealt to ``topics`` blocks of the vocabulary by
    their hash; the topic is the block that the document uses most, the first of equals, ``(none)`` without such words.
    """
    reachable(docs.sparkSession)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(c)
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key(docs).alias("key"), name("source"), name("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column(4).cast(pa.binary()).to_pylist()
            topic, size = [], []
            for a, b in groups(raws):
                data, starts, ends, doc = scan(raws[a:b], VISIBLE)
                size.append(np.bincount(doc, minlength=b - a))
                long = ends - starts >= TOPIC_BYTES
                block = (word_hashes(data, starts[long], ends[long]) % np.uint64(topics)).astype(np.int64)
                used = np.bincount(doc[long] * topics + block, minlength=(b - a) * topics).reshape(-1, topics)
                topic += [f"t{k}" if n else NONE for k, n in zip(used.argmax(1), used.max(1), strict=True)]
            sizes = np.concatenate(size).astype(np.int64) if size else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(topic, pa.string()), pa.array(sizes)], ["doc_id", "key", "source", "lang", "topic", "n_tokens"])

    return read.mapInArrow(run, "doc_id bigint, key bigint, source string, lang string, topic string, n_tokens bigint")


def tempered(cells: DataFrame, dimension: str, temperature: float = TEMPERATURE) -> DataFrame:
    """Target shares ``(value, share)`` that flatten a marginal: proportional to its tokens to the power ``temperature``."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.pow(F.sum("tokens"), F.lit(temperature)).alias("p")).filter("p > 0")
    return sums.select("value", (F.col("p") / F.lit(sums.agg(F.sum("p")).first()[0])).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], share: float = SHARE, sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """Add ``weight``, the tokens each cell is to give: the marginals of ``targets`` times ``share`` of all tokens.

    ``cells`` has the dimensions and ``tokens``. A value without a target keeps what the other dimensions leave it; a target
    without tokens cannot be met. The sweeps end when none changes a cell by more than ``tolerance`` of itself, or after
    ``sweeps``; with cells at their limit the sums may stay off, which ``weight`` then shows. Each sweep ends as a written
    table.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    current = cells.withColumn("weight", F.col("tokens").cast("double") * share)
    if not total:
        return current
    parts = max(1, -(-cells.count() // CELLS_PER_TASK))  # few cells need no exchange between the sums of a sweep
    wanted = {d: stage(t.coalesce(parts).select(F.col("value").alias(d), (F.col("share") * total * share).alias("_want")), f"target-{d}").coalesce(parts) for d, t in targets.items()}
    for _ in range(sweeps):
        current = current.coalesce(parts).withColumn("_old", F.col("weight"))
        for k, (d, want) in enumerate(wanted.items()):
            sums = current.groupBy(d).agg(F.sum("weight").alias("_sum")).join(want, d)
            ratio = sums.select(d, F.when(F.col("_sum") > 0, F.col("_want") / F.col("_sum")).otherwise(F.lit(1.0)).alias(f"_r{k}"))
            current = current.join(ratio, d, "left").withColumn("weight", F.least(F.col("tokens"), F.col("weight") * F.coalesce(f"_r{k}", F.lit(1.0))))
        current = stage(current, "raked")
        worst = current.agg(F.max(F.abs(F.col("weight") - F.col("_old")) / F.greatest("_old", F.lit(1e-9)))).first()[0]
        current = current.drop("_old", *[f"_r{k}" for k in range(len(wanted))])
        if worst < tolerance:
            break
    return current


def draw(doc_id: str, seed: int) -> Column:
    """Uniform in [0, 1) from the id alone, so a rerun on any partitioning samples the same documents."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11) / F.lit(2.0**53)


def mix(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, share: float = SHARE, seed: int = 42, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """``(doc_id, key, source, lang, topic, n_tokens, probability, sampled)`` for every row.

    ``targets`` has a table ``(value, share)`` per dimension; without it the observed marginals are tempered. Documents
    without words weigh nothing and are sampled by the probability of their cell (``share`` in a cell without tokens). Rows
    with one doc_id and cell share their draw, so repeated rows stay or go together, as do those without doc_id. Other
    columns are not read; an empty table gives an empty result.
    """
    rows = stage(described(docs), "described")
    cells = stage(rows.groupBy(*dimensions).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("members")), "cells")
    targets = targets if targets is not None else {d: tempered(cells, d) for d in dimensions}
    raked = rake(cells, targets, share)
    odds = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") / F.col("tokens"))).otherwise(F.lit(share))
    chances = stage(raked.select(*dimensions, "members", odds.alias("probability")), "chances")
    joined = join_groups(rows, chances, list(dimensions), "members", "doc_id")
    return joined.select("doc_id", "key", "source", "lang", "topic", "n_tokens", "probability", (draw("doc_id", seed) < F.col("probability")).alias("sampled"))


def sample(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, share: float = SHARE, seed: int = 42) -> DataFrame:
    """``docs`` with its own columns, the sampled rows only; a row is known by its id, text, source and language."""
    taken = mix(docs, targets, share, seed).filter("sampled").select(F.col("doc_id").alias("_taken_id"), F.col("key").alias("_taken_key")).distinct()
    taken = stage(taken, "sampled").hint("shuffle_hash")
    return docs.join(taken, docs["doc_id"].cast("bigint").eqNullSafe(taken["_taken_id"]) & (row_key(docs) == taken["_taken_key"]), "left_semi")
