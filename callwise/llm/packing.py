"""Packing token sequences by bulk-synchronous best fit.

Documents of one length are alike, and so are sequences of one gap and content. So documents and gaps are sorted into
classes (one per token length, at most ``capacity`` of them), and a round matches a whole class of documents, longest
first, against the sorted gaps: each document goes to the successor of its length among the gaps, conflicts between
documents of a class are resolved by rank (the first takes the first sequence of the gap class, and so on), the gaps
are updated, and the next round follows. The rounds need nothing but the counts per class, which Spark has summed; their
outcome is a table of slots. The distributed part gives every piece its rank inside its length and looks up its slot.
The number of slots depends on ``capacity`` alone, never on the number of documents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from callwise.llm.common import map_texts, texts
from callwise.llm.tokens import encoder, VOCABULARY
from callwise.sources.staging import local_rows, stage

CAPACITY = 1024
END_ID = 2
BLOCK_ROWS = 50_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` tokens; only the first may be shorter than the rest."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    return ([(0, head)] if head else []) + [(s, capacity) for s in range(head, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Every document's tokens and the end id, cut to ``capacity``; ``with_ids`` adds them as little-endian 32-bit integers."""
    end = np.array([end_id], "<u4").tobytes()

    def each(ids: list, raws: list) -> dict:
        out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
        encode = encoder(vocabulary).ids
        for doc, raw in zip(ids, raws, strict=True):
            packed = encode(raw.decode()) + end
            for k, (start, length) in enumerate(cut(len(packed) // 4, capacity)):
                part = packed[4 * start : 4 * (start + length)]
                for name, value in zip(out, (doc, k, start, length, zlib.crc32(part), part), strict=True):
                    if name != "ids" or with_ids:
                        out[name].append(value)
        kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary()}
        return {name: pa.array(values, kinds[name]) for name, values in out.items()}

    return map_texts(docs, each, PIECES + (", ids binary" if with_ids else ""))


def match_classes(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots ``(length, first_rank, n, per_sequence, first_sequence, offset)`` of best fit, longest documents first.

    A class of sequences is a run of consecutive numbers with one gap. Gaps below the current length never fit again
    before a shorter length comes, so a class is visited once a round and the last one visited is split at most in three.
    """
    slots: list[tuple[int, int, int, int, int, int]] = []
    gaps: list[tuple[int, int, int]] = []  # (gap, first sequence, number of sequences), sorted
    opened = 0
    for length in sorted((x for x in counts if counts[x]), reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(gaps, (length, -1, 0))
            if at < len(gaps):
                gap, first, size = gaps.pop(at)
            else:
                gap, first = capacity, opened
                size = -(-left // (capacity // length))
                opened += size
            fits = gap // length
            full, rest = min(size, left // fits), 0
            if full < size:
                rest = left - full * fits
            taken = [(full, fits, 0), (1 if rest else 0, rest, full)]
            for n, times, skip in taken:
                if n:
                    slots.append((length, rank, n * times, times, first + skip, capacity - gap))
                    rank, left = rank + n * times, left - n * times
                    if gap > times * length:
                        insort(gaps, (gap - times * length, first + skip, n))
            used = full + (1 if rest else 0)
            if used < size:
                insort(gaps, (gap, first + used, size - used))
    return slots


def place(rows: DataFrame, capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces ``(doc_id, piece, length, ids_crc32, ...)``."""
    spark = rows.sparkSession
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most `capacity` rows
    blocks = local_rows(spark, [(x, -(-n // block_rows)) for x, n in counts.items()], "length bigint, _blocks bigint")
    # a frequent length is ranked in blocks of about block_rows pieces, whose starts are summed first
    cut_up = rows.join(F.broadcast(blocks), "length").withColumn("_block", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_blocks"))).drop("_blocks")
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut_up.groupBy("length", "_block").count().select("length", "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_from"))
    inside = Window.partitionBy("length", "_block").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut_up.withColumn("_rank", F.row_number().over(inside) - 1).join(starts, ["length", "_block"])
    ranked = ranked.select(*rows.columns, (F.col("_from") + F.col("_rank")).alias("rank"))

    slots = sorted(match_classes(counts, capacity))
    table = spark.sparkContext.broadcast(np.array(slots, np.int64).reshape(-1, 6))
    columns = rows.columns
    length_at, rank_at = columns.index("length"), len(columns)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, _, per, sequence, offset = table.value.T
        keys = lengths.astype(np.uint64) << np.uint64(48) | firsts.astype(np.uint64)
        for batch in batches:
            length, rank = batch.column(length_at).to_numpy(), batch.column(rank_at).to_numpy()
            at = np.searchsorted(keys, length.astype(np.uint64) << np.uint64(48) | rank.astype(np.uint64), side="right") - 1
            k = rank - firsts[at]
            number, place_in = sequence[at] + k // per[at], offset[at] + k % per[at] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:rank_at], pa.array(number), pa.array(place_in)], [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return ranked.mapInArrow(look_up, schema + ", sequence_id bigint, offset bigint")


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.

    Null and empty texts are the end id alone. A repeated row is packed again; a row without doc_id is packed like any
    other. Sequences are numbered from 0 and filled gapless from offset 0; pieces of one length may trade places when
    they share doc_id, piece and content. An empty table gives an empty result; other columns are not read.
    """
    return place(stage(pieces(texts(docs), capacity, end_id, vocabulary), "pieces"), capacity)


def sequences(docs: DataFrame, placed: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(sequence_id, ids array<int>)``: the packed sequences of ``placed``; a sequence holds ``capacity`` ids at most."""
    keys = ["doc_id", "piece", "length", "ids_crc32"]
    cut_up = pieces(texts(docs), capacity, end_id, vocabulary, with_ids=True).dropDuplicates(keys)
    same = None
    for k in keys:
        equal = cut_up[k].eqNullSafe(placed[k])
        same = equal if same is None else same & equal
    parts = cut_up.join(placed, same).select("sequence_id", "offset", "ids")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [np.frombuffer(b"".join(p["ids"] for p in of), "<u4").astype(np.int32) for of in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(whole, pa.list_(pa.int32()))], ["sequence_id", "ids"])

    ordered = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("of"))
    return ordered.mapInArrow(unpack, "sequence_id bigint, ids array<int>")
