"""Exact deduplication by progressive refinement.

Documents are grouped by length, the groups by the hash of a prefix, and only what is then still together is hashed
whole. The first scan yields length and prefix hash. Shared (length, prefix) pairs set bits in a filter of fixed size;
the second scan hashes whole texts only where the bit of their pair is set. A bit set by chance costs one more hash and
changes no result, as the groups are formed by the full hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from callwise.llm.common import join_groups, map_texts, texts
from callwise.sources.staging import stage

PREFIX_BYTES = 256
FILTER_BITS = 2**25  # 4 MB to each executor, whatever the size of the table
HEADS = "doc_id bigint, n_bytes bigint, prefix_hash bigint"


def _head(raw: bytes, prefix_bytes: int) -> int:
    """Hash of length and prefix; ``bytes.lower`` changes A-Z only and keeps the length."""
    return xxhash.xxh3_64_intdigest(raw[:prefix_bytes].lower(), seed=len(raw) & 0xFFFFFFFF)


def _digest(raw: bytes) -> bytes:
    return hashlib.sha256(raw.lower()).digest()


def heads(docs: DataFrame, prefix_bytes: int = PREFIX_BYTES) -> DataFrame:
    def each(ids: list, raws: list) -> dict:
        head = np.fromiter((_head(r, prefix_bytes) for r in raws), np.uint64, len(raws))
        return {"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array([len(r) for r in raws], pa.int64()), "prefix_hash": head.view(np.int64)}

    return map_texts(docs, each, HEADS)


def digests(docs: DataFrame, prefix_bytes: int = PREFIX_BYTES) -> DataFrame:
    """Length, prefix hash and SHA-256 (hexadecimal) of every text with A-Z in lower case."""

    def each(ids: list, raws: list) -> dict:
        out = _full(ids, raws, prefix_bytes)
        out["text_sha256"] = pa.array([_digest(r).hex() for r in raws])
        return out

    return map_texts(texts(docs), each, HEADS + ", text_sha256 string")


def _full(ids: list, raws: list, prefix_bytes: int) -> dict:
    head = np.fromiter((_head(r, prefix_bytes) for r in raws), np.uint64, len(raws)).view(np.int64)
    return {"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array([len(r) for r in raws], pa.int64()), "prefix_hash": head}


def _decided(docs: DataFrame, id_col: str, text_col: str, prefix_bytes: int) -> DataFrame:
    """``exact_duplicates`` with the full hash (null where no other row has the length and prefix) and ``n_rows`` per document."""
    source = texts(docs, id_col, text_col)
    shared = heads(source, prefix_bytes).groupBy("n_bytes", "prefix_hash").count().filter("count > 1")
    bit = F.pmod(F.col("prefix_hash"), F.lit(FILTER_BITS))
    words = shared.select(F.floor(bit / 32).alias("word"), F.expr("shiftleft(1L, CAST(pmod(prefix_hash, 32) AS INT))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most FILTER_BITS / 32 rows
    table = np.zeros(FILTER_BITS // 32, np.uint32)
    table[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    shipped = docs.sparkSession.sparkContext.broadcast(table)

    def each(ids: list, raws: list) -> dict:
        mask, out = shipped.value, _full(ids, raws, prefix_bytes)
        slot = np.mod(out["prefix_hash"], FILTER_BITS)
        live = (mask[slot >> 5] >> (slot & 31).astype(np.uint32)) & np.uint32(1)
        return out | {"full_hash": pa.array([_digest(r) if on else None for r, on in zip(raws, live.tolist(), strict=True)], pa.binary())}

    hashed = stage(map_texts(source, each, HEADS + ", full_hash binary"), "hashed")
    full = hashed.filter("full_hash IS NOT NULL").groupBy("doc_id", "n_bytes", "prefix_hash", "full_hash").agg(F.count("*").alias("n_rows"))
    full = stage(full, "full")
    groups = stage(full.groupBy("n_bytes", "full_hash").agg(F.max("doc_id").alias("keep_id"), F.sum("n_rows").alias("group_size")), "groups")
    together = join_groups(full, groups, ["n_bytes", "full_hash"], "group_size", "doc_id")
    one = F.lit(1).cast("bigint")
    single = hashed.filter("full_hash IS NULL").withColumns({"n_rows": one, "keep_id": F.col("doc_id"), "group_size": one})
    return together.select(*single.columns).unionByName(single).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_bytes: int = PREFIX_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, prefix_hash, keep_id, group_size, kept)``: one row per document, also those to drop.

    Texts are equal when they agree after lower-casing A-Z; the largest doc_id of a group stays. Null text is empty.
    A document is a distinct (doc_id, text): a repeated row is the same document, but ``group_size`` counts rows. A null
    doc_id is a document like others; it stays only if all of its group have none. Texts are hashed whole, however long.
    An empty table gives an empty result; other columns of ``docs`` are not read.
    """
    return _decided(docs, id_col, text_col, prefix_bytes).drop("full_hash", "n_rows")


def _same_document(left: DataFrame, hashed: str, right: DataFrame):
    """A row of ``left`` is the document of ``right``: its id, length and full hash, so that texts of one id, or of none, stay apart."""
    n_bytes = F.octet_length(F.coalesce(left["text"].cast("string"), F.lit("")))
    return left["doc_id"].cast("bigint").eqNullSafe(right["doc_id"]) & (n_bytes == right["n_bytes"]) & (left[hashed] == right["full_hash"])


def with_copies(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` of every row of ``docs``."""
    copies = stage(_decided(docs, "doc_id", "text", PREFIX_BYTES).filter("group_size > 1"), "copies")
    copies = copies.select(F.col("doc_id").alias("_d"), F.col("n_bytes").alias("_b"), F.lower(F.hex("full_hash")).alias("_h"), "keep_id", "group_size")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("n_bytes") == F.col("_b")) & (F.col("text_sha256") == F.col("_h"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    size = F.coalesce("group_size", F.lit(1).cast("bigint"))
    return digests(docs).join(copies, same, "left").select(
        "doc_id", keep.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256"
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with its own columns and one row left of each group of equal texts."""
    decided = stage(_decided(docs, "doc_id", "text", PREFIX_BYTES).filter("NOT kept OR n_rows > 1"), "decided")
    key = ["doc_id", "n_bytes", "full_hash"]
    gone = decided.filter("NOT kept").select(*key).hint("shuffle_hash")
    hashed = "_hash"
    while hashed in docs.columns:
        hashed += "_"
    sha256 = F.pandas_udf(lambda raws: raws.map(_digest), "binary")
    rows = docs.withColumn(hashed, sha256(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")))
    left = rows.join(gone, _same_document(rows, hashed, gone), "left_anti")
    again = decided.filter("kept").select(*key)
    if again.isEmpty():  # no document occurs twice
        return left.drop(hashed)
    repeated = _same_document(left, hashed, again)
    once = left.join(again, repeated, "left_semi").dropDuplicates(["doc_id", hashed])
    return left.join(again, repeated, "left_anti").unionByName(once).drop(hashed)
