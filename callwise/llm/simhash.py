"""SimHash near-duplicates through an inverted index over byte positions.

A fingerprint has eight bytes. Two fingerprints that differ in at most d bits differ in at most d bytes, so they share at
least 8 - d bytes at the same positions. The index lists each fingerprint under every choice of 8 - d positions with the
bytes there: two fingerprints meet in a list exactly when their tally of shared positional bytes reaches 8 - d. So the
count filter needs no pair to be written out, and a list holds at most 256**d different fingerprints however many
documents there are. Inside a list the free bytes are compared bit by bit, and only spanning links leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from callwise.llm.common import components, join_groups, map_texts, texts
from callwise.sources.staging import stage

SEED = 42
CHUNK = 65_536


def fingerprint(raw: bytes, width: int = 3, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles of a text, A-Z in lower case; 0 for a text without words.

    Words are cut at the six ASCII white-space bytes, which is what ``bytes.split`` does.
    """
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    last = ends[width - 1 :].tolist() or [len(joined)]
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    total, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(last), CHUNK):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(first[i : i + CHUNK], last[i : i + CHUNK], strict=True)], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * total > len(last)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``(doc_id, fp, key)``: the fingerprint as a signed long and the text's key as an XXH64 of its bytes."""

    def each(ids: list, raws: list) -> dict:
        fp = np.array([fingerprint(r, width) for r in raws], np.uint64).view(np.int64)
        key = np.array([xxhash.xxh64_intdigest(r, SEED) for r in raws], np.uint64).view(np.int64)
        return {"doc_id": pa.array(ids, pa.int64()), "fp": fp, "key": key}

    return map_texts(docs, each, "doc_id bigint, fp bigint, key bigint")


def _kept(positions: tuple[int, ...]) -> int:
    """Mask of the bytes at these positions."""
    return sum(0xFF << (8 * p) for p in positions)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that link each value to the first of its component under bit distance, all inside one list.

    The values differ in ``distance`` bytes at most, so all masks of up to ``distance`` bits in those bytes are few; each
    is looked up in the sorted values, so the work is linear in the list.
    """
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    spread = int(np.bitwise_or.reduce(values ^ values[0]))
    places = [1 << b for b in range(64) if spread >> b & 1]
    masks = [sum(c) for k in range(1, distance + 1) for c in combinations(places, k)]
    parent = np.arange(len(values))
    if len(masks) > len(values):
        near = np.bitwise_count(ranked[:, None] ^ ranked[None, :]) <= distance
        hits = [np.nonzero(np.triu(near, 1))] if len(values) > 1 else []
    else:
        hits = []
        for m in masks:
            to = np.searchsorted(ranked, ranked ^ np.uint64(m))
            ok = np.flatnonzero(ranked[np.minimum(to, len(ranked) - 1)] == (ranked ^ np.uint64(m)))
            hits.append((ok, to[ok]))
    while True:
        before = parent.copy()
        for a, b in hits:
            low = np.minimum(parent[a], parent[b])
            np.minimum.at(parent, a, low)
            np.minimum.at(parent, b, low)
        parent = parent[parent]
        if (before == parent).all():
            break
    moved = np.flatnonzero(parent != np.arange(len(values)))
    return order[parent[moved]], order[moved]


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 2) -> DataFrame:
    """``(doc_id, fp, key, cluster, component_id)`` for every row: fingerprints within ``distance`` bits link, links chain.

    component_id is the smallest doc_id reachable. Texts without words share fingerprint 0 and link like any other; texts
    shorter than a shingle have one, the whole. Null text is empty. Rows without doc_id get a fingerprint and the
    component of the others with the same one, or null if there is none. A repeated row gives a repeated result row.
    Equal fingerprints collapse first, so copies cost nothing further on. ``key`` is a hash of the text, to tell texts of
    one id apart, ``cluster`` the smallest fingerprint reachable: unlike component_id it is never shared by two components. Texts are read whole, however long; an empty table gives an empty result; other columns are not read.
    """
    rows = stage(fingerprints(texts(docs, id_col, text_col), width), "fingerprints")
    groups = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("members")), "groups")
    choices = list(combinations(range(8), 8 - distance))
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(_kept(c)))).alias("shared")) for i, c in enumerate(choices)])
    listed = groups.filter("first_id IS NOT NULL").select("fp", F.explode(keys).alias("k"))
    lists = listed.groupBy("k").agg(F.collect_list("fp").alias("of")).filter("size(of) > 1").select("of")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column(0)
            fp, ends = of.flatten().to_numpy().view(np.uint64), of.offsets.to_numpy()
            base, left, right = ends[0], [], []
            for a, b in zip(ends[:-1] - base, ends[1:] - base, strict=True):
                x, y = _links(fp[a:b], distance)
                left.append(fp[a:b][x].view(np.int64))
                right.append(fp[a:b][y].view(np.int64))
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])

    found = components(lists.mapInArrow(link, "a bigint, b bigint"))
    named = groups.join(found, groups["fp"] == found["node"], "left")
    named = stage(named.select("fp", "members", "first_id", F.coalesce("component", "fp").alias("cluster")), "named")
    least = stage(named.groupBy("cluster").agg(F.min("first_id").alias("component_id"), F.count("*").alias("prints")), "clusters")
    named = join_groups(named, least, ["cluster"], "prints", "fp").select("fp", "members", "cluster", "component_id")
    return join_groups(rows, stage(named, "named"), ["fp"], "members", "doc_id").select("doc_id", "fp", "key", "cluster", "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with its own columns, one document left of each component: the one with the smallest doc_id.

    A document is an id and a text. If several texts of the smallest id are in a component, the one with the smallest key
    stays; equal rows stay or go together. Rows without id stay. An empty table gives an empty result.
    """
    groups = stage(simhash_groups(docs, width=width, distance=distance).select("doc_id", "key", "cluster", "component_id"), "near")
    first = groups.filter("doc_id = component_id")
    spare = first.groupBy("cluster").agg(F.min("key").alias("least"), F.max("key").alias("most"), F.count("*").alias("members")).filter("least < most")
    spare = join_groups(first, stage(spare, "spare"), ["cluster"], "members", "key").filter("key > least").select("doc_id", "key")
    gone = groups.filter("doc_id <> component_id").select("doc_id", "key").unionByName(spare)
    gone = stage(gone.select(F.col("doc_id").alias("_gone_id"), F.col("key").alias("_gone_key")).distinct(), "gone").hint("shuffle_hash")
    key = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(gone, (docs["doc_id"].cast("bigint") == gone["_gone_id"]) & (key == gone["_gone_key"]), "left_anti")
