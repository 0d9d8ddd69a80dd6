"""Substring deduplication: near-duplicate passages from compact windows of token min-hashes.

A text is a sequence of five-word shingles. For a hash function, the subsequences of at least ``passage`` words that have
their smallest hash at the same shingle c form a compact window [l, r] around c: a node of the Cartesian tree over the
hashes with its subtree's extent. Two documents that share a passage have windows of the same smallest shingle whose
intervals overlap where the passage lies.

Equal passages: a window of the first hash function lists its spans of ``passage - STEP`` words that lie in [l, r] at fixed
places around c, each by the shingle at c and those at both ends. Any common interval of ``passage`` words holds one of
these spans whole, so no repeated passage is missed. Spans of equal content are verified repeats.

Near copies: shorter windows, of RUN shingles and more, are joined by smallest shingle where they overlap by RUN places, laid
over each other at c, and two bits of each shingle on both sides agree so far that a run of RUN can be common. Two texts that share a run of RUN shingles always meet so,
as the smallest of the run is the same in both. An edit between words costs nine shingles of both texts together, so stretches
of ``passage`` words with a Jaccard similarity of 0.8 share a run of 21 at least; they share RUN or more where a repeated word
or phrase was inserted. Words may be inserted, deleted or replaced on either side of c.

A shingle that repeats the one before is left out of these windows, as many repeats add one shingle to a set. Where a common
run holds a repeated one, VARIED shingles are enough: an edit between repeats adds five shingles that are not common, so twenty
are, and one side of it has ten and the repeated one. Without an edit two texts differ in the numbers of repeats alone;
they meet where two shingles and more fill the places that a similar stretch has in common. Pairs are verified around each such
place: the shingles of both are aligned in order, and stretches of ``passage`` words in both texts whose sets of shingles have
a Jaccard similarity of 0.8 are kept.

All windows of a key meet, one of those whose surroundings are equal (equal spans link the others). Where a key has more than
FULL, they first make stars: a window meets the smallest document of its key, the first of its class (those that agree on both
sides of c) and the window before it. Those of documents that are then in different components meet in a second pass, in blocks.
A key that is frequent in a batch is split: its windows meet the batch's smallest document at once and go on under 64 parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from callwise.llm.common import components, texts as plain_texts
from callwise.llm.words import groups, mix, scan, VISIBLE, word_hashes
from callwise.sources.staging import stage

WIDTH = 5
PASSAGE = 50
STEP = 8
#: Shingles of the shortest run that always makes two texts meet, and on how many a side two bits each are compared.
RUN, SIDE = 16, 16
#: The same near a shingle that is repeated, where repeats of the one before are left out.
VARIED, FAR, NONE = 11, 31, 15
#: Windows of a text with equal sides that start in the same so many places count as one.
CLOSE = 8
#: Shingles on either side of a window's smallest one that tell whether two windows are copies.
BESIDE = 128
SIMILARITY = 0.8
FREQUENT, PARTS, FULL, BLOCK, CELL = 256, 64, 48, 4096, 1024
#: Shingles on either side of a common one that are aligned at once, and the most that they may be shifted. The next place
#: to be aligned is half as far away, so that the shortest stretches around all places between lie inside.
AROUND, SHIFT = 256, 48
ROWS = "key bigint, body bigint, doc bigint, at int, size int, a bigint, a_at int, kind int"
#: Kinds: a span or whole text, links, a window to be compared in the second pass, a window (its size packs both extents, its
#: ``a`` is the hash of its surroundings), one whose key has windows elsewhere, and one that is there under a part of its key.
WINDOW, REPEAT, CANDIDATE, LEFT, SEED, CUT, PART = 0, 1, 2, 3, 4, 5, 6
COLUMNS = [c.split()[0] for c in ROWS.split(", ")]
LISTED = ["key", "body", "doc", "at", "size", "a", "kind"]
_B = 0xD6E8FEB86659FD93


def shingles(raws: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, text, number of words per text)``: shingle hashes of all texts in a row; those across texts are left out."""
    data, starts, ends, doc = scan(raws, VISIBLE)
    words = word_hashes(data, starts, ends)
    n = len(words) - width + 1
    number = np.bincount(doc, minlength=len(raws))
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), number
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * np.uint64(_B) + words[k : n + k]
    inside = doc[:n] == doc[width - 1 :]
    return mix(h[inside]), doc[:n][inside], number


def _tables(values: np.ndarray, levels: int) -> list[np.ndarray]:
    """Minimum of every run of 2**j values from each place on; beyond the end nothing is smaller."""
    out = [values]
    for j in range(levels):
        half, low = 1 << j, out[-1].copy()
        low[:-half] = np.minimum(low[:-half], out[-1][half:])
        out.append(low)
    return out


def compact_windows(values: np.ndarray, least: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(c, l, r)`` of all places c that are the smallest value of a run of ``least`` values; the leftmost of equals.

    Zeros separate texts. Extents are followed for ``reach`` places at least, no further than the keys need.
    """
    levels = max(int(least).bit_length() - 1, int(reach).bit_length())
    tables = _tables(values, levels)
    n = len(values)
    if n < least:
        return (np.zeros(0, np.int64),) * 3
    j = int(least).bit_length() - 1
    low = np.minimum(tables[j][: n - least + 1], tables[j][least - (1 << j) :][: n - least + 1])
    # c is the minimum of some run that holds it where the largest of these minima is its own value
    high = np.zeros(n + least - 1, np.uint64)
    high[least - 1 : least - 1 + len(low)] = low
    flipped = _tables(~high, j)[j]
    top = ~np.minimum(flipped[:n], flipped[least - (1 << j) :][:n])
    c = np.flatnonzero((values == top) & (values > 0))
    own, left, right = values[c], c.copy(), c.copy()
    for k in range(levels, -1, -1):
        size = 1 << k
        to = left - size
        ok = (to >= 0) & (tables[k][np.maximum(to, 0)] > own)
        left = np.where(ok, to, left)
        ok = (right + size < n) & (tables[k][np.minimum(right + 1, n - 1)] >= own)
        right = np.where(ok, right + size, right)
    wide = right - left + 1 >= least
    return c[wide], left[wide], right[wide]


def _varied(values: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """``(c, l, r, place, varied, apart)`` of windows over the values that differ from the one before.

    A window has RUN values, or VARIED within FAR of a repeated one, or two and more that fill the places of a similar stretch
    of ``least`` with their repeats. ``apart`` packs how many more than c are needed for the latter, NONE if they are not
    there, and how far the next repeated values before and behind each value are, FAR if there are none. ``place`` is where c was in all values; a value that is there more than
    RUN times in a row has a window for the first and one for the last of them.
    """
    kept = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])) | (values == 0))
    number = np.diff(np.append(kept, len(values)))
    varied = values[kept]
    repeated = (number > 1) & (varied > 0)

    def since(repeated: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = np.arange(len(ends))
        last = np.maximum.accumulate(np.where(repeated | ends, n, 0))
        return np.where(repeated[last], np.minimum(n - last, FAR), FAR)

    before, behind = since(repeated, varied == 0), since(repeated[::-1], varied[::-1] == 0)[::-1]
    c, left, right = compact_windows(varied, VARIED, RUN)
    wide = right - left + 1 >= np.where(np.minimum(before, behind)[c] < FAR, VARIED, RUN)
    c, left, right = c[wide], left[wide], right[wide]
    more = np.full(len(kept), NONE)
    total = np.concatenate(([0], np.cumsum(np.where(varied > 0, number, 0))))
    places = int(np.ceil(_needed(least, SIMILARITY)))
    filled = np.flatnonzero(total[VARIED:] - total[: max(len(total) - VARIED, 0)] >= places)
    if len(filled):
        inside = np.cumsum(np.bincount(filled, minlength=len(kept) + 1) - np.bincount(filled + VARIED, minlength=len(kept) + 1))[: len(kept)] > 0
        x, first, last = compact_windows(np.where(inside, varied, np.uint64(0)), 2, RUN)
        for beside in range(VARIED - 1, 0, -1):
            for before_c in range(beside + 1):
                a, b = x - before_c, x - before_c + beside
                enough = (a >= first) & (b <= last) & (total[np.minimum(b + 1, len(kept))] - total[np.maximum(a, 0)] >= places)
                more[x[enough]] = beside
        new = (more[x] < NONE) & ~np.isin(x, c)
        c, left, right = (np.concatenate(y) for y in ((c, x[new]), (left, first[new]), (right, last[new])))
    twice = np.flatnonzero(number[c] > RUN)
    place = np.concatenate((kept[c], (kept + number - 1)[c[twice]]))
    c, left, right = (np.concatenate((x, x[twice])) for x in (c, left, right))
    return c, left, right, place, varied, more * 1024 + before * 32 + behind


def _listed(raws: list[bytes], passage: int) -> dict[str, np.ndarray]:
    """Rows of a group of texts: spans of equal passages (and whole texts), then the windows for near copies."""
    s, doc, number = shingles(raws)
    least = passage - WIDTH + 1
    span = least - STEP
    out: dict[str, list] = {k: [] for k in LISTED}

    def add(*columns: np.ndarray) -> None:
        for name, column in zip(LISTED, columns, strict=True):
            out[name].append(column)

    count = np.maximum(number - WIDTH + 1, 0)
    start = np.cumsum(count) - count
    # zeros between the texts
    slot = np.arange(len(s)) + doc
    back = np.zeros(len(s) + len(raws) + 1, np.int64)
    back[slot] = np.arange(len(s))
    powers = np.cumprod(np.full(len(s) + 1, np.uint64(_B)), dtype=np.uint64)
    inverse = np.cumprod(np.full(len(s) + 1, np.uint64(pow(_B, -1, 2**64))), dtype=np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(s * powers[: len(s)], dtype=np.uint64)))
    body = lambda a, b: mix((sums[b + 1] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
    full = lambda n, v: np.full(n, v, np.int64)

    values = np.zeros(len(back), np.uint64)
    values[slot] = np.maximum(mix(s + np.uint64(_B)), np.uint64(1))
    c, left, right = compact_windows(values, least, span)
    at = back[c]
    for before in sorted({*range(0, span, STEP), span - 1}):
        ok = (c - before >= left) & (c - before + span - 1 <= right)
        a = at[ok] - before
        b = a + span - 1
        code = np.uint64((1_000_003 + before) * _B % 2**64)
        key = mix(values[c[ok]] + mix(s[a] + code) + np.uint64(3) * mix(s[b] ^ code))
        add(key, body(a, b), doc[a], a - start[doc[a]], full(len(a), span + WIDTH - 1), full(len(a), 0), full(len(a), WINDOW))
    c, left, right, place, varied, apart = _varied(values, least)
    long = count[doc[back[place]]] >= least
    c, left, right, place = c[long], left[long], right[long], place[long]
    sides = np.zeros(len(c), np.uint64)
    for k in range(SIDE):
        for other, to in ((c + k + 1, 2 * k), (c - k - 1, 32 + 2 * k)):
            sides |= (varied[np.clip(other, 0, len(varied) - 1)] & np.uint64(3)) << np.uint64(to)
    size = apart[c] * 65536 + np.minimum(c - left, 255) * 256 + np.minimum(right - c, 255)
    key = mix(varied[c] ^ np.uint64(7 * _B % 2**64))
    at = back[place]
    text = doc[at]
    near, far = np.maximum(at - BESIDE, start[text]), np.minimum(at + BESIDE, start[text] + count[text] - 1)
    around = mix(body(near, far) + (at - near).astype(np.uint64)).view(np.int64)
    add(key, sides, text, at - start[text], size, around, full(len(c), SEED))
    whole = np.flatnonzero(count >= least)
    if len(whole):
        content = body(start[whole], start[whole] + count[whole] - 1)
        add(mix(content ^ np.uint64(_B)), content, whole, full(len(whole), 0), number[whole], full(len(whole), 0), full(len(whole), WINDOW))
    return {k: np.concatenate(v) for k, v in out.items()}


def _take(rows: dict[str, np.ndarray], index: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[index] for k, v in rows.items()}


def _join(*parts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: np.concatenate([p[k] for p in parts]) for k in LISTED}


def _linked(rows: dict[str, np.ndarray], take: np.ndarray, to: np.ndarray, kind: int) -> dict[str, np.ndarray]:
    """Links of rows ``take`` to rows ``to`` of other documents."""
    real = rows["doc"][take] != rows["doc"][to]
    take, to = take[real], to[real]
    out = _take(rows, take)
    # links are done: they are dealt out by their document, not by a key that many of them share
    spread = mix(out["doc"].astype(np.int64).view(np.uint64) * np.uint64(_B) + out["at"].astype(np.uint64)).view(out["key"].dtype)
    return out | {"key": spread, "kind": np.full(len(take), kind), "a": rows["doc"][to], "a_at": rows["at"][to]}


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values starts in sorted columns."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


def _repeats(rows: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """``(links, heads)``: spans of equal key and content linked to the first one, which alone is left."""
    rows = _take(rows, np.lexsort((rows["at"], rows["doc"], rows["body"], rows["key"])))
    new = _firsts(rows["key"], rows["body"])
    leader = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    member = np.flatnonzero(~new)
    return _linked(rows, member, leader[member], REPEAT), _take(rows, np.flatnonzero(new))


def _meet(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the windows of rows i and j, laid over each other at their smallest shingle, can hold a common run long enough."""
    unlike = (rows["body"][i] ^ rows["body"][j]).view(np.uint64)
    before, after = _alike(unlike >> np.uint64(32)), _alike(unlike & np.uint64(0xFFFFFFFF))
    left, right, gap, rest = (np.minimum(x[i], x[j]) for x in (rows["size"] >> 8 & 255, rows["size"] & 255, rows["size"] >> 21 & 31, rows["size"] >> 16 & 31))
    more = np.maximum(rows["size"][i] >> 26, rows["size"][j] >> 26)
    before, after = np.minimum(before, left), np.minimum(after, right)
    return (before + after + 1 >= np.where((before >= gap) | (after >= rest), VARIED, RUN)) | (before + after >= more)


def _alike(bits: np.ndarray) -> np.ndarray:
    """How many pairs of bits are zero before the first that is not, of SIDE."""
    lowest = (bits & (~bits + np.uint64(1))).astype(np.float64)
    return np.where(bits == 0, SIDE, (np.frexp(lowest)[1] - 1) // 2)


def _unlike(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Windows sorted by key, class and place; of those with equal surroundings the first. One of a cut key marks it for all."""
    order = np.lexsort((rows["at"], rows["doc"], rows["a"], rows["key"]))
    new = np.flatnonzero(_firsts(rows["key"][order], rows["a"][order]))
    kind = np.maximum.reduceat(rows["kind"][order], new) if len(new) else rows["kind"][:0]
    rows = _take(rows, order[new]) | {"kind": kind}
    rows = _take(rows, np.lexsort((rows["at"], rows["doc"], rows["body"], rows["key"])))
    new = np.flatnonzero(_firsts(rows["key"], rows["body"], rows["doc"], rows["at"] // CLOSE))
    kind = np.maximum.reduceat(rows["kind"], new) if len(new) else rows["kind"][:0]
    return _take(rows, new) | {"kind": kind}


def _least_doc(rows: dict[str, np.ndarray]) -> np.ndarray:
    """For rows sorted by key, the row of the smallest document of the same key."""
    order = np.lexsort((rows["at"], rows["doc"], rows["key"]))
    new = _firsts(rows["key"])  # sorted by key both ways, so runs lie in the same places
    return order[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]


def _stars(rows: dict[str, np.ndarray], more: bool) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray], dict[str, np.ndarray]]:
    """``(links, left, carried)`` of windows: between all of a key, or in stars if they are over FULL, which are left as well.

    If there may be ``more`` of the last key, its windows are carried: all of them as long as they are few, else those that
    others would meet.
    """
    rows = _unlike(rows)
    n = np.arange(len(rows["key"]))
    if not len(n):
        return _linked(rows, n, n, CANDIDATE), rows, rows
    key, both = _firsts(rows["key"]), _firsts(rows["key"], rows["body"])
    begin = np.flatnonzero(key)
    members = np.diff(np.append(begin, len(n)))
    many = np.repeat((members > FULL) | np.logical_or.reduceat(rows["kind"] >= CUT, begin), members)
    end = np.repeat(begin + members, members)
    keep, ready = n[:0], ~many
    if more:
        last = n >= begin[-1]
        ready &= ~last
        keep = n[last] if not many[-1] else keep
    take, to = [], []
    for d in range(1, int(members.max())):
        i = n[ready & (n + d < end)]
        if not len(i):
            break
        take.append(i + d)
        to.append(i)
    center, leader = _least_doc(rows), np.maximum.accumulate(np.where(both, n, 0))
    take += [n[many], n[~both & many], n[~key & many]]
    to += [center[many], leader[~both & many], n[~key & many] - 1]
    take, to = np.concatenate(take), np.concatenate(to)
    ok = _meet(rows, take, to)
    left = _take(rows, np.flatnonzero(many & (rows["kind"] != PART)))
    left["kind"] = np.full(len(left["kind"]), LEFT)
    carried = _take(rows, keep)
    if more and many[-1]:
        carried = _take(rows, np.unique([center[-1], leader[-1], n[-1]]))
        carried["kind"] = np.maximum(carried["kind"], CUT)
    return _linked(rows, take[ok], to[ok], CANDIDATE), left, carried


def _split(rows: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray], dict[str, np.ndarray]]:
    """``(links, left, rows)``: windows of keys that are frequent in this batch go on under parts of the key."""
    rows = _unlike(rows)
    new = _firsts(rows["key"])
    begin = np.flatnonzero(new)
    members = np.diff(np.append(begin, len(new)))
    center = _least_doc(rows)
    frequent = np.repeat(members > FREQUENT, members)
    hot = np.flatnonzero(frequent)
    moved = hot[rows["doc"][hot] != rows["doc"][center[hot]]]
    part = mix(rows["doc"][moved].astype(np.int64).view(np.uint64)) % np.uint64(PARTS) + np.uint64(1)
    ok = _meet(rows, moved, center[moved])
    links = _linked(rows, moved[ok], center[moved][ok], CANDIDATE)
    left = _take(rows, moved) | {"kind": np.full(len(moved), LEFT)}
    key, kind = rows["key"].copy(), np.where(frequent, CUT, rows["kind"])
    key[moved], kind[moved] = mix(key[moved] + part * np.uint64(_B)), PART
    return links, left, rows | {"key": key, "kind": kind}


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    kinds = {"at": np.int32, "size": np.int32, "a_at": np.int32, "kind": np.int32}
    if "a_at" not in columns:  # not a link
        columns = columns | {"a_at": np.zeros(len(columns["doc"]), np.int64)}
    cast = lambda n: columns[n].view(np.int64) if columns[n].dtype == np.uint64 else columns[n].astype(kinds.get(n, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(cast(n)) for n in COLUMNS], COLUMNS)


def windows(docs: DataFrame, passage: int = PASSAGE) -> DataFrame:
    """Rows of ROWS: spans and windows to be shuffled, and the links found inside a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raws = batch.column(0).to_numpy(), batch.column(1).cast(pa.binary()).to_pylist()
            held = []
            for a, b in groups(raws):
                rows = _listed(raws[a:b], passage)
                held.append(rows | {"doc": ids[a:b][rows["doc"]]})
            if held:
                rows = _join(*held)
                yield from map(_batch, _repeats(_take(rows, rows["kind"] == WINDOW)))
                yield from map(_batch, _split(_take(rows, rows["kind"] >= SEED)))

    return docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, ROWS)


def paired(rows: DataFrame) -> DataFrame:
    """Rows of ROWS that are links or left. The rows of a key come in one sorted stream; what a cut key needs further on is carried."""

    def plain(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        """Links are not looked up by key or content any more."""
        needed = rows["kind"] == LEFT
        return _batch(rows | {n: np.where(needed, rows[n], rows[n].dtype.type(0)) for n in ("key", "body")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans, starred = None, None
        for batch in batches:
            got = {n: batch.column(k).to_numpy() for k, n in enumerate(COLUMNS)}
            done = (got["kind"] != WINDOW) & (got["kind"] < SEED)
            if done.any():
                yield plain(_take(got, done))
            got = {n: got[n] for n in LISTED}
            exact, near = _take(got, got["kind"] == WINDOW), _take(got, got["kind"] >= SEED)
            if len(exact["key"]):
                links, heads = _repeats(exact if spans is None else _join(spans, exact))
                spans = _take(heads, np.arange(len(heads["key"]))[-1:])
                yield plain(links)
            if len(near["key"]):
                links, left, starred = _stars(near if starred is None else _join(starred, near), True)
                yield from map(plain, (links, left))
        if starred is not None:
            yield plain(_stars(starred, False)[0])  # those of a key with many are left already

    return rows.repartition("key").sortWithinPartitions("key", "body", "doc", "at").mapInArrow(run, ROWS)


def oriented(links: DataFrame) -> DataFrame:
    """``(a, b, kind, size, at_a, at_b)`` with a < b."""
    flip = F.col("a") > F.col("doc")
    return links.select(
        F.least("a", "doc").alias("a"), F.greatest("a", "doc").alias("b"), "kind", "size",
        F.when(flip, F.col("at")).otherwise(F.col("a_at")).alias("at_a"), F.when(flip, F.col("a_at")).otherwise(F.col("at")).alias("at_b"),
    )


def repeats(pair: DataFrame) -> DataFrame:
    """``(a, b, diagonal, first_a, last_a)``: equal spans of a pair and diagonal that overlap or touch, as one run."""
    span = pair.filter(F.col("kind") == REPEAT).select(
        "a", "b", (F.col("at_b") - F.col("at_a")).alias("diagonal"), F.col("at_a").alias("first_a"), (F.col("at_a") + F.col("size")).alias("last_a")
    )
    line = Window.partitionBy("a", "b", "diagonal").orderBy("first_a", "last_a")
    apart = F.coalesce(F.col("first_a") > F.max("last_a").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = span.withColumn("_apart", apart.cast("int")).withColumn("_run", F.sum("_apart").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("a", "b", "diagonal", "_run").agg(F.min("first_a").alias("first_a"), F.max("last_a").alias("last_a")).drop("_run")


def ranked(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in order of their hashes, and where each of them is."""
    order = np.argsort(texts, kind="stable")
    return texts[order], order


def _places(left: np.ndarray, ranks: tuple[np.ndarray, np.ndarray], limit: int) -> tuple[np.ndarray, np.ndarray] | None:
    """All places ``(i, j)`` of equal shingles, rising by i and then j; None if they are over ``limit``."""
    values, order = ranks
    low, high = np.searchsorted(values, left), np.searchsorted(values, left, side="right")
    number = high - low
    if int(number.sum()) > limit:
        return None
    i = np.repeat(np.arange(len(left)), number)
    return i, order[np.arange(len(i)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(low, number)]


def aligned(left: np.ndarray, right: np.ndarray, shift: int, needed: float = 0, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Places ``(i, j)`` of a longest rising chain of equal shingles with ``j - i`` within SHIFT of ``shift``.

    Where fewer than ``needed`` places are equal, they are returned as they are; where no ``least`` places of either text
    hold nearly as many that are, none. (A stretch of a density of 0.8 or more has that in some ``least`` places, but one.)
    """
    return _rising(*_places(left, ranked(right), len(left) * len(right)), shift, needed, least)


def _rising(i: np.ndarray, j: np.ndarray, shift: int, needed: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """What ``aligned`` gives, of the places of equal shingles in order."""
    close = np.abs(j - i - shift) <= SHIFT
    i, j = i[close], j[close]
    if len(i) < max(needed, 2):
        return i, j
    rising = bool(np.all(i[1:] > i[:-1]) and np.all(j[1:] > j[:-1]))
    enough = max(int(np.ceil(0.85 * needed)), 1)
    for n in (i, j) if rising else (np.unique(i), np.unique(j)):
        if least and not np.any(n[enough - 1 :] - n[: max(len(n) - enough + 1, 0)] < least):
            return (np.zeros(0, np.int64),) * 2
    if rising:
        return i, j
    # a place that all others lie before or behind in both texts belongs to every longest chain
    sure = np.ones(len(i), bool)
    sure[1:] &= (i[1:] > i[:-1]) & (j[1:] > np.maximum.accumulate(j)[:-1])
    sure[:-1] &= (i[1:] > i[:-1]) & (j[:-1] < np.minimum.accumulate(j[::-1])[::-1][1:])
    x, y = _longest(i[~sure], j[~sure])
    return np.sort(np.concatenate((i[sure], x))), np.sort(np.concatenate((j[sure], y)))


def _longest(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A longest rising chain of places, by rows of bits: bit c is 0 where the chain up to this row grows at column c."""
    if not len(i):
        return i, j
    rows, x = np.unique(i, return_inverse=True)
    columns, y = np.unique(j, return_inverse=True)
    table = np.zeros((len(rows), len(columns)), bool)
    table[x, y] = True
    lines = [int.from_bytes(b.tobytes(), "little") for b in np.packbits(table, axis=1, bitorder="little")]
    full = (1 << len(columns)) - 1
    states = [full]
    for line in lines:
        state = states[-1]
        met = state & line
        states.append(((state + met) | (state - met)) & full)
    chain, r, c = [], len(rows), len(columns)
    while r and c:
        free = ~states[r] & ((1 << c) - 1)  # the last column at which the chain grows
        c = free.bit_length()
        while c and not states[r - 1] >> (c - 1) & 1:
            r -= 1
        if c:
            r, c = r - 1, c - 1
            chain.append((r, c))
    r, c = np.array(chain[::-1], np.int64).reshape(-1, 2).T
    return rows[r], columns[c]


def similar_stretches(left: np.ndarray, right: np.ndarray, shift: int, least: int, similarity: float) -> list[tuple[int, int, int, int]]:
    """``(first, last, first, last)`` in both texts of all stretches of ``least`` shingles and enough in common.

    m shingles in order among stretches of v and w have a similarity of m / (v + w - m). So each link of the chain counts
    1 + s and each place it passes costs s; the longest part with a sum of zero or more is taken, then what is left on both
    sides. Its sets of shingles are compared as well, as a shingle may occur twice.
    """
    return _parts(left, right, *aligned(left, right, shift, _needed(least, similarity), least), least, similarity)


def _needed(least: int, similarity: float) -> float:
    """Common places of two stretches of the least length."""
    return 2 * least * similarity / (1 + similarity) - 1e-9


def _parts(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, least: int, similarity: float) -> list[tuple[int, int, int, int]]:
    """The stretches along a chain."""
    needed = _needed(least, similarity)
    if len(i) < needed:
        return []
    total = (1 + similarity) * np.arange(len(i)) - similarity * (i + j)
    found, open_ = [], [(0, len(i))]
    while open_:
        x, y = open_.pop()
        if y - x < needed:
            continue
        part = total[x:y]
        start = np.searchsorted(-np.minimum.accumulate(part), -(part + 1 - similarity + 1e-9))
        long = np.minimum(i[x:y] - i[x + start], j[x:y] - j[x + start])
        end = int(np.argmax(long))
        p, q = x + int(start[end]), x + end
        if long[end] + 1 < least:
            found += _filled(left, right, i[x:y], j[x:y], least, similarity)
            continue
        if i[q] - i[p] == j[q] - j[p] == q - p or _similar(left[i[p] : i[q] + 1], right[j[p] : j[q] + 1], similarity):
            found.append((int(i[p]), int(i[q]) + 1, int(j[p]), int(j[q]) + 1))
        open_ += [(x, p), (q + 1, y)]
    return sorted(found)


def _similar(left: np.ndarray, right: np.ndarray, similarity: float) -> bool:
    one, two = set(left.tolist()), set(right.tolist())
    common = len(one & two)
    return common >= similarity * (len(one) + len(two) - common) - 1e-9


def _filled(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, least: int, similarity: float) -> list[tuple[int, int, int, int]]:
    """The stretch of ``least`` shingles with the most links of a chain, if enough, that does not end on links on both sides."""
    if min(len(left), len(right)) < least:
        return []
    # m links of v and w places hold the fewest that are enough in m - fewest places less of each text, at least
    fewest = int(np.ceil(_needed(least, similarity)))
    most = (1 + similarity) / similarity * least - 2 * (least - fewest)
    if len(i) < fewest or np.min(i[fewest - 1 :] - i[: len(i) - fewest + 1] + j[fewest - 1 :] - j[: len(j) - fewest + 1]) + 2 > most + 1e-6:
        return []
    for m in range(min(least, len(i)), 0, -1):
        v, w = (np.maximum(n[m - 1 :] - n[: len(n) - m + 1] + 1, least) for n in (i, j))
        if m * (1 + similarity) < 2 * least * similarity - 1e-9:
            return []
        for k in np.flatnonzero(m * (1 + similarity) >= similarity * (v + w) - 1e-9).tolist():
            a, b = (max(min(int(n[k]), len(text) - least), 0) for n, text in ((i, left), (j, right)))
            c, d = max(a + least, int(i[k + m - 1]) + 1), max(b + least, int(j[k + m - 1]) + 1)
            if _similar(left[a:c], right[b:d], similarity):
                return [(a, c, b, d)]
    return []


def _stretches(
    left: np.ndarray, right: np.ndarray, ranks: tuple[np.ndarray, np.ndarray], seeds: list[tuple[int, int]], least: int, similarity: float
) -> list[tuple[int, int, int, int]]:
    """Similar stretches around all common places of two texts, of which the second is ``ranked`` as well.

    A place less than ``AROUND / 2`` behind one that was looked at, at nearly the same shift, lies well inside its
    surroundings, and so do the shortest stretches around it; it is passed over.
    """
    found: set[tuple[int, int, int, int]] = set()
    seen: dict[int, int] = {}  # by shift, in steps of 8: the last place looked at
    places = _places(left, ranks, 4 * (len(left) + len(right)))  # of all of both texts, unless they repeat themselves too much
    for at, to in sorted(seeds):
        step = (to - at) // 8
        if any(at - seen.get(near, -AROUND) < AROUND // 2 for near in (step - 1, step, step + 1)):
            continue
        seen[step] = at
        a, b = max(0, at - AROUND), max(0, to - AROUND)
        x, y, shift = left[a : at + AROUND], right[b : to + AROUND], to - b - at + a
        if places is None:
            chain = aligned(x, y, shift, _needed(least, similarity), least)
        else:
            first, last = np.searchsorted(places[0], (a, a + len(x)))
            i, j = places[0][first:last] - a, places[1][first:last] - b
            inside = (j >= 0) & (j < len(y))
            chain = _rising(i[inside], j[inside], shift, _needed(least, similarity), least)
        for one in _parts(x, y, *chain, least, similarity):
            found.add((one[0] + a, one[1] + a, one[2] + b, one[3] + b))
    return sorted(found)


def _hashed(raws: list[bytes]) -> Iterator[np.ndarray]:
    """Shingles of every text."""
    for a, b in groups(raws):
        hashes, _, number = shingles(raws[a:b])
        yield from np.split(hashes, np.cumsum(np.maximum(number - WIDTH + 1, 0))[:-1])


def rounded(seeds: DataFrame) -> DataFrame:
    """Seeds moved to the middle of 32 places and of 8 shifts, so that close ones are one; AROUND and SHIFT have room for that."""
    at = F.floor(F.col("at_a") / 32) * 32 + 16
    return seeds.select("a", "b", at.cast("int").alias("at_a"), (at + F.floor((F.col("at_b") - F.col("at_a")) / 8) * 8 + 4).cast("int").alias("at_b"))


def verified(docs: DataFrame, seeds: DataFrame, passage: int = PASSAGE, similarity: float = SIMILARITY) -> DataFrame:
    """``(a, b, first_a, last_a, first_b, last_b)``: word ranges of similar passages around the seeds of a pair.

    Both sides are dealt to parts by their hash, so that a cell of two parts has about CELL pairs; a text goes to a cell once,
    however many pairs it has there.
    """
    pairs = stage(rounded(seeds).groupBy("a", "b").agg(F.collect_set(F.struct("at_a", "at_b")).alias("seeds")), "pairs")
    parts = int(np.ceil(np.sqrt(max(pairs.count(), 1) / CELL)))
    side = lambda name: F.pmod(F.xxhash64(name), F.lit(parts)).cast("int")
    cell = (side("a") * parts + side("b")).alias("cell")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("_n"), cell).distinct()
    texts = docs.join(needed.hint("shuffle_hash"), docs["doc_id"] == F.col("_n")).select("cell", "doc_id", "text", F.xxhash64("text").alias("order"))
    nothing = F.lit(None)
    texts = texts.select("cell", F.col("doc_id").alias("a"), nothing.cast("bigint").alias("b"), "order", "text", nothing.cast(pairs.schema["seeds"].dataType).alias("seeds"))
    both = texts.unionByName(pairs.select(cell, "a", "b", F.lit(0).cast("bigint").alias("order"), nothing.cast("string").alias("text"), "seeds"))
    least = passage - WIDTH + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "first_a", "last_a", "first_b", "last_b"]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
        now, known, ranks = None, {}, {}
        for batch in batches:
            out: dict[str, list] = {n: [] for n in names}
            cells, ones, twos = (batch.column(k).to_pylist() for k in range(3))
            raws, places = batch.column(3).cast(pa.binary()).to_pylist(), batch.column(4)
            hashed = iter(_hashed([r for r in raws if r is not None]))
            for k, (at, a, b, raw) in enumerate(zip(cells, ones, twos, raws, strict=True)):
                if at != now:
                    now, known, ranks = at, {}, {}
                if b is None:  # a text; those of the cell come before its pairs
                    if raw not in (held := known.setdefault(a, {})):
                        held[raw] = next(hashed)
                    else:
                        next(hashed)
                    continue
                for to in known[b]:
                    if (b, to) not in ranks:
                        ranks[b, to] = ranked(known[b][to])
                seeds = [(p["at_a"], p["at_b"]) for p in places[k].as_py()]
                for left in known[a].values():
                    for to, right in known[b].items():
                        for first, last, start, end in _stretches(left, right, ranks[b, to], seeds, least, similarity):
                            for n, v in zip(names, (a, b, first, last + WIDTH - 1, start, end + WIDTH - 1), strict=True):
                                out[n].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[n], k) for n, k in zip(names, kinds, strict=True)], names)

    dealt = both.repartition("cell").sortWithinPartitions("cell", F.col("b").asc_nulls_first(), "a", "order")
    return dealt.select("cell", "a", "b", "text", "seeds").mapInArrow(run, "a bigint, b bigint, first_a int, last_a int, first_b int, last_b int")


def crossing(left: DataFrame, named: DataFrame) -> DataFrame:
    """``(a, b, at_a, at_b)`` of all windows that can hold a common run and lie in different components.

    Rows of one key and half are dealt to blocks of about BLOCK rows, each pair of blocks to a task of its own.
    """
    of = left.join(named, left["doc"] == F.col("node"), "left").withColumn("component", F.coalesce("component", "doc"))
    once = of.groupBy("key", "a").agg(F.min(F.struct("doc", "at", "body", "size", "component")).alias("r")).select("key", "r.*")
    # of the 15 places that a common run has beside c, 12 are before or behind it or 8 and 4 on either side; near repeats, of ten places 7 or 4 and 4
    part = lambda before, after: F.xxhash64("key", F.lit(before), F.lit(after), F.expr(f"(body >> 32) & {4**before - 1}"), F.expr(f"body & {4**after - 1}"))
    runs, varied = F.array(part(12, 0), part(8, 4), part(4, 8), part(0, 12)), F.array(part(7, 0), part(4, 4), part(0, 7))
    near = F.expr(f"(size >> 21 & 31) < {FAR} OR (size >> 16 & 31) < {FAR}")
    some, few = F.array(part(3, 0), part(0, 3)), F.array(part(1, 0), part(0, 1))  # of five and more places, and of fewer
    none = F.array().cast("array<bigint>")
    choice = lambda test, keys: F.when(test, keys).otherwise(none)
    parts = F.concat(runs, choice(near, varied), choice(F.expr(f"size >> 26 < {NONE}"), some), choice(F.expr("size >> 26 < 5"), few))
    rows = stage(once.select(F.explode(parts).alias("g"), "doc", "at", "body", "size", "component"), "left")
    mixed = rows.groupBy("g").agg(F.count("*").alias("_n"), F.min("component").alias("_low"), F.max("component").alias("_high"))
    parts = mixed.filter("_low < _high").select("g", F.ceil(F.col("_n") / BLOCK).alias("_parts"))
    dealt = rows.join(parts, "g").withColumn("x", F.pmod(F.xxhash64("doc", "at"), F.col("_parts")))
    spread = dealt.withColumn("y", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))).drop("_parts")
    one = spread.select("g", "x", "y", F.col("doc").alias("a"), F.col("at").alias("at_a"), F.col("component").alias("c"), F.col("body").alias("v"), F.col("size").alias("m"))
    two = spread.select("g", F.col("y").alias("x"), F.col("x").alias("y"), F.col("doc").alias("b"), F.col("at").alias("at_b"), F.col("component").alias("d"), F.col("body").alias("w"), F.col("size").alias("n"))
    # the lowest bit that differs, below it only ones
    alike = lambda bits: f"bit_count(({bits} & -({bits})) - 1) DIV 2"
    before = f"least({alike('shiftrightunsigned(v ^ w, 32)')}, {SIDE}, m >> 8 & 255, n >> 8 & 255)"
    after = f"least({alike('((v ^ w) & 4294967295L)')}, {SIDE}, m & 255, n & 255)"
    needed = f"IF(before >= least(m >> 21 & 31, n >> 21 & 31) OR after >= least(m >> 16 & 31, n >> 16 & 31), {VARIED}, {RUN})"
    met = one.join(two, ["g", "x", "y"]).filter("a < b AND c != d").selectExpr("a", "b", "at_a", "at_b", "m", "n", f"{before} AS before", f"{after} AS after")
    return rounded(met.filter(f"before + after + 1 >= {needed} OR before + after >= greatest(m >> 26, n >> 26)")).distinct()


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, component_id, passages)`` of the documents that share a passage with another one.

    Every passage of ``passage`` words that is the same in two documents links them, up to case and white space; shorter
    ones link from ``passage - STEP`` words on when a listed span holds them, and where they make passages of ``passage``
    words similar enough. Passages of ``passage`` words in both texts whose five-word shingles, aligned in order, have a
    Jaccard similarity of ``similarity`` link when they share a run of RUN shingles; at 0.8 all do, whatever words are
    inserted, deleted or replaced in them, unless an inserted phrase repeats its neighbors three times or more.
    component_id is the smallest doc_id reachable. ``passages`` are the word
    ranges ``(first, end)`` that made the links, sorted, overlaps merged; that of an equal passage may end up to STEP
    words short. Of similar pairs that links connect already, not all add their ranges. Documents without such a passage have no row, nor
    have rows without doc_id; rows that share a doc_id are one document with all their texts. Null, empty and short texts
    share nothing; an empty table gives an empty result. A very long text is one array of hashes in its task; comparisons
    look at no more than AROUND shingles on either side of a common one. Other columns are not read.
    """
    source = plain_texts(docs, id_col, text_col)
    found = stage(paired(windows(source, passage)), "links")
    pair = oriented(found.filter(F.col("kind") != LEFT))
    exact = stage(repeats(pair), "repeats")
    seeds = pair.filter(F.col("kind") == CANDIDATE).select("a", "b", "at_a", "at_b")
    inside = (F.col("at_b") - F.col("at_a") == F.col("r.diagonal")) & F.col("at_a").between(F.col("r.first_a"), F.col("r.last_a") - WIDTH)
    fresh = seeds.join(exact.alias("r").hint("shuffle_hash"), (seeds["a"] == F.col("r.a")) & (seeds["b"] == F.col("r.b")) & inside, "left_anti")
    close = stage(verified(source, fresh, passage, similarity), "near")
    shifted = exact.withColumns({"first_b": F.col("first_a") + F.col("diagonal"), "last_b": F.col("last_a") + F.col("diagonal")})
    linked = shifted.drop("diagonal").unionByName(close)
    named = components(linked.select("a", "b"))
    rest = stage(crossing(found.filter(F.col("kind") == LEFT), named), "crossing")
    if not rest.isEmpty():
        more = stage(verified(source, rest, passage, similarity), "more")
        if not more.isEmpty():
            linked = linked.unionByName(more)
            named = components(named.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more.select("a", "b")))
    ends = F.array(*[F.struct(F.col(n).alias("d"), F.col(f"first_{n}").alias("first"), F.col(f"last_{n}").alias("end")) for n in "ab"])
    covers = linked.select(F.explode(ends).alias("s")).select("s.*").groupBy("d", "first").agg(F.max("end").alias("end"))
    line = Window.partitionBy("d").orderBy("first")
    apart = F.coalesce(F.col("first") > F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    runs = covers.withColumn("_apart", apart.cast("int")).withColumn("_run", F.sum("_apart").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("d", "_run").agg(F.min("first").alias("first"), F.max("end").alias("end"))
    result = merged.groupBy(F.col("d").alias("doc_id")).agg(F.array_sort(F.collect_list(F.struct("first", "end"))).alias("passages"))
    result = result.join(named, F.col("doc_id") == F.col("node"), "left")
    return result.select("doc_id", F.coalesce("component", "doc_id").alias("component_id"), "passages")
