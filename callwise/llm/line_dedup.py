"""Line deduplication by overlapping three-line windows, with DataFrame functions only.

Every run of three consecutive lines is hashed (two seeded 64-bit hashes, so 128 bits). Windows that occur again are found
by one pre-aggregated grouping; their first occurrence, by (doc_id, line), stays. The lines of all later occurrences are
covered; overlapping and adjacent covers merge into ranges, and the text is rebuilt from the slices between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from callwise.llm.common import join_groups, texts
from callwise.sources.staging import stage

WINDOW = 3


def repeated_ranges(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(doc_id, k1, k2, ranges)``: the line ranges (1-based, both ends included) that later occurrences cover, in order.

    A document is its id and its text, of which ``k1`` and ``k2`` are hashes; ``docs`` has all four columns.
    """
    if size < 2:
        raise ValueError("a window has two lines at least")
    own = ["doc_id", "k1", "k2"]
    lines = docs.filter("doc_id IS NOT NULL").select(*own, F.split("text", "\n", -1).alias("l")).filter(F.size("l") >= size)
    at = [f"element_at(l, i + {k})" for k in range(size)]
    blank = " AND ".join(f"trim({x}) = ''" for x in at)
    hashes = ", ".join(f"'h{k}', xxhash64({k}, {', '.join(at)})" for k in (1, 2))
    windows = F.expr(f"transform(sequence(1, size(l) - {size - 1}), i -> IF({blank}, NULL, named_struct('pos', i, {hashes})))")
    rows = stage(lines.select(*own, F.explode(windows).alias("w")).filter("w IS NOT NULL").select(*own, "w.pos", "w.h1", "w.h2"), "windows")
    again = rows.groupBy("h1", "h2").agg(F.count("*").alias("members"), F.min(F.struct(*own, "pos")).alias("first"))
    again = stage(again.filter("members > 1"), "repeated")
    later = join_groups(rows, again, ["h1", "h2"], "members", "doc_id").filter(F.struct(*own, "pos") > F.col("first")).select(*own, "pos")
    in_doc = Window.partitionBy(*own).orderBy("pos")  # the lines of one document
    opens = F.coalesce((F.col("pos") > F.lag("pos").over(in_doc) + size).cast("int"), F.lit(1))
    merged = (
        later.distinct()
        .withColumn("opens", opens)
        .withColumn("island", F.sum("opens").over(in_doc))
        .groupBy(*own, "island")
        .agg(F.min("pos").alias("first"), (F.max("pos") + (size - 1)).alias("last"))
    )
    return merged.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("ranges"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``(doc_id, n_lines, n_removed, text)`` for every row: the text without the lines of repeated windows.

    Lines end at a line feed and are compared byte by byte; windows of blank lines only do not count. Texts with fewer
    lines than a window stay whole. Null text is empty (one empty line). Rows without doc_id have no place in the order
    and are returned unchanged. A document is an id and a text: a repeated row is not a later occurrence, another text of the
    same id is one (in the order of its hash). Texts are whole, however long; an empty table gives an empty result.
    """
    source = texts(docs, id_col, text_col).withColumns({f"k{k}": F.xxhash64(F.lit(k), "text") for k in (1, 2)})
    ranges = repeated_ranges(source, size).select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", "k1", "k2")], "ranges")
    same = (F.col("doc_id") == F.col("_doc_id")) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2"))
    joined = source.join(ranges.hint("shuffle_hash"), same, "left").select(
        "doc_id", F.split("text", "\n", -1).alias("l"), "ranges", "text"
    )
    slices = (
        "array_join(flatten(zip_with(concat(array(0), ranges.last), concat(ranges.first, array(size(l) + 1)), "
        "(a, b) -> slice(l, a + 1, b - a - 1))), '\n')"
    )
    removed = F.expr("coalesce(aggregate(ranges, 0, (n, r) -> n + r.last - r.first + 1), 0)").cast("bigint")
    return joined.select(
        "doc_id",
        F.size("l").cast("bigint").alias("n_lines"),
        removed.alias("n_removed"),
        F.when(F.col("ranges").isNull(), F.col("text")).otherwise(F.expr(slices)).alias("text"),
    )
