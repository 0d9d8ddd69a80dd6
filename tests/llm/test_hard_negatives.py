import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from callwise.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, rank string, dims int, block string, target int"


def plain(rows, is_anchor, positives=5, negatives=5):
    kept = set()
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.add((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out = []
    for a in (r for r in kept if is_anchor(r[0])):
        scored = sorted(((-sum(x * y for x, y in zip(a[2], r[2], strict=True)), r[0], r[1]) for r in kept if r[0] != a[0] and len(r[2]) == len(a[2])), key=lambda s: s[:2])
        for s, i, _ in [s for s in scored if s[2] == a[1]][:positives]:
            near = [n for n in scored if n[2] != a[1] and 80 * -s <= 100 * -n[0] <= 100 * -s][:negatives]
            out += [(a[0], i, rank + 1, n[1], -s, -n[0]) for rank, n in enumerate(near)]
    return sorted(out)


@pytest.fixture(scope="module")
def table(spark):
    return lambda rows: spark.createDataFrame([(*r, 1.0, "x", 3, "y", 4) for r in rows], SCHEMA)


def mined(df, **how):
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("id") % 10 == 0, **how).collect())


def test_scores_equal_products():
    rng = np.random.default_rng(1)
    for dims, top in ((1, 3), (8, 256), (13, 1000), (64, 1 << 20)):
        a, c = rng.integers(-top, top, (7, dims)), rng.integers(-top, top + 1, (50, dims))
        assert (H.scores(H.subset_sums(a), H.bit_planes(c)) == c @ a.T).all()


def test_equals_brute_force_in_any_blocks(table):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(6, 12))
    rows = [(i, (centers[i % 6] + rng.normal(size=12) * 0.3).round(1).tolist(), int(rng.integers(4))) for i in range(300)]
    rows += [(1000 + i, rows[5][1], i % 3) for i in range(80)]  # a group of equal vectors
    want = plain(rows, lambda i: i % 10 == 0)
    assert len(want) > 100
    assert mined(table(rows)) == want
    assert mined(table(rows), block=37, anchor_block=5, together=2) == want


def test_odd_rows(table):
    rng = np.random.default_rng(3)
    rows = [(i, rng.random(5).tolist(), i % 2) for i in range(40)]
    rows += rows[:15]  # equal rows count once
    rows += [(10, rng.random(5).tolist(), 0), (12, rng.random(5).tolist(), 1)]  # other rows of the same id
    rows += [(50, None, 1), (60, [1.0, None, 1.0, 1.0, 1.0], 1), (70, [math.nan] * 5, 0), (71, [math.inf] * 5, 0), (80, [1.0] * 5, None), (None, [1.0] * 5, 0)]
    rows += [(90, [1.0, 2.0], 0), (91, [2.0, 2.0], 0), (93, [2.0, 1.0], 1), (100, [], 0), (101, [], 0), (102, [], 1), (110, [0.0] * 5, 1), (-20, [-0.5] * 5, 0)]
    assert mined(table(rows)) == plain(rows, lambda i: i % 10 == 0)


def test_fewer_rows_than_asked_for_and_empty_table(table):
    assert mined(table([])) == []
    rows = [(0, [1.0, 0.5], 0), (1, [1.0, 0.4], 0), (2, [0.9, 0.4], 1)]
    assert mined(table(rows)) == plain(rows, lambda i: i % 10 == 0) == [(0, 1, 1, 2, 78592, 71936)]
    assert mined(table(rows[:1])) == []


def test_components_too_large_take_no_part(table):
    rows = [(0, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [1e30, 1.0], 1), (3, [0.95, 1.0], 1)]
    assert {r[3] for r in mined(table(rows))} == {3}
