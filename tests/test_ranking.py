"""The distributed paths must equal the plain ones; limits are lowered so that small data takes them."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from callwise.functions import quantiles as Q
from callwise.functions import ranking as R
from callwise.functions.skew import join_spread
from callwise.sources.staging import stage


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; the rest is heavy-tailed."""
    rng = random.Random(7)
    data = []
    for i in range(6000):
        x = 42.0 if i % 3 == 0 else rng.lognormvariate(0, 3)
        y = None if i % 11 == 0 else float(rng.randrange(5))
        data.append((i, "a" if i % 4 else "b", x, y))
    return stage(spark.createDataFrame(data, "id long, g string, x double, y double"), "skewed")


PROBS = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("by", [[], ["g"]])
def test_bracket_quantiles_equal_percentile(skewed, by):
    cols = ["x", "y", "id"]
    key = lambda r: tuple(r[b] for b in by) + (r["feature"], r["prob"])
    plain = {}
    for c in cols:
        rows = skewed.groupBy(*by).agg(F.expr(f"percentile({c}, array({', '.join(f'{p!r}D' for p in PROBS)}))").alias("q")).collect()
        plain |= {(*(r[b] for b in by), c, p): v for r in rows for p, v in zip(PROBS, r["q"], strict=True)}
    for limit in (10, Q.SORT_ROWS):  # many narrowings and one
        wide = {key(r): r["value"] for r in Q.quantiles(skewed, cols, PROBS, by, sort_rows=limit).collect()}
        assert plain.keys() == wide.keys()
        for k, v in plain.items():
            assert wide[k] == pytest.approx(v, rel=1e-12, abs=1e-12)


def test_quantiles_of_many_groups_and_empty_columns(spark):
    df = spark.range(12_000).select((F.col("id") % 3000).alias("g"), F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    got = Q.quantiles(df, ["x", "y"], [0.5], ["g"]).collect()
    assert len(got) == 6000
    assert all(r["value"] == (r["g"] + 4500 if r["feature"] == "x" else None) for r in got)


def test_quantiles_against_hand_values(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)] + [(None,), (float("nan"),)], "x double")
    got = [r["value"] for r in Q.quantiles(df, ["x"], [0.25, 0.5, 0.75]).orderBy("prob").collect()]
    assert got == [1.75, 2.5, 4.75]


def test_keys_at_ranks_of_numbers_and_texts(skewed):
    ids = sorted(r["id"] for r in skewed.filter("g = 'b'").collect())
    want = [1, 2, 701, len(ids)]
    assert [R.keys_at_ranks(skewed, "id", "g", {"b": want})[("b", r)] for r in want] == [ids[r - 1] for r in want]
    texts = skewed.withColumn("id", F.concat(F.lit("k"), "id"))
    names = sorted(f"k{i}" for i in ids)
    assert [R.keys_at_ranks(texts, "id", "g", {"b": want})[("b", r)] for r in want] == [names[r - 1] for r in want]


def test_keys_beyond_doubles_stay_apart(spark):
    df = spark.createDataFrame([(2**60 + i, 1) for i in range(50)], "id long, g int")
    assert R.keys_at_ranks(df, "id", "g", {1: [1, 2, 50]}) == {(1, 1): 2**60, (1, 2): 2**60 + 1, (1, 50): 2**60 + 49}


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_in_ranges(skewed, descending):
    counts = skewed.groupBy("x").agg(F.count("*").alias("n"))
    got = {}
    for buckets in (1, 7, 64):
        out = R.running_totals(counts, "x", {"cum": "n"}, descending, buckets=buckets)
        got[buckets] = {r["x"]: r["cum"] for r in out.collect()}
    want, total = {}, 0
    for r in sorted(counts.collect(), key=lambda r: r["x"], reverse=descending):
        total += r["n"]
        want[r["x"]] = total
    assert all(g == want for g in got.values())


def test_with_previous_in_ranges(spark):
    data = [(float(i // 3), float(i)) for i in range(500)]
    df = spark.createDataFrame(data, "x double, y double")
    want = dict(zip(data[1:], data)) | {data[0]: (None, None)}
    for buckets in (1, 16):
        out = R.with_previous(df, ["x", "y"], ["x", "y"], buckets=buckets)
        assert {(r["x"], r["y"]): (r["prev_x"], r["prev_y"]) for r in out.collect()} == want


def test_range_bucket_counts_edges_below(spark):
    edges = [float(i) * 1.5 for i in range(100)]
    values = [-1.0, 0.0, 0.1, 74.9, 75.0, 148.5, 999.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(R.range_bucket(F.col("x"), edges)).collect()]
    assert got == [sum(e < v for e in edges) for v in values]


def test_hash_position_is_the_md5_order(spark):
    df = spark.range(3000).repartition(5)
    want = {i: n for n, i in enumerate(sorted(range(3000), key=lambda i: (hashlib.md5(f"{i}-250".encode()).hexdigest(), i)))}
    assert {r["id"]: r["pos"] for r in R.hash_position(df, "id", 250).collect()} == want


def test_class_counts_refuses_unbounded_labels(spark):
    with pytest.raises(ValueError):
        R.class_counts(spark.range(R.MAX_CLASSES + 5), "id")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, how):
    left = stage(spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k")), "left")
    right = spark.createDataFrame([(i, f"v{i}") for i in range(0, 50, 2)] + [(7, "hot")], "k long, v string")
    plain = sorted(map(tuple, left.join(right, "k", how).select("id", "k", "v").collect()), key=str)
    spread = sorted(map(tuple, join_spread(left, right, "k", "id", how, min_hot_rows=100).select("id", "k", "v").collect()), key=str)
    assert spread == plain
