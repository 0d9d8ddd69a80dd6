import random

import pytest
from pyspark.sql import functions as F

from callwise.llm import common


@pytest.mark.parametrize("star", [1_000, 4])
def test_components_of_chains_stars_and_loose_ends(spark, monkeypatch, star):
    monkeypatch.setattr(common, "STAR_ROWS", star)
    monkeypatch.setattr(common, "HOT_SHARE", 40)
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 200 + i) for i in range(50)] + [(draw.randrange(300, 340), draw.randrange(300, 340)) for _ in range(25)] + [(5, 5), (150, 7)]
    draw.shuffle(edges)
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root if find(n) != n}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("hot", [20_000, 10])
def test_hot_groups_join_whole(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_ROWS", hot)
    monkeypatch.setattr(common, "HOT_SHARE", 20)
    rows = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 != 0, F.col("id") % 40).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("m"), F.max("id").alias("top"))
    got = common.join_groups(rows, groups, ["k"], "m", "id")
    assert got.columns == ["id", "k", "m", "top"] and got.count() == 600
    top = {r["k"]: r["top"] for r in groups.collect()}
    assert all(r["top"] == top[r["k"]] for r in got.collect())
