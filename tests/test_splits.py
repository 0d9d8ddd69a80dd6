import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from callwise.operators import splits as S


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(997).select("id", (F.col("id") % 7 == 0).cast("int").alias("y"))


def test_allocation_floors_then_largest_remainders():
    assert S.allocate({0: 1177, 1: 173}, 0.1) == {0: 118, 1: 17}
    assert sum(S.allocate({0: 5, 1: 5, 2: 5}, 0.2).values()) == 3
    assert S.allocate({0: 3, 1: 3}, 0.5) == {0: 2, 1: 1}  # equal remainders: the smaller label
    assert S.allocate({}, 0.1) == {}


def test_holdout_size_and_class_shares(people):
    out = S.stratified_holdout(people, "id", "y", 0.1)
    held = Counter((r["y"], r["is_holdout"]) for r in out.collect())
    assert held[(0, True)] + held[(1, True)] == 100  # ceil(99.7)
    n1 = people.filter("y = 1").count()
    assert abs(held[(1, True)] - n1 * 0.1) <= 1


def test_three_way_is_complete_disjoint_and_stable(people):
    first = {r["id"]: r["split"] for r in S.three_way_split(people, "id", "y").collect()}
    again = {r["id"]: r["split"] for r in S.three_way_split(people.repartition(13, "y"), "id", "y").collect()}
    assert first == again and len(first) == 997
    sizes = Counter(first.values())
    assert sizes["serving"] == 100 and sizes["eval"] == 180 and sizes["train"] == 717
    other = {r["id"]: r["split"] for r in S.three_way_split(people, "id", "y", seed=1).collect()}
    assert other != first


def test_splits_are_runs_of_the_hash_order(people):
    got = {r["id"]: (r["y"], r["split"]) for r in S.three_way_split(people, "id", "y").collect()}
    for y in {v[0] for v in got.values()}:
        order = sorted((i for i in got if got[i][0] == y), key=lambda i: (hashlib.md5(f"{i}-{S.SEED}".encode()).hexdigest(), i))
        told = [got[i][1] for i in order]
        assert told == sorted(told, key=["serving", "eval", "train"].index)


def test_folds_are_runs_of_ids_of_any_type(people):
    numbers = {r["id"]: (r["y"], r["fold"]) for r in S.stratified_kfold(people, "id", "y", 7).collect()}
    texts = S.stratified_kfold(people.withColumn("id", F.concat(F.lit("k"), "id")), "id", "y", 7)
    for got in (numbers, {r["id"]: (r["y"], r["fold"]) for r in texts.collect()}):
        for y in {v[0] for v in got.values()}:
            told = [got[i][1] for i in sorted(i for i in got if got[i][0] == y)]
            assert told == sorted(told)
    assert Counter(f for _, f in numbers.values()).most_common()[-1][1] >= 142


def test_three_way_is_two_holdouts(people):
    both = {r["id"]: r["split"] for r in S.three_way_split(people, "id", "y").collect()}
    first = S.stratified_holdout(people, "id", "y", 0.1)
    serving = {r["id"] for r in first.filter("is_holdout").collect()}
    rest = first.filter("NOT is_holdout").drop("is_holdout")
    evaluation = {r["id"] for r in S.stratified_holdout(rest, "id", "y", 0.2).filter("is_holdout").collect()}
    assert serving == {i for i, s in both.items() if s == "serving"}
    assert evaluation == {i for i, s in both.items() if s == "eval"}


def test_split_is_a_narrow_projection(people):
    plan = S.three_way_split(people, "id", "y")._jdf.queryExecution().executedPlan().toString()
    # only the cuts move: one broadcast of a row per class
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and plan.count("Exchange") == plan.count("BroadcastExchange")


def test_serving_has_no_label(people):
    out = S.serving_emulation(S.three_way_split(people, "id", "y"), "y")
    assert out.columns == ["id"] and out.count() == 100


def test_folds_are_even_runs_of_ids(people):
    out = S.stratified_kfold(people, "id", "y", 10).collect()
    per_fold = Counter(r["fold"] for r in out)
    assert set(per_fold) == set(range(10)) and max(per_fold.values()) - min(per_fold.values()) <= 1
    for y in (0, 1):
        mine = sorted((r["id"], r["fold"]) for r in out if r["y"] == y)
        sizes = Counter(f for _, f in mine)
        assert max(sizes.values()) - min(sizes.values()) <= 1
        assert [f for _, f in mine] == sorted(f for _, f in mine)


def test_string_labels_and_missing_class_rows(spark):
    df = spark.createDataFrame([(i, "it's" if i % 3 else None) for i in range(60)], "id long, y string")
    out = Counter((r["y"], r["is_holdout"]) for r in S.stratified_holdout(df, "id", "y", 0.5).collect())
    assert out[(None, True)] == 10 and out[("it's", True)] == 20
