import pytest
from pyspark.sql import functions as F

from callwise.sources import snapshots as S


def total(spark, root, version=None):
    return S.read_version(spark, root, version).agg(F.sum("id")).first()[0]


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "table")
    assert S.commit(spark.range(10), path) == 1
    return path


def test_a_table_replaces_itself_with_new_columns(spark, root):
    for k, column in enumerate(("old_rate", "new_rate")):
        assert S.change(spark, root, lambda t, column=column: t.withColumn(column, F.col("id") * 2)) == k + 2
    assert S.read_version(spark, root).columns == ["id", "old_rate", "new_rate"]
    assert S.read_version(spark, root, 1).columns == ["id"] and S.versions(spark, root) == [1, 2, 3]


def test_readers_see_the_old_version_until_the_last_step(spark, root, monkeypatch):
    seen, publish = [], S._publish

    def looking(*args):
        seen.append(total(spark, root))  # all rows are written, nothing is published
        publish(*args)
        seen.append(total(spark, root))

    monkeypatch.setattr(S, "_publish", looking)
    open_reader = S.read_version(spark, root)
    S.commit(spark.range(20), root)
    assert seen == [45, 190] and open_reader.count() == 10  # a reader that began before still has its rows


def test_killed_between_the_steps(spark, root, monkeypatch):
    def dies(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(S, "_publish", dies)
    with pytest.raises(KeyboardInterrupt):
        S.commit(spark.range(99), root)
    assert total(spark, root) == 45 and S.latest_version(spark, root) == 1
    monkeypatch.undo()
    assert S.expire(spark, root, idle_seconds=3600) == []  # it might be at work still
    assert len(S.expire(spark, root, idle_seconds=0)) == 1
    assert S.commit(spark.range(20), root) == 2 and total(spark, root) == 190


def test_two_writers_from_one_version(spark, root, monkeypatch):
    with pytest.raises(S.ConcurrentChange):
        S.commit(spark.range(5), root, base=0)
    publish, raced = S._publish, []

    def second(session, path, version, name):
        if not raced:  # another writer publishes just before this one
            raced.append(1)
            S.commit(spark.range(3), path)
        publish(session, path, version, name)

    monkeypatch.setattr(S, "_publish", second)
    with pytest.raises(S.ConcurrentChange):
        S.commit(spark.range(50), root)
    assert total(spark, root) == 3
    raced.clear()
    assert S.change(spark, root, lambda t: t.withColumn("id", F.col("id") + 1)) == 4  # begins again from the other's rows
    assert total(spark, root) == 6


def test_expire_keeps_the_last_versions(spark, root):
    for n in (2, 3, 4):
        S.commit(spark.range(n), root)
    assert len(S.expire(spark, root, keep=2, idle_seconds=0)) == 2
    assert S.versions(spark, root) == [3, 4] and total(spark, root) == 6 and total(spark, root, 3) == 3
    with pytest.raises(ValueError):
        S.read_version(spark, root + "-none")
