import numpy as np
import pytest
from pyspark.sql import functions as F

from callwise.operators import forest as FO
from callwise.operators import network as NN

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(240, 3))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(240) < 0.05)).astype(int)
    return x, y, np.arange(240) % 3


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y, fold = data
    df = spark.createDataFrame([(i, *map(float, r), int(t), int(f)) for i, (r, t, f) in enumerate(zip(x, y, fold, strict=True))], "id long, a double, b double, c double, y int, fold int")
    return FO.forest_rows(df, "id", COLS, "y", "fold")


def loss(net, w, x, y):
    w1, b1, w2, b2 = net.parts(w)
    z = NN.ACTIVATIONS[net.setting.activation][0](x @ w1 + b1) @ w2 + b2
    return (np.logaddexp(0, z) - y * z).sum()


@pytest.mark.parametrize("activation", ["tanh", "relu", "logistic"])
def test_gradient_equals_differences(data, activation):
    x, y, _ = data
    net = NN.Network.fresh(NN.Setting(5, activation), 3, 1)
    sums = net.sums(x, y)
    assert sums[0] == pytest.approx(loss(net, net.weights, x, y)) and sums[1] == 240
    for i in range(0, len(net.weights), 3):
        step = np.zeros_like(net.weights)
        step[i] = 1e-6
        slope = (loss(net, net.weights + step, x, y) - loss(net, net.weights - step, x, y)) / 2e-6
        assert sums[2 + i] == pytest.approx(slope, rel=1e-4, abs=1e-4)


def test_training_equals_a_plain_loop_on_any_partitioning(rows, data):
    x, y, fold = data
    settings = [NN.Setting(6, "tanh", "adam", 1e-3, 8, 1), NN.Setting(4, "relu", "sgd", 1e-4, 8)]
    one, many = (NN.train(rows.repartition(n), settings, seed=3) for n in (1, 9))
    for i, s in enumerate(settings):
        plain = NN.Network.fresh(s, 3, 3 + i)
        keep = np.ones(240, bool) if s.fold == -1 else fold != s.fold
        losses = [plain.move(plain.sums(x[keep], y[keep])) for _ in range(8)]
        assert one[i].losses == pytest.approx(losses) and many[i].losses == pytest.approx(losses)
        assert many[i].weights == pytest.approx(plain.weights, rel=1e-7, abs=1e-10)


def test_batches_follow_the_rows_not_the_partitions(rows):
    settings = [NN.Setting(6, "tanh", "adam", 1e-3, 3)]
    one, many = (NN.train(rows.repartition(n), settings, batch_rows=70)[0] for n in (1, 5))
    assert one.steps == many.steps == 3 * 4 and one.losses == pytest.approx(many.losses)


def test_an_epoch_reads_every_row_once(rows, monkeypatch):
    seen, kernel = [], NN._job

    def reading(part, networks, job):
        got = [len(x) // 8 for (x,) in part.select("_y").collect()]
        seen.append((sum(got), sorted(r[0] for r in part.select("_block").distinct().collect()), len(part.inputFiles())))
        return kernel(part, networks, job)

    monkeypatch.setattr(NN, "_job", reading)
    NN.train(rows, [NN.Setting(3, "tanh", "adam", 1e-3, 2)], batch_rows=60)
    assert len(seen) == 2 * 4
    for epoch in (seen[:4], seen[4:]):
        assert sum(n for n, *_ in epoch) == 240 and all(n > 0 for n, *_ in epoch)
        blocks = [b for _, own, _ in epoch for b in own]
        assert len(blocks) == len(set(blocks))  # blocks are stored apart: a batch reads its own only
    assert [own for _, own, _ in seen[:4]] != [own for _, own, _ in seen[4:]]  # batches are drawn anew


def test_a_killed_run_goes_on(rows, tmp_path, monkeypatch):
    settings = [NN.Setting(5, "relu", "adam", 1e-4, 6), NN.Setting(5, "tanh", "sgd", 1e-4, 4)]
    whole = NN.train(rows, settings, seed=2)
    calls, job = [], NN._job

    def dying(*args):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("killed")
        return job(*args)

    monkeypatch.setattr(NN, "_job", dying)
    with pytest.raises(RuntimeError):
        NN.train(rows, settings, seed=2, path=str(tmp_path / "state"))
    again = NN.train(rows, settings, seed=2, path=str(tmp_path / "state"))
    assert len(calls) == 4 + 3  # three epochs were there already
    for a, b in zip(whole, again, strict=True):
        assert a.losses == pytest.approx(b.losses) and a.weights == pytest.approx(b.weights)


def test_learning_scores_search_and_empty_table(rows, data):
    x, y, _ = data
    net = NN.train(rows, [NN.Setting(30, "tanh", "adam", 1e-4, 60)], seed=1)[0]
    assert net.losses[-1] < net.losses[0]
    got = {r["_row"]: r["s"] for r in NN.with_score(rows, F.col("_x"), net, "s").collect()}
    assert [got[i] for i in range(240)] == pytest.approx(net.score(x).tolist())
    found = NN.network_search(rows, [0, 1, 2], {**NN.NETWORK_GRID, "hidden": (4, 5, 6)}, epochs=3)
    assert len(found) == 24 * 3 and all(0 <= a <= 1 for _, a in found)
    assert NN.train(rows.limit(0), [NN.Setting()])[0].losses == []
