import numpy as np
import pytest
from pyspark.sql import functions as F

from callwise.operators import neighbors as NB


def brute(ids, x, k):
    out = []
    for i, p in zip(ids, x):
        d = np.zeros(len(x))
        for j in range(x.shape[1]):
            d += (x[:, j] - p[j]) ** 2
        order = sorted((d[m], ids[m]) for m in range(len(ids)) if ids[m] != i)[:k]
        out += [(i, q, r + 1) for r, (_, q) in enumerate(order)]
    return sorted(out)


def structured(n, seed, latent=3, dims=18):
    """Points near a surface of few dimensions, with groups, ties and copies."""
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(latent, dims))
    hidden = rng.normal(size=(n, latent)) + rng.integers(0, 6, size=(n, 1)) * 4
    x = np.round(hidden @ mix + rng.normal(size=(n, dims)) * 0.05, 3)
    x[::17] = x[0]
    return x


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id bigint, x array<double>")


@pytest.mark.parametrize("cell_points", [25, 150])
def test_equal_to_all_pairs_in_18_dimensions(spark, cell_points):
    x = structured(900, 5)
    got = NB.nearest_staged(frame(spark, x), 5, cell_points)
    assert sorted((r["id"], r["neighbor"], r["rank"]) for r in got.collect()) == brute(list(range(len(x))), x, 5)


def test_equal_to_all_pairs_without_structure_and_on_a_grid(spark):
    rng = np.random.default_rng(1)
    for x in (rng.normal(size=(400, 18)), rng.integers(0, 4, size=(500, 3)).astype(float), np.c_[np.arange(300.0) * 1e6, np.zeros(300)]):
        got = NB.nearest_staged(frame(spark, x), 3, 20)
        assert sorted((r["id"], r["neighbor"], r["rank"]) for r in got.collect()) == brute(list(range(len(x))), x, 3)


def test_few_pairs_are_visited_where_the_data_have_structure(spark):
    rows = frame(spark, structured(12_000, 7)).cache()
    share = NB.visited_share(rows, 5, 60)
    print(f"visited {share:.4f} of all pairs")
    assert share < 0.1
