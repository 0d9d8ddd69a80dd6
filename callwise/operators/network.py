"""Multi-layer perceptrons with one hidden layer, trained by synchronous steps over partitioned rows.

A step is one Spark job: tasks form the loss and gradient sums of their rows under every network that is being trained, Spark
sums them by place, and the driver moves the weights (Adam, or momentum with look-ahead). Rows are stored as blocks chosen by
a hash of (seed, row), many to a batch; each epoch shuffles the blocks anew and deals them to its batches. An epoch so reads
every row once, however many batches it has, and what a network sees does not depend on the partitioning. All settings and folds of a search train
in the same jobs. Tasks keep nothing between steps, so a lost executor costs the tasks it was running; with ``path`` the
weights are written after every epoch, and a killed run goes on from the last one.

Rows are those of ``forest.forest_rows``: fold and synthetic rows as in ``newton.training_rows``.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callwise.functions.workers import with_library
from callwise.operators.newton import _member, _sigmoid
from callwise.operators.resampling import ALL
from callwise.operators.splits import SEED
from callwise.sources.staging import fresh_path, local_rows

STRIP = 1_024
BATCH_ROWS = 1_000_000
#: Blocks of a batch, and rows of a block where all rows are one batch.
BLOCKS, BLOCK_ROWS = 24, 40_000
STRIPS = "_fold binary, _only binary, _y binary, _x binary, _block int"
RATE, MOMENTUM, BETAS, TINY = 1e-3, 0.9, (0.9, 0.999), 1e-8
PATIENCE, LEAST_GAIN = 10, 1e-4

#: The search of the reference.
NETWORK_GRID: Mapping[str, Sequence] = {"hidden": (50, 100, 150), "activation": ("tanh", "relu"), "solver": ("sgd", "adam"), "alpha": (1e-4, 1e-3)}

#: Activation and its slope, the latter from the activation's value.
ACTIVATIONS = {
    "tanh": (np.tanh, lambda a: 1.0 - a * a),
    "relu": (lambda z: np.maximum(z, 0.0), lambda a: (a > 0).astype(float)),
    "logistic": (_sigmoid, lambda a: a * (1.0 - a)),
}


@dataclass(frozen=True)
class Setting:
    hidden: int = 100
    activation: str = "relu"
    solver: str = "adam"
    alpha: float = 1e-4
    epochs: int = 300
    fold: int = ALL


@dataclass
class Network:
    """Weights as one vector: input to hidden, hidden biases, hidden to output, output bias."""

    setting: Setting
    inputs: int
    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: int = 0
    losses: list[float] = field(default_factory=list)
    done: bool = False

    @classmethod
    def fresh(cls, setting: Setting, inputs: int, seed: int) -> Network:
        rng, h = np.random.default_rng(seed), setting.hidden
        factor = 2.0 if setting.activation == "logistic" else 6.0
        one, two = np.sqrt(factor / (inputs + h)), np.sqrt(factor / (h + 1))
        w = np.concatenate([rng.uniform(-one, one, inputs * h), rng.uniform(-one, one, h), rng.uniform(-two, two, h), rng.uniform(-two, two, 1)])
        return cls(setting, inputs, w, np.zeros_like(w), np.zeros_like(w))

    def parts(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        d, h = self.inputs, self.setting.hidden
        return v[: d * h].reshape(d, h), v[d * h : d * h + h], v[d * h + h : d * h + 2 * h], v[-1]

    def score(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.parts(self.weights)
        return _sigmoid(ACTIVATIONS[self.setting.activation][0](x @ w1 + b1) @ w2 + b2)

    def sums(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Loss, number of rows, then the gradient, summed over the rows."""
        w1, b1, w2, b2 = self.parts(self.weights)
        act, slope = ACTIVATIONS[self.setting.activation]
        a = act(x @ w1 + b1)
        z = a @ w2 + b2
        off = _sigmoid(z) - y
        back = off[:, None] * w2 * slope(a)
        return np.concatenate([[(np.logaddexp(0.0, z) - y * z).sum(), len(y)], (x.T @ back).ravel(), back.sum(0), a.T @ off, [off.sum()]])

    def move(self, sums: np.ndarray) -> float:
        """One step of the solver; returns the penalised mean loss before it."""
        n, s = sums[1], self.setting
        if not n:
            return 0.0
        w1, _, w2, _ = self.parts(self.weights)
        gradient = sums[2:] / n
        g1, _, g2, _ = self.parts(gradient)
        g1 += s.alpha * w1 / n
        g2 += s.alpha * w2 / n
        loss = sums[0] / n + 0.5 * s.alpha * ((w1 * w1).sum() + (w2 * w2).sum()) / n
        self.steps += 1
        if s.solver == "adam":
            self.first = BETAS[0] * self.first + (1 - BETAS[0]) * gradient
            self.second = BETAS[1] * self.second + (1 - BETAS[1]) * gradient * gradient
            rate = RATE * np.sqrt(1 - BETAS[1] ** self.steps) / (1 - BETAS[0] ** self.steps)
            self.weights = self.weights - rate * self.first / (np.sqrt(self.second) + TINY)
        else:
            self.first = MOMENTUM * self.first - RATE * gradient
            self.weights = self.weights + MOMENTUM * self.first - RATE * gradient
        return float(loss)

    def judge(self) -> None:
        """Ends when the loss has not fallen by LEAST_GAIN below the best for more than PATIENCE epochs, or after all epochs."""
        best, idle = np.inf, 0
        for loss in self.losses:
            idle = 0 if loss < best - LEAST_GAIN else idle + 1
            best = min(best, loss)
        self.done = idle > PATIENCE or len(self.losses) >= self.setting.epochs

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, weights=self.weights, first=self.first, second=self.second, steps=self.steps, losses=np.array(self.losses))
        return out.getvalue()

    def unpack(self, raw: bytes) -> None:
        z = np.load(io.BytesIO(raw))
        self.weights, self.first, self.second, self.steps, self.losses = z["weights"], z["first"], z["second"], int(z["steps"]), z["losses"].tolist()
        self.judge()


def _strips(rows: DataFrame, blocks: int, seed: int = SEED) -> DataFrame:
    """The rows of each block as a stored table (``STRIPS``), partitioned by block, STRIP rows at most in one row as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(4).to_numpy()
            ends = np.flatnonzero(np.r_[block[1:] != block[:-1], True]) + 1 if len(block) else []
            out: list[tuple] = []
            for start, end in zip([0, *ends[:-1]], ends, strict=True):
                for at in range(start, end, STRIP):
                    b = batch.slice(at, min(STRIP, end - at))
                    only = b.column(1).fill_null(ALL - 1).to_numpy(zero_copy_only=False)
                    x = b.column(3).flatten().to_numpy()
                    out.append((*(v.tobytes() for v in (b.column(0).to_numpy(), only, b.column(2).to_numpy(), x)), int(block[at])))
            kinds = (pa.binary(),) * 4 + (pa.int32(),)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=[c.split()[0] for c in STRIPS.split(", ")])

    placed = rows.select("_fold", "_only", "_y", "_x", F.pmod(F.xxhash64(F.lit(seed), "_row"), F.lit(blocks)).cast("int").alias("_block"))
    path = fresh_path(rows.sparkSession, "strips")
    placed.repartition(blocks, "_block").sortWithinPartitions("_block").mapInArrow(pack, STRIPS).write.partitionBy("_block").parquet(path)
    return rows.sparkSession.read.schema(STRIPS).parquet(path)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for fold, only, y, x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            y = np.frombuffer(y)
            yield np.frombuffer(fold, np.int32), np.frombuffer(only, np.int32), y, np.frombuffer(x).reshape(len(y), -1)


def _job(strips: DataFrame, networks: Sequence[Network], kernel) -> list[np.ndarray]:
    """Sums of ``kernel(network, own rows of fold, only, y, x)`` per network over all strips."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: list = [None] * len(networks)
        for block in _rows(batches):
            for i, net in enumerate(networks):
                part = kernel(net, *block)
                totals[i] = part if totals[i] is None else totals[i] + part
        for i, total in enumerate(totals):
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), i, np.int32)), pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["net", "place", "value"])

    sums = strips.select("_fold", "_only", "_y", "_x").mapInArrow(run, "net int, place int, value double").groupBy("net", "place").agg(F.sum("value").alias("value")).toArrow()
    net, place, value = (sums[c].to_numpy() for c in ("net", "place", "value"))
    return [value[net == i][np.argsort(place[net == i])] for i in range(len(networks))]


def _train(net: Network, fold: np.ndarray, only: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    own = _member(fold, only, np.array([net.setting.fold]))[:, 0] > 0
    return net.sums(x[own], y[own])


def _test(net: Network, fold: np.ndarray, only: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    own = (only < ALL) & (fold == net.setting.fold)
    return np.array([((net.score(x[own]) > 0.5) == (y[own] > 0)).sum(), own.sum()], float)


def _blocks(rows: int) -> int:
    return max(1, -(-rows // BLOCK_ROWS))


def train(rows: DataFrame, settings: Sequence[Setting], seed: int = SEED, batch_rows: int = BATCH_ROWS, path: str | None = None) -> list[Network]:
    """Train a network for each setting on the stored ``rows``; with ``path`` a run that was killed goes on where it was.

    Rows are cut into batches of about ``batch_rows``, other ones in every epoch. An empty table leaves the weights as they were drawn.
    """
    with_library(rows)
    spark, first = rows.sparkSession, rows.select("_x").first()
    if first is None:
        return [Network.fresh(s, 0, seed + i) for i, s in enumerate(settings)]
    networks = [Network.fresh(s, len(first["_x"]), seed + i) for i, s in enumerate(settings)]
    number = rows.count()
    batches = max(1, -(-number // batch_rows))
    blocks = batches * BLOCKS if batches > 1 else _blocks(number)
    strips = _strips(rows, blocks, seed)
    epoch = _resumed(spark, path, networks) if path else 0
    while live := [n for n in networks if not n.done]:
        epoch += 1
        totals = np.zeros((len(live), 2))
        dealt = np.random.default_rng([seed, epoch]).permutation(blocks).reshape(batches, -1)
        for own in dealt.tolist():
            part = strips if batches == 1 else strips.filter(F.col("_block").isin(own))
            for i, (net, sums) in enumerate(zip(live, _job(part, live, _train), strict=True)):
                if len(sums):
                    totals[i] += [net.move(sums) * sums[1], sums[1]]
        for net, (loss, n) in zip(live, totals, strict=True):
            net.losses.append(float(loss / n) if n else 0.0)
            net.judge()
        if path:
            state = [(i, n.packed()) for i, n in enumerate(networks)]
            local_rows(spark, state, "net int, state binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    return networks


def _resumed(spark, path: str, networks: Sequence[Network]) -> int:
    """Take up the state of the last epoch that was written whole; 0 if there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    written = [f.getPath() for f in files.listStatus(folder)] if files.exists(folder) else []
    epochs = [int(p.getName().split("=")[1]) for p in written if p.getName().startswith("epoch=") and files.exists(p.suffix("/_SUCCESS"))]
    if not epochs:
        return 0
    for r in spark.read.parquet(f"{path}/epoch={max(epochs)}").collect():  # a row per network
        networks[r["net"]].unpack(r["state"])
    return max(epochs)


def network_search(rows: DataFrame, folds: Sequence[int], grid: Mapping[str, Sequence] = NETWORK_GRID, epochs: int = 300, seed: int = SEED, path: str | None = None) -> list[tuple[Setting, float | None]]:
    """Accuracy at 0.5 of every setting on the real rows of every fold, all trained side by side."""
    settings = [Setting(h, a, s, p, epochs, f) for h, a, s, p in product(grid["hidden"], grid["activation"], grid["solver"], grid["alpha"]) for f in folds]
    networks = train(rows, settings, seed, path=path)
    tested = _job(_strips(rows, _blocks(rows.count())), networks, _test)
    return [(n.setting, float(t[0] / t[1]) if len(t) and t[1] else None) for n, t in zip(networks, tested, strict=True)]


def with_score(df: DataFrame, x, network: Network, name: str = "score") -> DataFrame:
    """Add the probability of label 1; ``x`` is an array column, null for null."""
    w1, b1, w2, b2 = network.parts(network.weights)
    plain = "array({})".format
    numbers = lambda v: plain(", ".join(f"{float(u)!r}D" for u in v))
    act = {"tanh": "tanh(z)", "relu": "greatest(z, 0D)", "logistic": "1D / (1D + exp(-z))"}[network.setting.activation]
    columns = plain(", ".join(numbers(c) for c in w1.T))
    dot = "aggregate(zip_with({}, {}, (u, v) -> u * v), {}, (s, v) -> s + v)".format
    hidden = f"transform(zip_with({columns}, {numbers(b1)}, (w, b) -> {dot('_x', 'w', 'b')}), z -> {act})"
    return df.withColumn("_x", x).withColumn(name, F.expr(f"1D / (1D + exp(-({dot(hidden, numbers(w2), f'{float(b2)!r}D')})))")).drop("_x")
