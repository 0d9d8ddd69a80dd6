"""Toxicity by maximum-scoring segments over token log-odds.

Training: for every word stem (its first bytes) the labelled documents of each class that hold it are counted; the
log-odds between the classes under a Dirichlet prior, and their standard error, decide which stems enter the lexicon.
Scoring: a token scores the log-odds of its strongest stem, any other token the small negative log-odds of not being in the
lexicon. One linear scan gives all maximal segments of a text. Under the clean background the best segment of n tokens
follows an extreme-value law, P(S > s) = 1 - exp(-K n exp(-lambda s)). K is the share of lexicon tokens in clean text, as
every segment starts at one (clumps of a Poisson process). A segment counts by -ln P, a document by the sum over its
significant segments, and a logistic curve fitted on the labelled documents turns that into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from callwise.llm.common import map_texts, reachable, texts
from callwise.llm.words import groups, LETTERS, scan, stem_hashes
from callwise.sources.staging import stage

STEMS = (4, 5, 6, 7, 8, 10)
PRIOR = 0.5  # Dirichlet pseudo-documents per stem and class at least
PRIOR_DOCS = 50.0  # and so many more, shared out by how common the stem is in both classes together
LEAST_Z = 3.0
LEAST_ODDS = 2.0
LEXICON = 262_144  # a bound on the model, 4 MB; the strongest stems stay
SIGNIFICANT = 3.0  # nats: a chance of 5 % that clean text of this length has such a segment
BINS = 4_096
BIN = 0.05


@dataclass(frozen=True)
class Model:
    stems: np.ndarray  # sorted hashes
    odds: np.ndarray
    neutral: float  # score of a token outside the lexicon
    rate: float  # lambda
    scale: float = 1.0  # K
    intercept: float = 0.0
    slope: float = 0.0


def segments(at: list[int], scores: list[float], neutral: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, last, score)`` in one pass (Ruzzo and Tompa 1999).

    ``at`` are the positions of the positive scores; the tokens between them score ``neutral`` (below zero) each. A
    list of candidates keeps the running sum before and after each one. A new candidate joins the nearest earlier one
    that starts lower, if that one also ends lower; what lies between them is then inside the joined segment.
    """
    found: list[list] = []  # first, last, sum before, sum after, index of the nearest candidate that starts lower
    total, here = 0.0, 0
    for position, score in zip(at, scores, strict=True):
        before = total + neutral * (position - here)
        total, here = before + score, position + 1
        new = [position, position, before, total, -1]
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new[0], new[2] = found[j][0], found[j][2]
            back = found[j][4]
            del found[j:]
            j = back
    return [(a, b, up - low) for a, b, low, up, _ in found]


def _token_scores(model: Model, raws: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per group of texts: ``(words per text, text of each lexicon token, its place, its score)``."""
    gate = np.zeros(65_536, bool)
    gate[(model.stems & np.uint64(0xFFFF)).astype(np.int64)] = True
    for a, b in groups(raws):
        data, starts, ends, doc = scan(raws[a:b], LETTERS)
        score = np.zeros(len(starts))
        for h in stem_hashes(data, starts, ends, STEMS) if len(model.stems) else ():
            maybe = np.flatnonzero(gate[(h & np.uint64(0xFFFF)).astype(np.int64)])
            to = np.minimum(np.searchsorted(model.stems, h[maybe]), len(model.stems) - 1)
            hit = model.stems[to] == h[maybe]
            score[maybe[hit]] = np.maximum(score[maybe[hit]], model.odds[to[hit]])
        number = np.bincount(doc, minlength=b - a)
        first = np.cumsum(number) - number
        hits = np.flatnonzero(score)
        yield number, doc[hits], hits - first[doc[hits]], score[hits]


def passages_of(model: Model, raws: list[bytes]) -> list[list[tuple[int, int, float]]]:
    """Significant segments ``(first word, word after the last, -ln P)`` of each text."""
    out: list[list[tuple[int, int, float]]] = []
    for number, doc, place, score in _token_scores(model, raws):
        cuts = np.searchsorted(doc, np.arange(len(number) + 1))
        for i, n in enumerate(number.tolist()):
            a, b = cuts[i], cuts[i + 1]
            found = segments(place[a:b].tolist(), score[a:b].tolist(), model.neutral) if b > a else []
            expected = [model.scale * n * math.exp(-min(model.rate * s, 600.0)) for _, _, s in found]
            nats = [-math.log(-math.expm1(-e)) for e in expected]
            out.append([(f, last + 1, x) for (f, last, _), x in zip(found, nats, strict=True) if x > SIGNIFICANT])
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Fit on the rows of ``labels`` that have a label; every one of them counts, repeated ones too.

    Without rows of both classes the lexicon is empty and all documents get the share of the label (one half without any).
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("_d"), (F.col(label) == 1).cast("int").alias("label")).filter("label IS NOT NULL")
    learned = texts(docs).join(known.hint("shuffle_hash"), F.col("doc_id") == F.col("_d")).select("label", "text")
    learned = stage(learned, "labelled")

    def count(marks: list, raws: list) -> dict:
        stems, toxic, clean, words = [], [], [], 0
        for a, b in groups(raws, 16 << 20):
            data, starts, ends, doc = scan(raws[a:b], LETTERS)
            words += len(starts)
            held = stem_hashes(data, starts, ends, STEMS)
            cuts = np.searchsorted(doc, np.arange(b - a + 1))
            each = [np.unique(np.concatenate([h[x:y] for h in held])) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            for flag, into in ((1, toxic), (0, clean)):
                of = [e for e, m in zip(each, marks[a:b], strict=True) if m == flag]
                values, n = np.unique(np.concatenate(of), return_counts=True) if of else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
                stems.append(values[values > 0])
                n = n[values > 0]
                into.append(n)
                (clean if flag else toxic).append(np.zeros(len(n), np.int64))
        stems.append(np.zeros(1, np.uint64))  # the row of totals
        toxic.append(np.array([sum(marks)]))
        clean.append(np.array([len(marks) - sum(marks)]))
        size = np.zeros(sum(map(len, stems)), np.int64)
        size[-1] = words
        return {"stem": np.concatenate(stems).view(np.int64), "toxic": np.concatenate(toxic), "clean": np.concatenate(clean), "words": size}

    counted = map_texts(learned, count, "stem bigint, toxic bigint, clean bigint, words bigint", ("label", "text"))
    summed = stage(counted.groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "words")]), "stems")
    totals = summed.filter("stem = 0").first()
    n_toxic, n_clean, words = (int(totals[c]) for c in ("toxic", "clean", "words")) if totals else (0, 0, 0)
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), -0.05, 1.0, 1.0, float(np.log((n_toxic + 0.5) / (n_clean + 0.5))), 0.0)
    if not n_toxic or not n_clean:
        return empty
    prior = PRIOR + PRIOR_DOCS * (F.col("toxic") + F.col("clean")) / (n_toxic + n_clean)
    odds = lambda y, n: F.log((F.col(y) + prior) / (n - F.col(y) + prior))
    error = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    scored = summed.filter("stem <> 0").withColumn("odds", odds("toxic", n_toxic) - odds("clean", n_clean)).withColumn("z", F.col("odds") / error)
    best = scored.filter((F.col("z") > LEAST_Z) & (F.col("odds") > LEAST_ODDS)).orderBy(F.desc("z"), "stem").limit(LEXICON).toArrow()
    if not best.num_rows:
        return empty
    stems = best["stem"].to_numpy().view(np.uint64)
    order = np.argsort(stems)
    s = best["odds"].to_numpy()[order]
    # share of lexicon tokens in clean text, and lambda: the positive root of sum p exp(lambda s) = 1
    share = np.minimum((best["clean"].to_numpy()[order] + PRIOR) / max(words, 1), 0.5)
    inside = float(min(share.sum(), 0.5))
    expected = float(min(max((share * np.exp(s)).sum(), 2 * inside), 0.5))
    neutral = float(min(np.log((1 - expected) / (1 - inside)), -0.01))
    grown = lambda rate: (share * np.exp(rate * s)).sum() + (1 - inside) * np.exp(rate * neutral)
    low, high = 1e-3, 1.0
    while grown(high) < 1 and high < 16:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if grown(middle) < 1 else (low, middle)
    model = Model(stems[order], s, neutral, high, inside)

    def bins(marks: list, raws: list) -> dict:
        x = np.array([_evidence(p) for p in passages_of(model, raws)])
        return {"bin": np.minimum(np.rint(x / BIN), BINS).astype(np.int64), "label": pa.array(marks, pa.int64())}

    table = map_texts(learned, bins, "bin bigint, label bigint", ("label", "text")).groupBy("bin", "label").count().toArrow()  # 2 * BINS rows at most
    intercept, slope = _logistic(table["bin"].to_numpy() * BIN, table["label"].to_numpy(), table["count"].to_numpy())
    return Model(model.stems, model.odds, model.neutral, model.rate, model.scale, intercept, slope)


def _evidence(found: list[tuple[int, int, float]]) -> float:
    return float(np.log1p(sum(x for _, _, x in found)))


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Newton's method for ``P(y) = 1 / (1 + exp(-(a + b x)))`` over counted values; the ridge keeps separated classes finite."""
    design, w = np.stack([np.ones_like(x, float), x.astype(float)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        slope = design.T @ (n * (y - p)) - ridge * w
        step = np.linalg.solve(design.T @ (design * (n * p * (1 - p))[:, None]) + ridge * np.eye(2), slope)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(w[1], 0.0))


def add_scores(docs: DataFrame, model: Model, score: str = "score", passages: str | None = None) -> DataFrame:
    """``docs`` with all of its columns and the probability of the label; a column called ``score`` is replaced.

    ``passages`` names a column for the significant passages ``(first word, word after the last, -ln P)``. The
    score reads the text alone; null and empty texts get that of a text without evidence. Row by row, no shuffle.
    """
    reachable(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (score, passages)]
    read = docs.select(*[F.col(_quoted(c)) for c in kept], F.coalesce(F.col("text").cast("string"), F.lit("")))
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in read.schema.fields[:-1])
    kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("nats", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for batch in batches:
            found = passages_of(m, batch.columns[-1].cast(pa.binary()).to_pylist())
            x = np.array([_evidence(p) for p in found], float)
            columns = [*batch.columns[:-1], pa.array(1 / (1 + np.exp(-np.clip(m.intercept + m.slope * x, -35, 35))))]
            if passages:
                columns.append(pa.array([[dict(zip(("first", "end", "nats"), p, strict=True)) for p in ps] for ps in found], kind))
            yield pa.RecordBatch.from_arrays(columns, [*kept, score, *([passages] if passages else [])])

    schema = f"{fields}, {_quoted(score)} double" + (f", {_quoted(passages)} array<struct<first:int,end:int,nats:double>>" if passages else "")
    return read.mapInArrow(run, schema)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Documents that training never reads: crc32 of the id as text leaves 1 when divided by 3."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    return train(docs, labels.filter(~held_out()))


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float) -> DataFrame:
    """``docs`` with its own columns, without the documents that score ``limit`` or more."""
    score = "score"
    while score in docs.columns:
        score = "_" + score
    return add_scores(docs, trained(docs, labels), score).filter(F.col(score) < limit).select(*[F.col(_quoted(c)) for c in docs.columns])
