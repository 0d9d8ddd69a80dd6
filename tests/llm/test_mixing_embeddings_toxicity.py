import random
import zlib

import numpy as np
import pandas as pd
import pytest

from callwise.llm import embedding_dedup, mixing, toxicity
from tests.llm.conftest import collected

VECTORS = "vec_id bigint, embedding array<float>, label int, id string, v int, members int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2) for i, v in rows], VECTORS)


def brute(rows, cosine=0.95):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    good = [(i, v / np.sqrt(v @ v)) for i, v in good]
    links = [[j for j, (_, w) in enumerate(good) if j != k and len(v) == len(w) and v @ w >= cosine] for k, (_, v) in enumerate(good)]
    best = [i for i, _ in good]
    for _ in good:
        best = [min([best[k], *(best[j] for j in links[k])]) for k in range(len(good))]
    out = [(i, len(links[k]), best[k], i == best[k]) for k, (i, _) in enumerate(good)]
    ids = {id(v) for v in ()}
    rest = [(i, 0, i, True) for i, v in rows if not (i is not None and v and None not in v and np.isfinite(v).all() and any(v))]
    return sorted(out + rest, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or 0)), ids


@pytest.mark.parametrize(("cell", "visit"), [(2048, 16384), (9, 7)])
def test_links_match_all_pairs(spark, cell, visit):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 8))
    rows = [(k, (base[k % 30] + rng.normal(size=8) * 0.25).astype(np.float32).tolist()) for k in range(150)]
    rows += [(1000 + k, rows[3][1]) for k in range(40)] + [(1100, [2 * x for x in rows[3][1]])]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [1.0, None] + [0.0] * 6), (2004, [float("nan")] + [1.0] * 7), (2005, [float("inf")] + [1.0] * 7)]
    rows += [(2006, [1.0, 2.0]), (2007, [1.0, 2.0]), (None, rows[3][1]), (5, rows[5][1])]
    got = collected(embedding_dedup.embedding_groups(vectors(spark, rows), cell_rows=cell, visit_rows=visit), "vec_id", "n_links", "component_id")
    assert got == brute(rows)[0]
    assert embedding_dedup.embedding_groups(vectors(spark, [])).count() == 0


def test_huge_and_tiny_components_keep_their_direction(spark):
    docs = spark.createDataFrame([(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1e300, -1e300])], "vec_id bigint, embedding array<double>")
    assert collected(embedding_dedup.embedding_groups(docs), "vec_id") == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def raked(table, shares, share, sweeps=200):
    w = table.tokens * share
    total = table.tokens.sum() * share
    for _ in range(sweeps):
        for d, s in shares.items():
            w = np.minimum(table.tokens, w * table[d].map(s) * total / w.groupby(table[d]).transform("sum"))
    return w


def test_raking_meets_the_marginals(spark):
    rng = np.random.default_rng(7)
    cells = [(f"s{a}", f"l{b}", f"t{c}", int(rng.integers(100, 5000)), 10) for a in range(4) for b in range(3) for c in range(3)]
    table = pd.DataFrame(cells, columns=["source", "lang", "topic", "tokens", "members"])
    frame = spark.createDataFrame(table)
    targets = {d: mixing.tempered(frame, d) for d in mixing.DIMENSIONS}
    shares = {}
    for d in mixing.DIMENSIONS:
        p = table.groupby(d).tokens.sum() ** mixing.TEMPERATURE
        shares[d] = p / p.sum()
    got = mixing.rake(frame, targets, share=0.4).toPandas().sort_values(["source", "lang", "topic"]).reset_index(drop=True)
    want = raked(table, shares, 0.4)
    assert np.allclose(got.weight, want, rtol=1e-3)
    for d in mixing.DIMENSIONS:
        assert np.allclose(got.groupby(d).weight.sum(), shares[d] * table.tokens.sum() * 0.4, rtol=1e-3)


def test_mix_samples_by_the_calibrated_probabilities(make, words, odd):
    rows = [*odd, *[(1000 + k, words(20 + k % 50, k)) for k in range(900)]]
    docs = make(rows)
    got = mixing.mix(docs).toPandas()
    assert len(got) == len(rows)
    assert got.groupby("doc_id").sampled.nunique().max() == 1
    kept = got[got.doc_id >= 1000]
    assert abs(kept.sampled.mean() - kept.probability.mean()) < 0.06
    assert got.probability.between(0, 1).all()
    again = mixing.mix(docs.repartition(5)).toPandas()
    assert sorted(again[again.sampled].doc_id.dropna()) == sorted(got[got.sampled].doc_id.dropna())
    left = mixing.sample(docs)
    assert left.columns == docs.columns and left.count() == int(got.sampled.sum())
    assert mixing.mix(make([])).count() == 0


def test_words_and_topics(make):
    got = {r["doc_id"]: (r["n_tokens"], r["topic"], r["source"], r["lang"]) for r in mixing.described(make([(2, "a bb  ccc\n"), (3, None), (4, "parliament " * 5)])).collect()}
    assert got[2][:2] == (3, "(none)") and got[3][:2] == (0, "(none)")
    assert got[4][0] == 5 and got[4][1].startswith("t") and got[4][3] == "(none)"


def plain_segments(s):
    out = []

    def cut(a, b):
        best = max(((sum(s[i : j + 1]), -i, -j) for i in range(a, b) for j in range(i, b)), default=(0,))
        if best[0] > 0:
            i, j = -best[1], -best[2]
            cut(a, i)
            out.append((i, j, best[0]))
            cut(j + 1, b)

    cut(0, len(s))
    return out


def test_segments_match_the_recursive_definition():
    draw = random.Random(3)
    for _ in range(400):
        s = [draw.choice([-0.7, -0.7, -0.7, 0.1 + draw.random() * 3]) for _ in range(draw.randint(0, 14))]
        got = toxicity.segments([k for k, x in enumerate(s) if x > 0], [x for x in s if x > 0], -0.7)
        assert [(a, b, round(x, 9)) for a, b, x in got] == [(a, b, round(x, 9)) for a, b, x in plain_segments(s)]


@pytest.fixture(scope="module")
def labelled(spark, make, words, odd):
    bad = ["vilewort", "grubface", "snotling"]
    rows = []
    for k in range(1000, 1900):
        text = words(120, k).split()
        if k % 6 == 0:
            for p in range(10, 110, 20):
                text[p] = bad[(k + p) % 3] + "xyz"[k % 3]
        rows.append((k, " ".join(text)))
    labels = spark.createDataFrame([(i, int(i % 6 == 0), 1) for i, _ in rows] + [(1, None, 0), (99, 1, 0)], "doc_id bigint, toxic int, score int")
    return make([*odd, *rows]), labels


def test_toxicity_on_held_out_documents(labelled, odd):
    docs, labels = labelled
    model = toxicity.trained(docs, labels)
    scored = toxicity.add_scores(docs, model, passages="found").withColumn("held", toxicity.held_out()).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    held = [r for r in scored if (r["doc_id"] or 0) >= 1000 and r["held"]]
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored if r["doc_id"] is not None)
    right = sum((r["score"] >= 0.7) == (r["doc_id"] % 6 == 0) for r in held)
    assert len(held) > 200 and right >= 0.98 * len(held)
    assert all(r["score"] < 0.7 for r in scored if (r["doc_id"] or 0) < 1000)
    span = next(r["found"] for r in held if r["doc_id"] % 6 == 0)
    assert span[0]["first"] >= 10 and span[-1]["end"] <= 91


def test_training_ignores_held_out_labels(labelled):
    from pyspark.sql import functions as F

    docs, labels = labelled
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.trained(docs, labels), toxicity.trained(docs, flipped)
    assert (a.stems == b.stems).all() and (a.intercept, a.slope) == (b.intercept, b.slope)


def test_toxic_stage_keeps_columns_and_survives_missing_classes(labelled, make, spark):
    docs, labels = labelled
    left = toxicity.drop_toxic(docs, labels, 0.7)
    assert left.columns == docs.columns
    assert left.filter("text IS NULL").count() == docs.filter("text IS NULL").count()
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.drop_toxic(docs, none, 0.7).count() == docs.count()
    assert toxicity.drop_toxic(make([]), labels, 0.7).count() == 0
