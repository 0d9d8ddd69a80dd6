"""The pipeline against a plain version of its deciding steps, and its queries against their SQL twins."""

import duckdb
import pytest

import corpus_pipeline
from callwise.llm import oracle, queries, toxicity
from callwise.sources.staging import stage
from tests.llm.test_exact_and_simhash import fingerprint, lower, smallest_reachable


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, apply in corpus_pipeline.STAGES:
        out.append((name, docs, docs := stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))))
    return out


def test_each_stage_decides_as_the_plain_version(spark, sf_dir, stages):
    (_, docs, clean), (_, _, single), (_, _, apart), (_, _, sampled), (_, _, packed) = stages
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns == docs.columns
    model = toxicity.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    toxic = {r["doc_id"] for r in toxicity.add_scores(docs, model).filter("score >= 0.7").collect()}
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    assert ids(clean) == ids(docs) - toxic and toxic
    last = {}
    for r in sorted(clean.collect(), key=lambda r: r["doc_id"]):
        last[lower(r["text"])] = r["doc_id"]
    assert ids(single) == set(last.values())
    rows = single.collect()
    best = smallest_reachable([r["doc_id"] for r in rows], [fingerprint(r["text"]) for r in rows])
    assert ids(apart) == {i for i, c in best.items() if i == c}
    assert ids(sampled) <= ids(apart) and len(ids(sampled)) > 0.5 * len(ids(apart))
    assert ids(packed) == ids(sampled)


def test_run_returns_the_last_stage(spark, sf_dir, stages):
    got = {tuple(r) for r in corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "ids_crc32").collect()}
    assert got == {tuple(r) for r in stages[-1][2].select("doc_id", "piece", "ids_crc32").collect()}


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_queries_match_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    mine = queries.QUERIES[name](spark, sf_dir).toPandas()
    theirs = con.execute(oracle.ORACLE[name]).fetchdf()[mine.columns]
    order = list(mine.columns)
    assert mine.sort_values(order).astype(str).values.tolist() == theirs.sort_values(order).astype(str).values.tolist()


def test_all_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2:3].isdigit()} == set(range(1, 14)) and "pipeline" in names
