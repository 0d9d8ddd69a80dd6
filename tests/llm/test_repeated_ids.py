"""Two texts under one id, repeated rows and rows without id through the operators and the whole pipeline."""

import duckdb
import pytest

import corpus_pipeline
from callwise.llm import exact_dedup, line_dedup, mixing, oracle, simhash
from callwise.sources.staging import stage

A, B, U = "the quick brown fox jumps over it", "some other words stand in this one", "unique words that nobody else has written here"


def rows_of(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in df.select("doc_id", "text").collect())


def test_near_stage_keeps_the_other_text_of_an_id(make):
    assert rows_of(simhash.drop_near_duplicates(make([(1, A), (5, A), (5, U), (None, B)]))) == [(-1, B), (1, A), (5, U)]
    # two texts of the smallest id that are near each other: one stays
    left = rows_of(simhash.drop_near_duplicates(make([(1, A), (1, A + " "), (1, A), (2, A.upper())])))
    assert len(set(left)) == 1 and left[0][0] == 1
    assert simhash.drop_near_duplicates(make([])).count() == 0


def test_lines_of_another_text_under_one_id(make):
    got = {(r["doc_id"], r["text"]) for r in line_dedup.line_dedup(make([(1, "a\nb\nc"), (5, "a\nb\nc"), (5, "x\ny\nz"), (5, "x\ny\nz")])).collect()}
    assert got == {(1, "a\nb\nc"), (5, ""), (5, "x\ny\nz")}


def test_group_size_counts_rows_as_the_twin_does(make):
    docs = make([(5, "abc"), (5, "ABC"), (7, "abc"), (7, "x"), (7, "x"), (8, "y")])
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    want = sorted(con.execute(oracle.ORACLE["op10_exact_dedup"]).fetchall())
    mine = exact_dedup.with_copies(docs)
    assert sorted(tuple(r) for r in mine.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == want


def test_a_row_is_sampled_by_its_own_draw(spark):
    rows = [(i, f"{t} words of document {i} and {t}", "en" if t == "one" else "de", f"s{i % 2}", 1) for i in range(400) for t in ("one", "two")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    drawn = {(r["doc_id"], r["lang"]) for r in mixing.mix(docs).filter("sampled").collect()}
    left = [(r["doc_id"], r["lang"]) for r in mixing.sample(docs).collect()]
    assert len(left) == len(set(left)) and set(left) == drawn


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    """The small documents with repeated rows, second texts, missing ids, nulls and clashing extra columns."""
    root = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(3, U + " three", None, None, None), (4, A, "en", "x", 1), (4, A, "en", "x", 1), (4, B, "en", "x", 1), (None, U, None, None, None), (None, None, None, None, None), (999999, "", "fr", "x", 0)], docs.schema)
    clashing = {"score": "1.5", "kept": "'x'", "key": "'k'", "component_id": "7", "_gone_id": "1", "_taken_key": "2", "gid": "3", "full_hash": "4", "n_bytes": "5"}
    docs.unionByName(extra).selectExpr("*", *[f"{v} AS {k}" for k, v in clashing.items()]).write.parquet(f"{root}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{root}/labels.parquet")
    docs.selectExpr("*", *[f"{v} AS {k}" for k, v in clashing.items()]).limit(0).write.parquet(f"{root}-empty/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").limit(0).write.parquet(f"{root}-empty/labels.parquet")
    return str(root)


def test_pipeline_with_odd_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, apply in corpus_pipeline.STAGES[:3]:
        docs = stage(apply(spark, docs, folder), "odd-" + name.replace(" ", "-"))
        left = rows_of(docs)
        assert (3, U + " three") in left and (4, B) in left and (-1, U) in left and any(t == A for _, t in left), name
    assert len(left) == len(set(left)) and len(docs.columns) == 14
    packed = corpus_pipeline.run(spark, folder)
    assert packed.count() > 0
    assert packed.groupBy("sequence_id").agg({"length": "sum"}).filter("`sum(length)` > 1024").count() == 0


def test_pipeline_of_an_empty_table(spark, folder):
    assert corpus_pipeline.run(spark, f"{folder}-empty").count() == 0
