"""Registered corpus queries against their SQL, and the pipeline against its parts."""

import pytest

import corpus_pipeline
from segmetric.llm.queries import ORACLES, QUERIES
from tests.oracle_harness import compare, duck_connect

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    ok, msg = compare(QUERIES[name](spark, SMALL), ORACLES[name], SMALL, duck_connect(SMALL))
    assert ok, msg


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, kept, SMALL)
        assert after.columns == docs.columns, name
        kept = after
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    joined = QUERIES["op1_ngram_join"](spark, SMALL).collect()
    assert ids <= {r.doc_id for r in joined if r.doc_id == r.component_id}
    leaked = {r.doc_id for r in QUERIES["op2_decontaminate"](spark, SMALL).collect()}
    assert not ids & leaked
    out = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in out.select("doc_id").collect()} <= ids
    assert out.where("shard is null or shard not between 0 and 7").count() == 0


def test_near_duplicates_tells_rows_apart_by_id_and_text(spark):
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(2, base, "e"), (5, base + " more", "c"), (5, "a clean text of its own with enough words to be a set", "c"),
            (7, "red green blue white black brown grey pink gold plum", "x"), (7, "red green blue white black brown grey pink gold", "y"),
            (None, base, "n"), (9, None, "z"), (9, None, "z"), (9, "", "z"), (2, base, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert got.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    sevens = [x for x in left if x[0] == 7]
    assert len(sevens) == 1
    assert [x for x in left if x[0] != 7] == sorted(
        [(2, base), (5, "a clean text of its own with enough words to be a set"), (9, None), (9, "")], key=str)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), SMALL).count() == 0
