"""The pipeline's stages, and the registered SQL on the smallest tables."""

import hashlib

import duckdb
import pytest

import corpus_pipeline
from tickline.llm.oracle import ORACLE
from tickline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels")


def test_stages_chain_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialise(stage(spark, docs, SF), name)
        ids = [r["doc_id"] for r in out.select("doc_id").collect()]
        assert out.columns == columns, name
        assert len(ids) == len(set(ids)) and set(ids) <= seen, name
        # a stage run again on its own result changes nothing more, but for the ratio, whose corpus has changed
        docs, seen = out, set(ids)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    rows = last.collect()
    assert {r["doc_id"] for r in rows} == seen and all(r["round_trip"] for r in rows)
    run = {(r["doc_id"], r["sample"]): r["ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert run == {(r["doc_id"], r["sample"]): r["ids"] for r in rows}


def test_stages_take_awkward_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (None, "x y z", "b"), (3, "one line " * 40, "c"), (3, "one line " * 40, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert name == "sentencepiece_sampling" or out.columns == docs.columns
        out.collect()
        assert stage(spark, docs.where("1 = 0"), SF).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    want = sorted(map(repr, cursor.fetchall()))
    got = QUERIES[name](spark, SF)
    assert set(got.columns) == set(columns)
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == want


def test_no_operator_reads_labels_of_its_own_scores(spark):
    """Scores depend on the text alone: equal texts get equal scores."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for name in ("op2_toxicity", "op7_pu_quality"):
        scored = QUERIES[name](spark, SF).join(docs, "doc_id").collect()
        by = {}
        for r in scored:
            key = hashlib.sha256((r["text"] or "").encode()).hexdigest()
            assert by.setdefault(key, r["score"]) == r["score"]
