"""Registered queries against their SQL, and the pipeline against its stages in plain Python."""

import os

import pytest
from oracle_check import oracle_connection, run

import corpus_pipeline
from pulsegrid.llm import queries

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="test tables are missing")


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query(spark, name):
    assert run(spark, oracle_connection(DIR), name, queries.QUERIES[name], queries.ORACLES.get(name), DIR) == ""


def test_pipeline(spark):
    """Counts after every stage by SQL and plain Python; the mix and the tokens by their own operators."""
    con = oracle_connection(DIR)
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.ORACLES['op3_quality_divergence']}) WHERE kept").fetchall()}
    texts = dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
    last = {}
    for i in sorted(kept):
        last[texts[i].lower().encode("ascii", "replace") if texts[i].isascii() else texts[i]] = i
    exact = set(last.values())
    sets = {}
    for i in exact:
        ws = texts[i].lower().split()
        sets[i] = {tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))}
    gone = set()
    for a in sorted(exact):
        for b in sorted(exact):
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                gone.add(b)
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES[:3], (kept, exact, exact - gone)):
        docs = stage(spark, docs, DIR).cache()
        assert sorted(r[0] for r in docs.select("doc_id").collect()) == sorted(want), name
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, DIR)
    result = corpus_pipeline.run(spark, DIR)
    assert sorted(r[0] for r in result.select("doc_id").collect()) == sorted(r[0] for r in mixed.select("doc_id").collect())
    assert result.where("n_tokens = 0").count() == 0
