"""The pipeline and the registered queries."""

import pathlib
import sys

import pytest
from pyspark.sql import functions as F

sys.path[:0] = [str(pathlib.Path(__file__).resolve().parents[1]), str(pathlib.Path(__file__).resolve().parents[2])]

import corpus_pipeline
from oracle import compare
from roomledger.llm import queries
from roomledger.llm.common import stored


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, sf, name):
    _, _, problem = compare(spark, queries.QUERIES[name], queries.SQL[name], sf)
    assert problem is None, problem


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    # The table of this size holds no secret, so two of its clean documents get one.
    planted = {4: "The access_token=9f86d081884c7d659a2feaa0c55ad015a3bf4f1b of this page.", 9: "password: s3cr3tPa55w0rd4711"}
    secret = F.create_map(*[F.lit(x) for item in planted.items() for x in item])[F.col("doc_id").cast("int")]
    docs = docs.withColumn("text", F.concat_ws("\n", "text", secret))
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf), f"test-{name}")
        frames.append(docs)
        if name != "best_fit_packing":
            assert docs.columns == columns
    ids = [{r["doc_id"] for r in f.select("doc_id").collect()} for f in frames]
    assert ids[0] > ids[1] and ids[1] == ids[2] == ids[3] == ids[4]
    texts = [{r["doc_id"]: r["text"] for r in f.select("doc_id", "text").collect()} for f in frames[:4]]
    assert any(texts[1][i] != texts[2][i] for i in texts[2]) and any("[SECRET]" in t for t in texts[3].values())
    assert not any(v in t for t in texts[3].values() for v in ("9f86d081884c7d65", "s3cr3tPa55w0rd4711"))
    tokens = sum(r["n_tokens"] for r in frames[4].collect())
    assert tokens == sum(len(t.split()) for t in texts[3].values())


def test_stages_on_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
