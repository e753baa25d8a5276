"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.llm import (
    bpe, licenses, lm, packing, quality, repeats, resample, secrets, simhash, topk, toxicity, webtext,
    whitening,
)
from roomledger.llm.common import stored
from roomledger.llm.sql import SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = stored(simhash.with_fingerprint(docs).select("doc_id", "fp"), "simhash-rows")
    return simhash.grouped(rows).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(table(spark, folder, "documents"))


@query
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scanned(table(spark, folder, "documents"))


@query
def op7_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantised(table(spark, folder, "embeddings"))
    return topk.search(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return webtext.extracted(table(spark, folder, "pages"))


@query
def op2_bpe_coding(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.coded(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


@query
def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scored(table(spark, folder, "documents"))


@query
def op10_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return repeats.removed(docs).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.drawn(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    white = whitening.whitened(table(spark, folder, "embeddings"))
    return white.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


@query
def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    judged = toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", "held_out", "score", "predicted")
