"""The corpus pipeline: documents through five stages, each stored before the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roomledger.llm import neardups, packing, quality, repeats, secrets
from roomledger.llm.common import stored

#: SQL can not express the merged transforms, the forest and the packing; tests compare the stages with
#: plain versions instead.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the smallest id: groups by SimHash fingerprints first,
    then of what is left those of 0.8 or more on five-word shingles, most of which fingerprints do not link."""
    return neardups.kept(docs, fingerprints=True)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat in what is left are cut out of the texts."""
    return repeats.without_repeats(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts."""
    return secrets.masked(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the texts by bins: (bin_id, position, doc_id, piece, start, n_tokens, offset)."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
