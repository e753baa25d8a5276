"""The store as files: flat rows in JSON lines, and the same rows as CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.operators import merge
from roomledger.schema import FLAT
from roomledger.sources import csvfile, jsonl


def upsert_files(
    spark: SparkSession,
    batch: DataFrame,
    seq: Sequence[str],
    source: str | None,
    target: str,
    csv: str | None = None,
    keys: tuple[str, ...] = ("hotel_id", "scrape_date"),
    schema: T.StructType = FLAT,
) -> DataFrame:
    """Merge a batch of flat rows into the store at ``source``, written to ``target``.

    The old store stays as it is, so a failed run is repeated from it; without
    a source the store starts empty. Returns the counters of the upsert.
    """
    text_keys = [f.name for f in schema if f.name in keys and f.dataType == T.StringType()]
    batch = batch.withColumns({k: F.coalesce(k, F.lit("")) for k in text_keys})
    if source is None:
        store = batch.select(*schema.names).limit(0)
    else:
        store = jsonl.read_store(spark, source, keys, schema)
    earlier = store.withColumns({s: F.lit(0).cast("bigint") for s in seq})
    counters = Observation()
    merged = merge.counted_upsert(earlier, batch.select(*schema.names, *seq), list(keys), list(seq), counters)
    jsonl.write_jsonl(merged.select(*schema.names), target)
    if csv is not None:
        written = jsonl.read_jsonl(spark, target, schema)
        csvfile.write_csv(written, csv, schema.names)
    return merge.observed_counters(spark, counters)


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key: its digest over the buckets; null and empty parts are equal."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return (F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, 4), 16, 10).cast("int") % buckets).alias("bucket")


def _manifest(spark: SparkSession, store: str) -> DataFrame:
    """(version, bucket): which versions hold which buckets."""
    try:
        return spark.read.schema("version bigint, bucket int").parquet(f"{store}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "version bigint, bucket int")


def read_buckets(
    spark: SparkSession,
    store: str,
    keys: tuple[str, ...] = ("hotel_id", "scrape_date"),
    schema: T.StructType = FLAT,
    only: Sequence[int] | None = None,
) -> DataFrame:
    """The rows of a bucketed store, each bucket in its last committed version; all buckets or some."""
    known = _manifest(spark, store)
    if only is not None:
        known = known.where(F.col("bucket").isin(list(only)))
    last = known.groupBy("bucket").agg(F.max("version").alias("version")).collect()
    paths = [f"{store}/data/version={r['version']}/bucket={r['bucket']}" for r in last]
    if not paths:
        return spark.createDataFrame([], schema)
    return jsonl.read_store(spark, paths, keys, schema)


def upsert_buckets(
    spark: SparkSession,
    batch: DataFrame,
    seq: Sequence[str],
    store: str,
    keys: tuple[str, ...] = ("hotel_id", "scrape_date"),
    schema: T.StructType = FLAT,
    buckets: int = 64,
) -> DataFrame:
    """Merge a batch into a store of line files by bucket of the key; only touched buckets are rewritten.

    They are written as a new version, which counts once the manifest names it, in one
    file of one write; until then, and after a failure, readers have the version before.
    One upsert runs at a time. Returns (inserted, updated, total, rewritten, buckets):
    `total` is the number of rows in the rewritten buckets.
    """
    text_keys = [f.name for f in schema if f.name in keys and f.dataType == T.StringType()]
    batch = batch.withColumns({k: F.coalesce(k, F.lit("")) for k in text_keys})
    # The batch is computed once and kept until the next one.
    batch.select(*schema.names, *seq, _bucket(keys, buckets)).write.mode("overwrite").parquet(f"{store}/incoming")
    batch = spark.read.parquet(f"{store}/incoming")
    touched = sorted(r["bucket"] for r in batch.select("bucket").distinct().collect())
    version = (_manifest(spark, store).agg(F.max("version")).first()[0] or 0) + 1
    counters = Observation()
    earlier = read_buckets(spark, store, keys, schema, touched).withColumns({s: F.lit(0).cast("bigint") for s in seq})
    merged = merge.counted_upsert(earlier, batch.drop("bucket"), list(keys), list(seq), counters)
    (
        merged.select(*schema.names, _bucket(keys, buckets)).hint("rebalance", "bucket")
        .write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("bucket").json(f"{store}/data/version={version}")
    )
    done = spark.createDataFrame([(version, b) for b in touched], "version bigint, bucket int")
    done.coalesce(1).write.mode("append").parquet(f"{store}/manifest")
    return merge.observed_counters(spark, counters).withColumns(
        {"rewritten": F.lit(len(touched)).cast("bigint"), "buckets": F.lit(buckets).cast("bigint")}
    )
