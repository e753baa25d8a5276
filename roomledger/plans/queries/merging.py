"""Keyed merge, counters, last-wins dedupe and the non-null overlay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.functions.text import overlay
from roomledger.operators import history, merge
from roomledger.plans.queries.registry import query, table

NOTE = "concat(event_type, ' seen with ', props)"
SEQ = ["seq_time", "seq_id"]


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Events as observations of an item (the user) on a day, in order of arrival."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("item_id"),
        F.to_date("ts").alias("day"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("seq_time"),
        F.col("event_id").alias("seq_id"),
        "event_type",
        "value",
        "props",
        F.expr(NOTE).alias("note"),
    )


OBSERVATIONS_SQL = f"""
    SELECT user_id AS item_id, CAST(ts AS DATE) AS day, event_type, value, props, {NOTE} AS note,
           row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
    FROM events
"""

MERGED_SQL = f"""
    SELECT item_id, day, arg_max(value, rn) AS value, arg_max(props, rn) AS props,
           arg_max(event_type, rn) AS event_type,
           coalesce(arg_max(note, length(note) * 1000000000 - rn) FILTER (length(note) >= 20),
                    arg_max(note, rn)) AS note,
           count(*) AS observations
    FROM ({OBSERVATIONS_SQL}) GROUP BY item_id, day
"""


def merged(spark: SparkSession, folder: str) -> DataFrame:
    """One row per item and day."""
    rows = observations(spark, folder)
    return merge.merge_rows(
        rows, ["item_id", "day"], SEQ, extra=[F.count(F.lit(1)).alias("observations")]
    )


@query(
    "observation_upsert",
    f"""SELECT item_id, CAST(day AS VARCHAR) AS day, value, props, note, observations
        FROM ({MERGED_SQL})""",
)
def observation_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return merged(spark, folder).select(
        "item_id", F.col("day").cast("string").alias("day"), "value", "props", "note",
        "observations",
    )


STORE_BATCH_SQL = f"""
    WITH o AS (SELECT *, CASE WHEN event_type IN ('view', 'click', 'error') THEN 0 ELSE 1 END AS late
               FROM ({OBSERVATIONS_SQL})),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id, day ORDER BY late, rn) AS n FROM o)
    SELECT item_id, CAST(day AS VARCHAR) AS day, arg_max(value, n) AS value,
           arg_max(event_type, n) AS event_type,
           coalesce(arg_max(note, length(note) * 1000000000 - n) FILTER (length(note) >= 20),
                    arg_max(note, n)) AS note
    FROM r GROUP BY item_id, day
"""


@query("store_batch_upsert", STORE_BATCH_SQL)
def store_batch_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """A batch merged into a store: stored rows come first, whatever their time."""
    rows = observations(spark, folder).drop("props")
    early = F.col("event_type").isin("view", "click", "error")
    result = merge.upsert(rows.where(early), rows.where(~early), ["item_id", "day"], SEQ)
    return result.select(
        "item_id", F.col("day").cast("string").alias("day"), "value", "event_type", "note"
    )


@query(
    "richest_text",
    """
    WITH c AS (SELECT conv_id, role, turn, text,
                      length(trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')) AS n
               FROM conversations)
    SELECT conv_id, role,
           coalesce(arg_max(text, n * 1000000 - turn) FILTER (n >= 20),
                    arg_max(text, turn) FILTER (n > 0 AND trim(text) NOT IN ('None', 'null', '[]', '{}')),
                    arg_min(text, turn)) AS text
    FROM c GROUP BY conv_id, role
    """,
)
def richest_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "role", "turn", "text")
    return merge.merge_rows(rows, ["conv_id", "role"], ["turn"])


@query(
    "latest_text_policy",
    """SELECT conv_id, role, arg_max(text, turn) FILTER (trim(text) <> '') AS text
       FROM conversations GROUP BY conv_id, role""",
)
def latest_text_policy(spark: SparkSession, folder: str) -> DataFrame:
    """The same merge with the "latest non-empty wins" policy for the text."""
    rows = table(spark, folder, "conversations").select("conv_id", "role", "turn", "text")
    return merge.merge_rows(rows, ["conv_id", "role"], ["turn"], {"text": merge.LATEST})


def _store_and_batch(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = observations(spark, folder)
    early = F.col("event_type").isin("view", "click", "error")
    return rows.where(early), rows.where(~early)


@query(
    "upsert_counters",
    """
    WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day,
                      event_type IN ('view', 'click', 'error') AS stored FROM events),
    k AS (SELECT user_id, day, bool_or(stored) AS old, count_if(NOT stored) AS arrived
          FROM e GROUP BY user_id, day)
    SELECT CAST(count_if(NOT old) AS BIGINT) AS inserted,
           CAST(sum(arrived) - count_if(NOT old) AS BIGINT) AS updated,
           count(*) AS total
    FROM k
    """,
)
def upsert_counters(spark: SparkSession, folder: str) -> DataFrame:
    store, batch = _store_and_batch(spark, folder)
    return merge.upsert_counters(store, batch, ["item_id", "day"])


@query(
    "inserted_keys",
    """
    SELECT DISTINCT user_id AS item_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day
    FROM events WHERE event_type NOT IN ('view', 'click', 'error')
      AND (user_id, CAST(ts AS DATE)) NOT IN
          (SELECT (user_id, CAST(ts AS DATE)) FROM events
           WHERE event_type IN ('view', 'click', 'error'))
    """,
)
def inserted_keys(spark: SparkSession, folder: str) -> DataFrame:
    store, batch = _store_and_batch(spark, folder)
    new = merge.inserted_keys(store, batch, ["item_id", "day"])
    return new.select("item_id", F.col("day").cast("string").alias("day"))


@query(
    "last_wins_dedupe",
    f"""SELECT item_id, CAST(day AS VARCHAR) AS day, arg_max(event_type, rn) AS event_type,
               arg_max(value, rn) AS value, arg_max(props, rn) AS props
        FROM ({OBSERVATIONS_SQL}) GROUP BY item_id, day""",
)
def last_wins_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    rows = merge.last_wins(observations(spark, folder), ["item_id", "day"], SEQ)
    return rows.select(
        "item_id", F.col("day").cast("string").alias("day"), "event_type", "value", "props"
    )


@query(
    "enrich_left",
    """
    WITH exact AS (
        SELECT o_custkey, o_orderkey, o_orderpriority,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice
        FROM orders QUALIFY row_number() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT c_custkey, o_orderkey, coalesce(o_orderpriority, c_mktsegment) AS label,
           CASE WHEN o_orderkey IS NULL THEN c_acctbal ELSE o_totalprice END AS amount,
           o_orderkey IS NOT NULL AS enriched
    FROM customer LEFT JOIN exact ON c_custkey = o_custkey
    """,
)
def enrich_left(spark: SparkSession, folder: str) -> DataFrame:
    """Summary rows and their newest detail: one field prefers values, one is overwritten."""
    orders = table(spark, folder, "orders").select(
        "o_custkey",
        "o_orderkey",
        "o_orderdate",
        "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice"),
    )
    newest = history.latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    cards = table(spark, folder, "customer")
    joined = cards.join(newest, F.col("c_custkey") == F.col("o_custkey"), "left")
    found = F.col("o_custkey").isNotNull()
    return joined.select(
        "c_custkey",
        "o_orderkey",
        F.coalesce("o_orderpriority", "c_mktsegment").alias("label"),
        F.when(found, F.col("o_totalprice")).otherwise(F.col("c_acctbal")).alias("amount"),
        found.alias("enriched"),
    )


@query(
    "struct_overlay",
    """SELECT d.doc_id, coalesce(CAST(l.quality AS BIGINT), length(d.lang)) AS quality,
              coalesce(CAST(l.toxic AS BIGINT), 0) AS toxic, d.source
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def struct_overlay(spark: SparkSession, folder: str) -> DataFrame:
    """Defaults with the non-null fields of a sparse record over them, tagged with the source."""
    fields = ["quality", "toxic"]
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("l_id"),
        F.struct(*[F.col(f).cast("bigint").alias(f) for f in fields]).alias("new"),
    )
    documents = table(spark, folder, "documents").select(
        "doc_id",
        "source",
        F.struct(
            F.length("lang").cast("bigint").alias("quality"), F.lit(0).cast("bigint").alias("toxic")
        ).alias("old"),
    )
    joined = documents.join(labels, F.col("doc_id") == F.col("l_id"), "left")
    return joined.withColumn("r", overlay(F.col("old"), F.col("new"), fields)).select(
        "doc_id", "r.quality", "r.toxic", "source"
    )
