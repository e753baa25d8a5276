"""Round trips through files and layered tables, batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.operators import gold, merge
from roomledger.plans.filestore import read_buckets, upsert_buckets, upsert_files
from roomledger.plans.queries.merging import MERGED_SQL, NOTE, SEQ, STORE_BATCH_SQL, observations
from roomledger.plans.queries.registry import query, table
from roomledger.schema import BIGINT, DATE, DOUBLE, STRING, TIMESTAMP_NTZ, struct
from roomledger.session import PAGES, dealt, scratch
from roomledger.sources import csvfile, guarded, jsonl, layers
from roomledger.sources.pages import read_html_files, read_pages
from roomledger.streaming.upsert import upsert_stream

ORDER = struct(
    o_orderkey=BIGINT, o_custkey=BIGINT, o_orderstatus=STRING, o_totalprice=DOUBLE,
    o_orderdate=STRING, o_orderpriority=STRING,
)
ORDER_SQL = """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
    FROM orders
"""


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with text dates and a column with nulls."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        F.to_date("o_orderdate").cast("string").alias("o_orderdate"),
        "o_orderpriority",
    )


@query("jsonl_roundtrip", ORDER_SQL)
def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "jsonl")
    jsonl.write_jsonl(_orders(spark, folder), path)
    return jsonl.read_store(spark, path, ("o_orderkey", "o_orderdate"), ORDER)


def _mixed_lines(spark: SparkSession, folder: str) -> str:
    """Line file with blank, broken and non-object lines among the orders."""
    path = scratch(spark, "lines")
    line = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    priority = F.col("o_orderpriority")
    value = (
        F.when(priority == "1-URGENT", F.substring(line, 1, 30))
        .when(priority == "2-HIGH", F.concat(F.lit("["), line, F.lit("]")))
        .when(priority == "3-MEDIUM", F.lit("   "))
        .otherwise(F.concat(F.lit("  "), line))
    )
    _orders(spark, folder).select(value.alias("value")).write.text(path)
    return path


@query(
    "jsonl_scan",
    f"SELECT * FROM ({ORDER_SQL}) WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
)
def jsonl_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Only the lines that hold an object."""
    path = _mixed_lines(spark, folder)
    return jsonl.read_jsonl(spark, path, ORDER).select(*ORDER.names)


@query(
    "jsonl_line_counts",
    """SELECT CAST(count_if(o_orderpriority <> '3-MEDIUM') AS BIGINT) AS lines,
              CAST(count_if(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS BIGINT) AS rejected
       FROM orders""",
)
def jsonl_line_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Non-blank lines and the rejected ones among them."""
    path = _mixed_lines(spark, folder)
    rejected = jsonl.rejected_lines(spark, path, ORDER).agg(F.count(F.lit(1)).alias("rejected"))
    return jsonl.count_lines(spark, path).withColumn("rejected", rejected.scalar())


@query(
    "csv_roundtrip",
    """SELECT doc_id, CASE WHEN lang = 'en' THEN NULL ELSE lang END AS lang, md5(text) AS digest
       FROM documents""",
)
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with quotes and line breaks through the CSV sink."""
    path = scratch(spark, "csv")
    rows = table(spark, folder, "documents").withColumn(
        "lang", F.when(F.col("lang") != "en", F.col("lang"))
    )
    csvfile.write_csv(rows, path, ["doc_id", "lang", "text"])
    back = csvfile.read_csv(spark, path, struct(doc_id=BIGINT, lang=STRING, text=STRING))
    return back.select("doc_id", "lang", F.md5("text").alias("digest"))


@query("csv_rebuild", f"SELECT *, count(*) OVER () AS rebuilt FROM ({ORDER_SQL})")
def csv_rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """The CSV written anew from the line file, and the number of rows."""
    source, target = scratch(spark, "jsonl"), scratch(spark, "csv")
    jsonl.write_jsonl(_orders(spark, folder), source)
    count = csvfile.rebuild_csv(
        spark, source, target, ("o_orderkey", "o_orderdate"), ORDER, ORDER.names
    )
    return csvfile.read_csv(spark, target, ORDER).withColumn("rebuilt", F.lit(count).cast("bigint"))


@query("snapshot_lines", "SELECT count(*) AS lines FROM orders")
def snapshot_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A published snapshot replaces the one before."""
    source, target = scratch(spark, "jsonl"), scratch(spark, "snapshot")
    jsonl.write_jsonl(_orders(spark, folder), source)
    layers.publish_snapshot(spark, source, target)
    layers.publish_snapshot(spark, source, target)
    return jsonl.count_lines(spark, target)


def _observed(spark: SparkSession, folder: str) -> DataFrame:
    return observations(spark, folder).drop("event_type")


SILVER = struct(item_id=BIGINT, value=DOUBLE, props=STRING, note=STRING, day=DATE)


@query(
    "medallion",
    f"""SELECT CAST(day AS VARCHAR) AS day, count(*) AS listings,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(value) AS avg_price,
               min(CAST(round(value * 100) AS BIGINT)) AS min_price,
               max(CAST(round(value * 100) AS BIGINT)) AS max_price
        FROM ({MERGED_SQL}) GROUP BY day""",
)
def medallion(spark: SparkSession, folder: str) -> DataFrame:
    """Two bronze batches, silver refreshed after each, gold on top."""
    home = scratch(spark, "layers")
    rows = _observed(spark, folder)
    schema = rows.schema
    stored = T.StructType([*[f for f in schema if f.name != "day"], schema["day"]])
    late = F.col("note").startswith("view")
    for batch in (rows.where(~late), rows.where(late)):
        layers.append_bronze(batch, f"{home}/bronze", "day")
        bronze = layers.read_layer(spark, f"{home}/bronze", stored)
        layers.refresh_silver(
            bronze, batch, f"{home}/silver", ["item_id", "day"], SEQ, "day"
        )
    layers.register(spark, {"silver_observations": (f"{home}/silver", SILVER)})
    silver = spark.table("silver_observations").select(
        F.col("day").cast("string").alias("day"),
        F.expr("CAST(round(value * 100) AS BIGINT)").alias("cents"),
    )
    summary = gold.daily_summary(silver, ["day"], F.col("cents"), F.col("cents"))
    return summary.select("day", "listings", "avg_price", "min_price", "max_price")


EVENT = struct(
    event_id=BIGINT, ts=TIMESTAMP_NTZ, user_id=BIGINT, event_type=STRING, value=DOUBLE, props=STRING
)


@query(
    "stream_upsert",
    f"""SELECT item_id, CAST(day AS VARCHAR) AS day, value, props, note FROM ({MERGED_SQL})""",
)
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The observation upsert as a stream over the event files."""
    home = scratch(spark, "stream")
    stream = (
        spark.readStream.schema(EVENT)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
    ).select(
        F.col("user_id").alias("item_id"),
        F.to_date("ts").alias("day"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("seq_time"),
        F.col("event_id").alias("seq_id"),
        "value",
        "props",
        F.expr(NOTE).alias("note"),
    )
    running = upsert_stream(
        stream, f"{home}/bronze", f"{home}/silver", f"{home}/checkpoint", ["item_id", "day"], SEQ, "day"
    )
    running.awaitTermination()
    silver = layers.read_layer(spark, f"{home}/silver", SILVER)
    return silver.select(
        "item_id", F.col("day").cast("string").alias("day"), "value", "props", "note"
    )


@query(
    "stream_replays",
    "SELECT event_id, user_id, event_type, value FROM events",
)
def stream_replays(spark: SparkSession, folder: str) -> DataFrame:
    """Every event delivered twice, the copies in other batches; the upsert keeps each once."""
    home = scratch(spark, "replay")
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    for _ in range(2):
        events.repartition(2, "event_id").write.mode("append").parquet(f"{home}/in")
    schema = T.StructType([*EVENT.fields, T.StructField("day", DATE)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
    running = upsert_stream(
        stream, f"{home}/bronze", f"{home}/silver", f"{home}/checkpoint", ["event_id", "day"], [], "day"
    )
    running.awaitTermination()
    silver = T.StructType([f for f in schema if f.name != "day"])
    return spark.read.schema(silver).parquet(f"{home}/silver").select(
        "event_id", "user_id", "event_type", "value"
    )


@query(
    "batch_split_merge",
    f"""SELECT item_id, CAST(day AS VARCHAR) AS day, value, props, note FROM ({MERGED_SQL})""",
)
def batch_split_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Merging parts first and then the parts gives the merge of all rows.

    A merged part keeps the arrival order of every value it took, so parts are
    stored as bronze rows; here the stored part is written and read back.
    """
    home = scratch(spark, "parts")
    rows = _observed(spark, folder)
    for number, kind in enumerate(["view", "click", "error", "signup", "purchase"]):
        layers.put_batch(rows.where(F.col("note").startswith(kind)), home, number, "day")
    layers.put_batch(rows.where(F.col("note").startswith("click")), home, 1, "day")
    history = layers.read_layer(spark, home, layers.bronze_schema(rows.schema, "day"))
    history = history.drop(*layers.ARRIVAL)
    merged = merge.merge_rows(history, ["item_id", "day"], SEQ)
    return merged.select(
        "item_id", F.col("day").cast("string").alias("day"), "value", "props", "note"
    )


STORED = struct(item_id=BIGINT, day=STRING, value=DOUBLE, event_type=STRING, note=STRING)


@query("file_store_upsert", STORE_BATCH_SQL)
def file_store_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Two upserts into the store of line files, the result read back from its CSV."""
    home = scratch(spark, "filestore")
    rows = observations(spark, folder).withColumn("day", F.col("day").cast("string"))
    early = F.col("event_type").isin("view", "click", "error")
    keys = ("item_id", "day")
    upsert_files(spark, rows.where(early), SEQ, None, f"{home}/one", None, keys, STORED)
    upsert_files(
        spark, rows.where(~early), SEQ, f"{home}/one", f"{home}/two", f"{home}/csv", keys, STORED
    )
    return csvfile.read_csv(spark, f"{home}/csv", STORED)


BUCKETS = 32


@query(
    "bucketed_store_upsert",
    f"""
    WITH l AS (SELECT * FROM events WHERE event_type NOT IN ('view', 'click', 'error')),
    b AS (SELECT DISTINCT CAST('0x' || substr(md5(concat_ws(chr(31), user_id, CAST(ts AS DATE))), 1, 4) AS BIGINT) % {BUCKETS} AS bucket
          FROM l WHERE user_id = (SELECT min(user_id) FROM l))
    SELECT *, (SELECT count(*) FROM b) AS rewritten, CAST({BUCKETS} AS BIGINT) AS buckets FROM ({STORE_BATCH_SQL})
    """,
)
def bucketed_store_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Two upserts into a bucketed store, and late rows of one item again, which rewrite the buckets of its days only."""
    store, keys = scratch(spark, "bucketed"), ("item_id", "day")
    rows = observations(spark, folder).withColumn("day", F.col("day").cast("string"))
    early = F.col("event_type").isin("view", "click", "error")
    upsert_buckets(spark, rows.where(early), SEQ, store, keys, STORED, BUCKETS)
    upsert_buckets(spark, rows.where(~early), SEQ, store, keys, STORED, BUCKETS)
    item = rows.where(~early).agg(F.min("item_id")).first()[0]
    counters = upsert_buckets(spark, rows.where(~early & (F.col("item_id") == item)), SEQ, store, keys, STORED, BUCKETS).first()
    return read_buckets(spark, store, keys, STORED).withColumns(
        {n: F.lit(counters[n]).cast("bigint") for n in ("rewritten", "buckets")}
    )


@query(
    "file_store_counters",
    """
    WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day,
                      event_type IN ('view', 'click', 'error') AS stored FROM events),
    k AS (SELECT user_id, day, bool_or(stored) AS old, count_if(NOT stored) AS arrived
          FROM e GROUP BY user_id, day)
    SELECT CAST(count_if(NOT old) AS BIGINT) AS inserted,
           CAST(sum(arrived) - count_if(NOT old) AS BIGINT) AS updated, count(*) AS total
    FROM k
    """,
)
def file_store_counters(spark: SparkSession, folder: str) -> DataFrame:
    """What the second upsert of the file store reports."""
    home = scratch(spark, "filestore")
    rows = observations(spark, folder).withColumn("day", F.col("day").cast("string"))
    early = F.col("event_type").isin("view", "click", "error")
    keys = ("item_id", "day")
    upsert_files(spark, rows.where(early), SEQ, None, f"{home}/one", None, keys, STORED)
    return upsert_files(
        spark, rows.where(~early), SEQ, f"{home}/one", f"{home}/two", None, keys, STORED
    )


UNTYPED = struct(o_orderkey=BIGINT, o_custkey=BIGINT, o_totalprice=DOUBLE, o_orderdate=STRING)


@query(
    "jsonl_untyped_values",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) THEN o_custkey END AS o_custkey,
              CASE o_orderkey % 3 WHEN 0 THEN o_totalprice WHEN 1 THEN o_totalprice END AS o_totalprice,
              CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, CAST(0 AS BIGINT) AS rejected
       FROM orders""",
)
def jsonl_untyped_values(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers written as 7.0, numbers as texts, empty texts, nulls and absent keys: no line is lost."""
    path = scratch(spark, "untyped")
    key = F.col("o_orderkey")
    cust = (
        F.when(key % 4 == 0, F.concat(F.lit(', "o_custkey": '), F.col("o_custkey").cast("string"), F.lit(".0")))
        .when(key % 4 == 1, F.concat(F.lit(', "o_custkey": "'), F.col("o_custkey").cast("string"), F.lit('"')))
        .when(key % 4 == 2, F.lit(', "o_custkey": ""'))
        .otherwise(F.lit(""))
    )
    price = F.col("o_totalprice").cast("string")
    amount = (
        F.when(key % 3 == 0, F.concat(F.lit(', "o_totalprice": '), price))
        .when(key % 3 == 1, F.concat(F.lit(', "o_totalprice": "'), price, F.lit('"')))
        .otherwise(F.lit(', "o_totalprice": null'))
    )
    line = F.concat(
        F.lit('{"o_orderkey": '), key.cast("string"), cust, amount, F.lit(', "o_orderdate": "'),
        F.to_date("o_orderdate").cast("string"), F.lit('"}'),
    )
    table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    rejected = jsonl.rejected_lines(spark, path, UNTYPED).agg(F.count(F.lit(1)).alias("rejected"))
    rows = jsonl.read_store(spark, path, ("o_orderkey", "o_orderdate"), UNTYPED)
    return rows.withColumn("rejected", rejected.scalar())


@query(
    "union_with_broken_source",
    """
    SELECT event_type AS source, event_id, user_id, value, CAST(NULL AS VARCHAR) AS reason FROM events
    WHERE event_type NOT IN ('click', 'error')
    UNION ALL SELECT DISTINCT event_type, NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE,
           CASE event_type WHEN 'click' THEN 'FAILED_READ_FILE' ELSE 'MALFORMED_RECORD_IN_PARSING' END
    FROM events WHERE event_type IN ('click', 'error')
    """,
)
def union_with_broken_source(spark: SparkSession, folder: str) -> DataFrame:
    """A source for each kind of event, as Parquet or as JSON; one file is no Parquet, one has a line cut short."""
    home = scratch(spark, "sources")
    schema = struct(event_id=BIGINT, user_id=BIGINT, value=DOUBLE)
    parquet, lines = guarded.parquet_reader(schema), guarded.json_reader(schema)
    events = table(spark, folder, "events")
    sources = []
    for kind in sorted(r[0] for r in events.select("event_type").distinct().collect()):
        rows = events.where(F.col("event_type") == kind).select(*schema.names)
        text = F.to_json(F.struct(*schema.names), {"ignoreNullFields": "false"})
        path = f"{home}/{kind}"
        if kind in ("click", "view"):
            rows.write.parquet(path)
        elif kind == "error":
            rows.select(F.when(F.col("event_id") % 3 == 0, F.substring(text, 1, 12)).otherwise(text).alias("value")).write.text(path)
        else:
            rows.select(text.alias("value")).write.text(path)
        if kind == "click":  # beside its good files
            rows.limit(1).select(F.concat(F.lit("PAR1"), text).alias("value")).write.mode("append").text(path)
        sources.append((path, parquet if kind in ("click", "view") else lines))
    kept, broken = guarded.union_guarded(spark, sources, f"{home}/staging")
    name = F.element_at(F.split("source", "/"), -1).alias("source")
    none = F.lit(None)
    return kept.select(name, "event_id", "user_id", "value", none.cast("string").alias("reason")).unionByName(
        broken.select(name, none.cast("bigint").alias("event_id"), none.cast("bigint").alias("user_id"), none.cast("double").alias("value"), "reason")
    )


def _nested_lines(spark: SparkSession, folder: str) -> str:
    """A nested object per order: keys left out, nulls, blank texts, numbers as texts, and lines that are no object."""
    path = scratch(spark, "nested")
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    state = (
        F.when(key % 4 == 0, F.lit(""))
        .when(key % 4 == 1, F.lit('"status": null, '))
        .when(key % 4 == 2, F.lit('"status": "  ", '))
        .otherwise(F.concat(F.lit('"status": "'), F.col("o_orderstatus"), F.lit('", ')))
    )
    amount = F.when(key % 3 == 0, price).when(key % 3 == 1, F.concat(F.lit('"'), price, F.lit('"'))).otherwise(F.lit('"on request"'))
    line = F.concat(
        F.lit('{"id": '), key.cast("string"), F.lit(', '), state, F.lit('"pricing": {"total": '), amount,
        F.lit('}, "tags": ["'), F.col("o_orderpriority"), F.lit('", "x"]}'),
    )
    table(spark, folder, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("["), line, F.lit("]")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit('{"id": ')).otherwise(line).alias("value")
    ).write.text(path)
    return path


_OBJECTS = "orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"
NESTED = {"id": BIGINT, "status": STRING, "pricing.total": DOUBLE, "tags": T.ArrayType(STRING), "note": STRING}


@query(
    "jsonl_key_states",
    f"""
    SELECT 'id' AS path, CAST(0 AS BIGINT) AS absent, CAST(0 AS BIGINT) AS nulls, CAST(0 AS BIGINT) AS empty,
           count(*) AS given, CAST(0 AS BIGINT) AS unfit FROM {_OBJECTS}
    UNION ALL SELECT 'status', CAST(count_if(o_orderkey % 4 = 0) AS BIGINT), CAST(count_if(o_orderkey % 4 = 1) AS BIGINT),
           CAST(count_if(o_orderkey % 4 = 2) AS BIGINT), CAST(count_if(o_orderkey % 4 = 3) AS BIGINT), 0 FROM {_OBJECTS}
    UNION ALL SELECT 'pricing.total', 0, 0, 0, count(*), CAST(count_if(o_orderkey % 3 = 2) AS BIGINT) FROM {_OBJECTS}
    UNION ALL SELECT 'tags', 0, 0, 0, count(*), 0 FROM {_OBJECTS}
    UNION ALL SELECT 'note', count(*), 0, 0, 0, 0 FROM {_OBJECTS}
    """,
)
def jsonl_key_states(spark: SparkSession, folder: str) -> DataFrame:
    """Absent keys, explicit nulls, blank texts and values that do not fit, counted apart per path."""
    return jsonl.key_states(jsonl.read_variants(spark, _nested_lines(spark, folder)), NESTED)


@query(
    "jsonl_nested_records",
    f"""SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 2 THEN '  ' WHEN 3 THEN o_orderstatus END AS status,
               CASE WHEN o_orderkey % 3 < 2 THEN o_totalprice END AS total, o_orderpriority || ',x' AS tags,
               o_orderkey % 4 = 1 AS cleared
        FROM {_OBJECTS}""",
)
def jsonl_nested_records(spark: SparkSession, folder: str) -> DataFrame:
    """Typed values at any depth from one parse of a line; `cleared` tells a null that was written."""
    lines = jsonl.read_variants(spark, _nested_lines(spark, folder))
    at = lambda path: jsonl.value_at(F.col("record"), path, NESTED[path])
    return lines.select(
        at("id").alias("id"), at("status").alias("status"), at("pricing.total").alias("total"),
        F.array_join(at("tags"), ",").alias("tags"), (jsonl.key_state(F.col("record"), "status") == "null").alias("cleared"),
    )


@query("html_file_pages", "SELECT page_id, md5(html) AS digest, CAST(length(html) AS BIGINT) AS n_chars FROM pages")
def html_file_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every page through a file of its own in a tree of folders."""
    path = scratch(spark, "html")
    pages = dealt(table(spark, folder, "pages"), PAGES).select("page_id", "html")
    pages.write.partitionBy("page_id").option("lineSep", "\n").text(path)
    html = F.substring("html", F.lit(1), F.length("html") - 1)  # without the line end of the writer
    return read_html_files(spark, path, "*.txt").select(
        F.regexp_extract("url", r"page_id=(-?\d+)/", 1).cast("bigint").alias("page_id"),
        F.md5(html).alias("digest"), F.length(html).cast("bigint").alias("n_chars"),
    )


@query(
    "stored_pages",
    """SELECT page_id, url, md5(html) AS digest, CAST(page_id % 25 AS BIGINT) AS page, '2024-05-01' AS scrape_date
       FROM pages""",
)
def stored_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages kept as Parquet, read in the declared schema."""
    path = scratch(spark, "pages")
    table(spark, folder, "pages").select(
        "page_id", "url", "html", F.lit("search").alias("page_kind"),
        F.lit(None).cast("string").alias("city"), (F.col("page_id") % 25).cast("int").alias("page"),
        F.lit(None).cast("string").alias("fetched_at"), F.lit("2024-05-01").cast("date").alias("scrape_date"),
    ).write.parquet(path)
    return read_pages(spark, path).where("page_kind = 'search'").select(
        "page_id", "url", F.md5("html").alias("digest"), F.col("page").cast("bigint").alias("page"),
        F.col("scrape_date").cast("string").alias("scrape_date"),
    )
