"""Streams with a state: the upsert in many batches, and replays by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.plans.queries.merging import MERGED_SQL, SEQ, observations
from roomledger.plans.queries.registry import query, table
from roomledger.session import scratch
from roomledger.streaming import replays, state

FILES = 8


@query(
    "stream_many_batches",
    f"""SELECT item_id, CAST(day AS VARCHAR) AS day, value, props, note, CAST({FILES} AS BIGINT) AS batches,
               (SELECT count(*) FROM events) AS rows_read, true AS bounded
        FROM ({MERGED_SQL})""",
)
def stream_many_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of a file each, every one touching all days; no row of a batch is read by a later one.

    `bounded` says that no batch read more of the state than a row per key.
    """
    home, keys = scratch(spark, "state"), ["item_id", "day"]
    rows = observations(spark, folder).drop("event_type")
    rows.repartition(FILES, "seq_id").write.parquet(f"{home}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
    state.state_stream(stream, f"{home}/state", f"{home}/checkpoint", keys, SEQ, "day", arrival=False).awaitTermination()
    schema = state.state_schema(rows, keys, SEQ)
    silver = state.read_silver(spark, f"{home}/state", schema, keys, "day")
    log = state.commits(spark, f"{home}/state", schema["day"]).drop("day").distinct()
    sums = log.agg(F.count("version").alias("batches"), F.sum("batch_rows").alias("rows_read"), F.max("state_rows").alias("most"))
    found = sums.select("batches", "rows_read", (F.col("most") <= silver.agg(F.count(F.lit(1))).scalar()).alias("bounded")).first()
    return silver.select(
        "item_id", F.col("day").cast("string").alias("day"), "value", "props", "note",
        F.lit(found["batches"]).cast("bigint").alias("batches"), F.lit(found["rows_read"]).cast("bigint").alias("rows_read"),
        F.lit(found["bounded"]).alias("bounded"),
    )


DELAY_DAYS = 2


@query(
    "stream_watermark",
    """
    WITH m AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events)
    SELECT event_id, user_id, event_type, value, event_id % 10 = 0 AND ts < lo + (hi - lo) / 3 AS late
    FROM events, m
    """,
)
def stream_watermark(spark: SparkSession, folder: str) -> DataFrame:
    """Every event twice, and a tenth of the first third of the time only after all others.

    The batches are: the first third; the rest with replays of it; what was withheld, with replays of the
    rest. Rows that are withheld are behind the watermark then.
    """
    home = scratch(spark, "watermark")
    events = table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts")
    )
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    cut = F.lit(lo + (hi - lo) / 3)
    early, withheld = F.col("ts") < cut, F.col("event_id") % 10 == 0
    parts = [
        events.where(early & ~withheld),
        events.where(~early | ~withheld),
        events.where(~early | withheld),
    ]
    for part in parts:  # files are taken in the order of their times
        part.coalesce(1).write.mode("append").parquet(f"{home}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
    delay = f"{DELAY_DAYS} days"
    replays.split_stream(stream, home, "ts", delay).awaitTermination()
    replays.distinct_stream(spark, home, events.schema, ["event_id"], "ts", delay).awaitTermination()
    names = ["event_id", "user_id", "event_type", "value"]
    main = replays.main_rows(spark, home, events.schema).select(*names, F.lit(False).alias("late"))
    late = replays.late_rows(spark, home, events.schema, ["event_id"], "ts").select(*names, F.lit(True).alias("late"))
    return main.unionByName(late)
