"""Days whose schema changes: the drift report and the table over all of them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.plans.queries.registry import query, table
from roomledger.session import scratch
from roomledger.sources import drift

#: The days of the month on which the columns change.
WIDER, TEXT = 11, 21


def _days(spark: SparkSession, folder: str) -> str:
    """The events by day: user numbers of 32 bits, then of 64 bits with `props`, then as texts without `value`."""
    path = scratch(spark, "drifting")
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    date = F.dayofmonth("day")
    user = F.col("user_id")
    eras = [
        events.where(date < WIDER).select("event_id", user.cast("int").alias("user_id"), "value", "day"),
        events.where((date >= WIDER) & (date < TEXT)).select("event_id", "user_id", "value", "props", "day"),
        events.where(date >= TEXT).select("event_id", F.concat(F.lit("u"), user).alias("user_id"), "props", "day"),
    ]
    for era in eras:
        era.write.mode("append").partitionBy("day").parquet(path)
    return path


_ERA = f"CASE WHEN dayofmonth(day) < {WIDER} THEN 0 WHEN dayofmonth(day) < {TEXT} THEN 1 ELSE 2 END"


@query(
    "schema_drift",
    f"""
    WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
    e AS (SELECT day, {_ERA} AS era FROM d),
    s AS (SELECT day, era, unnest([
              {{'field': 'event_id', 'kind': 'bigint'}},
              {{'field': 'user_id', 'kind': CASE era WHEN 0 THEN 'int' WHEN 1 THEN 'bigint' ELSE 'string' END}},
              {{'field': 'value', 'kind': CASE WHEN era < 2 THEN 'double' END}},
              {{'field': 'props', 'kind': CASE WHEN era > 0 THEN 'string' END}}]) AS c FROM e),
    k AS (SELECT day, c.field AS field, c.kind AS kind, lag(c.kind) OVER w AS before, row_number() OVER w AS n,
                 count(c.kind) OVER (PARTITION BY c.field ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen,
                 last_value(c.kind IGNORE NULLS) OVER (PARTITION BY c.field ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last
          FROM s WINDOW w AS (PARTITION BY c.field ORDER BY day)),
    x AS (SELECT day, field, 'added' AS change, NULL AS old_type, kind AS new_type FROM k WHERE n > 1 AND kind IS NOT NULL AND seen = 0
          UNION ALL SELECT day, field, 'back', last, kind FROM k WHERE n > 1 AND kind IS NOT NULL AND seen > 0 AND before IS NULL
          UNION ALL SELECT day, field, 'retyped', last, kind FROM k WHERE kind <> last
          UNION ALL SELECT day, field, 'missing', before, NULL FROM k WHERE kind IS NULL AND before IS NOT NULL)
    SELECT CAST(day AS VARCHAR) AS day, field, change, old_type, new_type FROM x
    """,
)
def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Columns that were added, went, came back or changed their type, by day."""
    return drift.drift(spark, drift.day_schemas(spark, _days(spark, folder), "day"))


@query(
    "catalogued_tables",
    f"""
    SELECT event_id, CASE WHEN {_ERA} = 2 THEN 'u' ELSE '' END || user_id AS user_id,
           CASE WHEN {_ERA} < 2 THEN value END AS value, CASE WHEN {_ERA} > 0 THEN props END AS props,
           CAST(day AS VARCHAR) AS day
    FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)
    """,
)
def catalogued_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All days of changing columns in one catalogued table, its schema found from the files, read by SQL."""
    path, name = _days(spark, folder), f"events_{uuid.uuid4().hex}"
    drift.catalogue(spark, path, name, "day", scratch(spark, "catalogued"))
    return spark.sql(f"SELECT event_id, user_id, value, props, day FROM {name}")
