"""Expected against observed partitions, pagination and refresh gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.operators import coverage
from roomledger.plans.queries.registry import query, table


def _visits(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as visits of a nation on a day; open orders stand for the second page."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("c_nationkey").alias("n_nationkey"),
        F.to_date("o_orderdate").alias("day"),
        F.when(F.col("o_orderstatus") == "O", 1).otherwise(0).alias("page"),
    )


VISITS_SQL = """
    SELECT c_nationkey AS n_nationkey, CAST(o_orderdate AS DATE) AS day,
           CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS page
    FROM orders JOIN customer ON o_custkey = c_custkey
"""
CALENDAR_SQL = """
    SELECT CAST(d AS DATE) AS day FROM (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders),
           generate_series(a, b, INTERVAL 1 DAY) AS s(d)
"""


@query(
    "expected_vs_observed",
    f"""
    WITH v AS ({VISITS_SQL}),
    e AS (SELECT n_nationkey, n_name, day, page
          FROM nation, ({CALENDAR_SQL}) AS c, generate_series(0, 1) AS p(page))
    SELECT n_name, CAST(day AS VARCHAR) AS day, CAST(page AS BIGINT) AS page,
           CAST(page * 25 AS BIGINT) AS "offset"
    FROM e WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.n_nationkey = e.n_nationkey
                             AND v.day = e.day AND v.page = e.page)
    """,
)
def expected_vs_observed(spark: SparkSession, folder: str) -> DataFrame:
    """Partition, day and page combinations without any observation."""
    visits = _visits(spark, folder)
    bounds = table(spark, folder, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    first, last = bounds.select("first").scalar(), bounds.select("last").scalar()
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    expected = coverage.expected_pages(nations, first, last, pages=2)
    gaps = coverage.missing(expected, visits, ["n_nationkey", "day", "page"])
    return gaps.select(
        "n_name", F.col("day").cast("string").alias("day"), F.col("page").cast("bigint").alias("page"),
        F.col("offset").cast("bigint").alias("offset"),
    )


@query(
    "prefix_until_gap",
    """
    WITH h AS (SELECT event_type, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour, count(*) AS n
               FROM events GROUP BY 1, 2),
    b AS (SELECT event_type, min(hour) AS lo, max(hour) AS hi FROM h GROUP BY 1),
    f AS (SELECT b.event_type, p.hour - lo AS page, coalesce(n, 0) AS n
          FROM b, generate_series(lo, hi) AS p(hour) LEFT JOIN h
            ON h.event_type = b.event_type AND h.hour = p.hour),
    g AS (SELECT event_type, min(page) AS gap FROM f WHERE n = 0 GROUP BY 1)
    SELECT f.event_type, CAST(page AS BIGINT) AS page, CAST(n AS BIGINT) AS n
    FROM f LEFT JOIN g ON f.event_type = g.event_type WHERE gap IS NULL OR page < gap
    """,
)
def prefix_until_gap(spark: SparkSession, folder: str) -> DataFrame:
    """Hours as result pages: each type keeps its pages up to the first empty one."""
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3600000000)
    hours = (
        table(spark, folder, "events")
        .select("event_type", hour.alias("hour"))
        .groupBy("event_type", "hour")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    span = hours.groupBy("event_type").agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    pages = span.select("event_type", "lo", F.explode(F.sequence("lo", "hi")).alias("hour"))
    counts = pages.join(hours, ["event_type", "hour"], "left").select(
        "event_type", (F.col("hour") - F.col("lo")).alias("page"), F.coalesce("n", F.lit(0)).alias("n")
    )
    return coverage.before_first_gap(counts, ["event_type"], "page", "n")


def _schedule(spark: SparkSession, folder: str) -> DataFrame:
    """Nations due on each order day; the positions are their keys."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    total = nations.agg(F.count(F.lit(1))).scalar()
    due = coverage.rotation(days, "day", total, fixed.CITIES_PER_DAY)
    return due.join(nations, F.col("position") == F.col("n_nationkey")).select(
        "day", "slot", "n_nationkey", "n_name"
    )


SCHEDULE_SQL = """
    SELECT day, k AS slot, n_nationkey, n_name
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), generate_series(0, 5) AS s(k), nation
    WHERE n_nationkey = ((dayofyear(day) - 1) * 6 + k) % (SELECT count(*) FROM nation)
"""


@query(
    "rotation_schedule",
    f"""SELECT CAST(day AS VARCHAR) AS day, CAST(slot AS BIGINT) AS slot, n_name
        FROM ({SCHEDULE_SQL})""",
)
def rotation_schedule(spark: SparkSession, folder: str) -> DataFrame:
    return _schedule(spark, folder).select(
        F.col("day").cast("string").alias("day"), F.col("slot").cast("bigint").alias("slot"), "n_name"
    )


@query(
    "missed_rotation",
    f"""
    WITH v AS ({VISITS_SQL})
    SELECT CAST(day AS VARCHAR) AS day, n_name FROM ({SCHEDULE_SQL}) AS s
    WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.n_nationkey = s.n_nationkey AND v.day = s.day)
    """,
)
def missed_rotation(spark: SparkSession, folder: str) -> DataFrame:
    """Nations that were due on a day and have no order on it."""
    missed = coverage.missing(
        _schedule(spark, folder), _visits(spark, folder), ["n_nationkey", "day"]
    )
    return missed.select(F.col("day").cast("string").alias("day"), "n_name")


@query(
    "refresh_gaps",
    f"""
    WITH v AS (SELECT DISTINCT n_nationkey, day FROM ({VISITS_SQL}))
    SELECT n_nationkey, CAST(day AS VARCHAR) AS day,
           CAST(lag(day) OVER w AS VARCHAR) AS previous,
           CAST(date_diff('day', lag(day) OVER w, day) AS BIGINT) AS gap_days
    FROM v WINDOW w AS (PARTITION BY n_nationkey ORDER BY day)
    """,
)
def refresh_gaps(spark: SparkSession, folder: str) -> DataFrame:
    gaps = coverage.refresh_gaps(_visits(spark, folder), "n_nationkey", "day")
    return gaps.select(
        "n_nationkey", F.col("day").cast("string").alias("day"),
        F.col("previous").cast("string").alias("previous"),
        F.col("gap_days").cast("bigint").alias("gap_days"),
    )
