"""History windows, gold tables and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions import text
from roomledger.operators import gold, history, rank
from roomledger.plans.queries.merging import MERGED_SQL, merged
from roomledger.plans.queries.registry import query, table
from roomledger.plans.queries.texts import AMENITY_VALUES, LISTING_TEXT
from roomledger.session import scratch

CENTS = "CAST(round(value * 100) AS BIGINT)"


def _history(spark: SparkSession, folder: str) -> DataFrame:
    """Merged observations with the value in cents."""
    return merged(spark, folder).select(
        "item_id", "day", "event_type", F.expr(CENTS).alias("cents"), "observations"
    )


HISTORY_SQL = f"SELECT item_id, day, event_type, {CENTS} AS cents, observations FROM ({MERGED_SQL})"


@query(
    "price_history",
    f"""
    SELECT item_id, CAST(day AS VARCHAR) AS day, cents,
           CAST(lag(day) OVER w AS VARCHAR) AS previous_day, lag(cents) OVER w AS previous_cents,
           cents - lag(cents) OVER w AS cents_change,
           lag(day) OVER w IS NOT NULL AND event_type <> lag(event_type) OVER w AS status_changed
    FROM ({HISTORY_SQL}) WINDOW w AS (PARTITION BY item_id ORDER BY day)
    """,
)
def price_history(spark: SparkSession, folder: str) -> DataFrame:
    """Price and state against the previous observation of the item."""
    rows = history.changes(_history(spark, folder), "item_id", "day", ["cents", "event_type"])
    return rows.select(
        "item_id", F.col("day").cast("string").alias("day"), "cents",
        F.col("previous_day").cast("string").alias("previous_day"), "previous_cents",
        "cents_change", F.col("event_type_changed").alias("status_changed"),
    )


@query(
    "latest_observation",
    f"""
    SELECT item_id, CAST(max(day) AS VARCHAR) AS day, arg_max(cents, day) AS cents,
           arg_max(event_type, day) AS event_type
    FROM ({HISTORY_SQL}) GROUP BY item_id
    """,
)
def latest_observation(spark: SparkSession, folder: str) -> DataFrame:
    rows = history.latest(_history(spark, folder), ["item_id"], ["day"])
    return rows.select("item_id", F.col("day").cast("string").alias("day"), "cents", "event_type")


@query(
    "trailing_average",
    f"""
    SELECT item_id, CAST(day AS VARCHAR) AS day,
           CAST(sum(cents) OVER w AS DOUBLE) / count(cents) OVER w AS trailing_cents
    FROM ({HISTORY_SQL}) WINDOW w AS (PARTITION BY item_id ORDER BY day ROWS 6 PRECEDING)
    """,
)
def trailing_average(spark: SparkSession, folder: str) -> DataFrame:
    rows = history.trailing_average(
        _history(spark, folder), "item_id", "day", "cents", 7, "trailing_cents"
    )
    return rows.select("item_id", F.col("day").cast("string").alias("day"), "trailing_cents")


PRICE_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


@query(
    "rank_in_city",
    f"""
    SELECT o_orderkey, o_orderstatus, CAST(dense_rank() OVER (
        PARTITION BY o_orderstatus ORDER BY {PRICE_CENTS} DESC) AS BIGINT) AS price_rank
    FROM orders
    """,
)
def rank_in_city(spark: SparkSession, folder: str) -> DataFrame:
    """Dense rank by price within three very large groups."""
    rows = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.expr(PRICE_CENTS).alias("cents")
    )
    ranked = rank.dense_rank_in(rows, ["o_orderstatus"], "cents", "price_rank")
    return ranked.select("o_orderkey", "o_orderstatus", "price_rank")


@query(
    "gold_daily",
    f"""
    SELECT event_type AS city, CAST(day AS VARCHAR) AS day, count(*) AS listings,
           CAST(sum(cents) AS DOUBLE) / count(cents) AS avg_price, min(cents) AS min_price,
           max(cents) AS max_price, CAST(sum(observations) AS DOUBLE) / count(*) AS avg_rating,
           count(*) AS rated, CAST(count_if(cents > 1000) AS DOUBLE) / count(*) AS costly_share
    FROM ({HISTORY_SQL}) GROUP BY 1, 2
    """,
)
def gold_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Listings, price and rating summaries per city and day."""
    rows = _history(spark, folder).select(
        F.col("event_type").alias("city"), F.col("day").cast("string").alias("day"), "cents",
        "observations",
    )
    return gold.daily_summary(
        rows, ["city", "day"], F.col("cents"), F.col("observations"),
        {"costly": F.col("cents") > 1000},
    )


@query(
    "amenity_shares",
    f"""
    WITH t AS (SELECT DISTINCT p_partkey, p_brand, tag
               FROM (SELECT p_partkey, p_brand, lower({LISTING_TEXT}) AS x FROM part)
               JOIN {AMENITY_VALUES} ON contains(x, phrase)),
    n AS (SELECT p_brand, count(*) AS listings FROM part GROUP BY 1)
    SELECT t.p_brand, tag, count(*) AS tagged, any_value(listings) AS listings,
           CAST(count(*) AS DOUBLE) / any_value(listings) AS share
    FROM t JOIN n ON t.p_brand = n.p_brand GROUP BY 1, 2
    """,
)
def amenity_shares(spark: SparkSession, folder: str) -> DataFrame:
    tags = text.keywords_found(F.expr(LISTING_TEXT), fixed.AMENITY_PHRASES)
    rows = table(spark, folder, "part").select("p_partkey", "p_brand", tags.alias("tags"))
    return gold.amenity_shares(rows, ["p_brand"], "tags", ["p_partkey"])


@query(
    "structured_search",
    f"""
    WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, n_name,
                      p_size % 6 AS stars, l_quantity AS price, CAST(p_size % 11 AS BIGINT) AS rating,
                      lower({LISTING_TEXT}) AS x
               FROM lineitem JOIN part ON l_partkey = p_partkey
               JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, n_name, rating, price FROM g
    WHERE n_name IN ('NATION_2', 'NATION_15', 'NATION_20') AND stars >= 3 AND rating > 4.5 AND price <= 30
      AND contains(x, 'pool')
    ORDER BY rating DESC, price, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 50
    """,
)
def structured_search(spark: SparkSession, folder: str) -> DataFrame:
    """Several conditions at once, best rated first, then cheapest."""
    tags = text.keywords_found(F.expr(LISTING_TEXT), {"swimming_pool": ["pool"]})
    listings = (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumns(
            {
                "stars": F.col("p_size") % 6,
                "rating": (F.col("p_size") % 11).cast("bigint"),
                "price": F.col("l_quantity"),
            }
        )
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    found = gold.search(
        listings,
        [
            F.col("n_name").isin("NATION_2", "NATION_15", "NATION_20"),
            F.col("stars") >= 3,
            F.col("rating") > 4.5,
            F.col("price") <= 30,
            F.array_contains(tags, "swimming_pool"),
        ],
        [F.desc("rating"), F.col("price"), *[F.col(k) for k in keys]],
        50,
    )
    return found.select(*keys, "p_name", "n_name", "rating", "price")


@query(
    "rank_by_change",
    f"""
    WITH c AS (SELECT item_id, day, event_type,
                      (cents - lag(cents) OVER (PARTITION BY item_id ORDER BY day)) / 7.0::DOUBLE AS change
               FROM ({HISTORY_SQL}))
    SELECT item_id, CAST(day AS VARCHAR) AS day, event_type, change,
           CASE WHEN change IS NOT NULL THEN
               CAST(dense_rank() OVER (PARTITION BY event_type ORDER BY change DESC NULLS LAST) AS BIGINT) END AS change_rank
    FROM c
    """,
)
def rank_by_change(spark: SparkSession, folder: str) -> DataFrame:
    """Dense rank by a signed fraction, the price change per day of a week; null for an item's first day."""
    rows = history.changes(_history(spark, folder), "item_id", "day", ["cents"])
    rows = rows.select(
        "item_id", F.col("day").cast("string").alias("day"), "event_type", (F.col("cents_change") / 7.0).alias("change")
    )
    return rank.dense_rank_in(rows, ["event_type"], "change", "change_rank")


PRICED = f"""
    SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, n_name AS city, o_orderpriority AS kind,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {PRICE_CENTS} - 10000000 END AS cents
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def _priced(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as listings of a day, city and kind; some without a price, some below zero."""
    orders = table(spark, folder, "orders").select(
        "o_custkey", F.to_date("o_orderdate").cast("string").alias("day"), F.col("o_orderpriority").alias("kind"),
        F.when(F.col("o_orderstatus") != "P", F.expr(PRICE_CENTS) - 10000000).alias("cents"),
    )
    places = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", F.col("n_name").alias("city"))
    return orders.join(places, F.col("o_custkey") == F.col("c_custkey")).select("day", "city", "kind", "cents")


@query(
    "gold_rollup",
    f"""
    SELECT substr(day, 1, 7) AS month, city, kind,
           CAST(2 - grouping(city) - grouping(kind) AS INTEGER) AS depth, count(*) AS listings,
           CAST(sum(cents) AS DOUBLE) / count(cents) AS avg_price, min(cents) AS min_price, max(cents) AS max_price
    FROM ({PRICED}) GROUP BY GROUPING SETS ((month, city, kind), (month, city), (month))
    """,
)
def gold_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The market of a month by city and kind, by city, and whole, from stored daily sums."""
    path = scratch(spark, "gold-daily")
    daily = gold.daily_partials(_priced(spark, folder), ["day", "city", "kind"], "cents")
    daily.write.parquet(path)
    stored = spark.read.schema(daily.schema).parquet(path).withColumn("month", F.substring("day", 1, 7))
    return gold.market_rollup(stored, ["month"], ["city", "kind"])


SHARES = (0.1, 0.25, 0.5, 0.75, 0.9, 1.0)

_LOW = "((abs(q) >> s) << s)"


@query(
    "gold_percentiles",
    f"""
    WITH r AS (SELECT city, cents, row_number() OVER (PARTITION BY city ORDER BY cents) AS place,
                      count(*) OVER (PARTITION BY city) AS n
               FROM ({PRICED}) WHERE cents IS NOT NULL),
    q AS (SELECT city, share, n, cents AS q, greatest(length(bin(abs(cents))) - {gold.SUMMARY_BITS}, 0) AS s
          FROM r, (SELECT unnest({list(SHARES)}::DOUBLE[]) AS share) WHERE place = greatest(ceil(share * n), 1))
    SELECT city, share, n, CASE WHEN q < 0 THEN -({_LOW} + (1::BIGINT << s) - 1) ELSE {_LOW} END AS low,
           CASE WHEN q < 0 THEN -{_LOW} ELSE {_LOW} + (1::BIGINT << s) - 1 END AS high
    FROM q
    """,
)
def gold_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """Price quantiles of a city over all days, from the stored summaries of the days.

    The bounds are those of the summary's cell; the SQL sorts all prices and takes the cell of the exact one.
    """
    path = scratch(spark, "gold-quantiles")
    daily = gold.quantile_summary(_priced(spark, folder), ["day", "city"], "cents")
    daily.write.parquet(path)
    stored = spark.read.schema(daily.schema).parquet(path)
    return gold.quantiles(gold.combine_summaries(stored, ["city"]), ["city"], SHARES)
