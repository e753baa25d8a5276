"""Store statistics, completeness and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.functions.numbers import price
from roomledger.functions.places import is_blocked
from roomledger.operators import profile
from roomledger.plans.queries.registry import query, table

PATHS = ["doc_id", "text", "lang", "source", "info.quality", "info.toxic", "marked"]
MARKED_SQL = "list_filter(string_split(text, chr(10)), lambda l: contains(l, '@'))"

DOCUMENTS_SQL = f"""
    SELECT d.*, l.quality, l.toxic, l.doc_id IS NOT NULL AS labelled,
           CASE WHEN l.doc_id IS NOT NULL THEN {MARKED_SQL} END AS marked
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their sparse labels; labelled ones carry a list of marked lines."""
    labels = table(spark, folder, "labels").withColumnRenamed("doc_id", "l_id")
    joined = table(spark, folder, "documents").join(
        labels, F.col("doc_id") == F.col("l_id"), "left"
    )
    lines = F.filter(F.split("text", "\n"), lambda line: line.contains("@"))
    return joined.select(
        "doc_id",
        "text",
        "lang",
        "source",
        F.struct("quality", "toxic").alias("info"),
        F.when(F.col("l_id").isNotNull(), lines).alias("marked"),
    )


def _profile_sql() -> str:
    parts = []
    for path in PATHS:
        name = path.split(".")[-1]
        test = "len(marked) > 0" if name == "marked" else f"{name} IS NOT NULL"
        parts.append(
            f"SELECT '{path}' AS field, count_if(coalesce({test}, false)) AS filled, "
            "count(*) AS total FROM d"
        )
    return (
        f"WITH d AS ({DOCUMENTS_SQL}), p AS ({' UNION ALL '.join(parts)}) "
        "SELECT field, CAST(filled AS BIGINT) AS filled, total, "
        "CAST(100 * filled // total AS BIGINT) AS percent FROM p"
    )


@query("completeness_profile", _profile_sql())
def completeness_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.completeness(documents(spark, folder), PATHS)


@query(
    "low_coverage_fields",
    f"SELECT * FROM ({_profile_sql()}) WHERE filled < total // 2",
)
def low_coverage_fields(spark: SparkSession, folder: str) -> DataFrame:
    return profile.low_coverage(profile.completeness(documents(spark, folder), PATHS), PATHS)


@query(
    "average_list_size",
    f"SELECT avg(coalesce(len(marked), 0)) AS avg_marked FROM ({DOCUMENTS_SQL})",
)
def average_list_size(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).agg(profile.average_size("marked").alias("avg_marked"))


@query(
    "store_stats",
    """SELECT count(*) AS total, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS first_date,
              CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_date,
              string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS cities
       FROM events""",
)
def store_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        F.to_date("ts").cast("string").alias("day"), "event_type"
    )
    stats = profile.store_stats(rows, "day", "event_type")
    return stats.withColumn("cities", F.array_join("cities", ","))


@query(
    "distinct_partitions",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
              string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS cities
       FROM events GROUP BY 1""",
)
def distinct_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Sorted distinct partition names of each daily batch."""
    days = table(spark, folder, "events").groupBy(F.to_date("ts").cast("string").alias("day"))
    return days.agg(F.array_join(profile.distinct_texts("event_type"), ",").alias("cities"))


@query(
    "partition_counts",
    """SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS rows,
              CAST(count_if(value >= 5) AS BIGINT) AS enriched,
              CAST(count_if(value < 5) AS BIGINT) AS failed
       FROM events GROUP BY 1, 2""",
)
def partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").withColumn("day", F.to_date("ts").cast("string"))
    flags = {"enriched": F.col("value") >= 5, "failed": F.col("value") < 5}
    return profile.partition_counts(rows, ["event_type", "day"], flags)


PRICE_TEXT = (
    "CASE WHEN l_linestatus = 'O' THEN concat('VND ', cast(l_orderkey as string), '.000') "
    "WHEN l_returnflag = 'R' THEN 'on request' WHEN l_returnflag = 'N' THEN '' END"
)


@query(
    "silver_coverage",
    f"""
    WITH t AS (SELECT {PRICE_TEXT} AS raw, l_orderkey, l_linestatus FROM lineitem)
    SELECT 'price' AS field, CAST(count_if(raw <> '') AS BIGINT) AS present,
           CAST(count_if(l_linestatus = 'O' AND l_orderkey > 0) AS BIGINT) AS read,
           CAST(count_if(raw <> '' AND NOT (l_linestatus = 'O' AND l_orderkey > 0)) AS BIGINT)
               AS rejected
    FROM t
    """,
)
def silver_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Texts present, read and rejected by the price column."""
    raw = F.expr(PRICE_TEXT)
    rows = table(spark, folder, "lineitem").select(raw.alias("raw")).select(
        "raw", price(F.col("raw")).alias("typed")
    )
    return profile.silver_coverage(rows, {"price": (F.col("raw"), F.col("typed"))})


@query(
    "page_union_counts",
    """
    WITH u AS (SELECT url, 'first' AS batch FROM pages WHERE url LIKE 'https:%'
               UNION ALL SELECT url, 'second' FROM pages WHERE url NOT LIKE 'https:%'
               UNION ALL SELECT NULL, 'second' FROM pages WHERE html NOT LIKE '%<h1>%'
               UNION ALL SELECT '', 'third' FROM labels)
    SELECT batch, count(*) AS rows,
           CAST(count_if(url IS NOT NULL AND url <> '') AS BIGINT) AS with_url,
           CAST(count_if(url IS NULL OR url = '') AS BIGINT) AS without_url
    FROM u GROUP BY batch
    """,
)
def page_union_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bag union of batches with different columns, rows with and without an address."""
    pages = table(spark, folder, "pages")
    secure = F.col("url").startswith("https:")
    batches = [
        pages.where(secure).select("url", "page_id", F.lit("first").alias("batch")),
        pages.where(~secure).select("url", F.lit("second").alias("batch")),
        pages.where(~F.col("html").contains("<h1>")).select(F.lit("second").alias("batch")),
        table(spark, folder, "labels").select(F.lit("").alias("url"), F.lit("third").alias("batch")),
    ]
    union = batches[0]
    for batch in batches[1:]:
        union = union.unionByName(batch, allowMissingColumns=True)
    known = F.coalesce(F.col("url") != "", F.lit(False))
    return profile.partition_counts(union, ["batch"], {"with_url": known, "without_url": ~known})


TITLE = (
    "concat(CASE WHEN page_id % 7 = 0 THEN 'Access Denied ' "
    "WHEN page_id % 11 = 3 THEN 'Are you a ROBOT? ' ELSE '' END, "
)


@query(
    "blocked_pages",
    rf"""
    WITH t AS (SELECT page_id, url, lower({TITLE} regexp_extract(html, '<title>([^<]*)</title>', 1))) AS title
               FROM pages)
    SELECT page_id, coalesce(regexp_matches(title, 'captcha|robot|blocked|access denied|403|unusual traffic')
           OR regexp_matches(lower(url), 'captcha|robot|blocked|access denied|403|unusual traffic'), false)
           AS blocked
    FROM t
    """,
)
def blocked_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").withColumn(
        "title", F.expr(TITLE + "regexp_extract(html, '<title>([^<]*)</title>', 1))")
    )
    return pages.select("page_id", is_blocked(F.col("title"), F.col("url")).alias("blocked"))
