"""The whole path from stored pages to records, on pages that are derived from the tables.

Every order gives a search page with two cards in different layouts, every
customer a detail page. The expected fields follow from the columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.functions.text import built_once
from roomledger.operators import gold, profile
from roomledger.plans import daily, listing
from roomledger.plans.queries.registry import query, table
from roomledger.session import PAGES, dealt, scratch
from roomledger.sources import layers


def fill(template: str, values: dict[str, Column]) -> Column:
    """A text with {name} replaced by columns."""
    parts = re.split(r"\{(\w+)\}", re.sub(r"\n\s*", "", template))
    return F.concat(
        *[values[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts)]
    )


CARD = """
<div data-testid='property-card'><div data-testid='property-card-header'>
<a data-testid='title-link' href='/hotel/vn/stay-{c}.en-gb.html?aid={k}'><div data-testid='title'>Stay &amp; More {c}</div></a>
<span>{kind}</span></div><span data-testid='address'> {k} Main Street </span>
<span data-testid='distance'>{t} km from centre</span>
<div data-testid='rating-stars' aria-label='{s} out of 5'><span></span><span></span></div>
<div data-testid='review-score'><div>Scored {w}.{t}</div><div aria-hidden='true'>{w}.{t}</div>
<div aria-hidden='false'><div>Good</div><div>{n},500 reviews</div></div></div>
<ul class='benefit-list'><li>Free cancellation</li><li>Breakfast included</li><li>Nothing else</li><li>Free cancellation</li></ul>
<span data-testid='price-and-discounted-price'>VND {p}</span><s>VND {o}</s>
<div data-testid='taxes-and-charges'>+ taxes and charges</div>
<div data-testid='urgency-message'>Only {r} rooms left!</div>
<img data-testid='image' src='https://img.example.com/{k}.jpg'><img data-testid='image' data-src='https://img.example.com/b.jpg'></div>
"""
ANNEX = """
<div data-testid='property-card'><h3 class='title'>Annex {k}</h3>{link}
<span class='street-address'>street {k} in ward {t}</span>
<div class='bui-rating'><span></span><span></span><span></span></div>
<div data-testid='review-score'><div>Very good</div><div>8.1</div><div>512 reviews</div></div>
<span data-testid='property-type-badge'>Lodge</span>{sold}<p>Outdoor pool and spa, pets allowed</p></div>
"""
PAGE = "<!DOCTYPE html><html><head><title>{title}</title></head><body><main>{first}{second}</main></body></html>"


def search_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One search page per order."""
    return dealt(table(spark, folder, "orders"), PAGES).select(*_search_page())


@built_once
def _search_page() -> list[Column]:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    price = F.floor("o_totalprice")
    status = F.col("o_orderstatus")
    values = {
        "k": k,
        "c": c,
        "t": k % 10,
        "w": k % 11,
        "s": k % 7,
        "n": k + 1,
        "r": k % 4,
        "p": price,
        "o": F.floor(price * (100 + k % 30) / 100),
        "kind": F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'Hostel' WHEN 1 THEN 'Beach villa' ELSE 'Nice' END"),
        "link": F.when(
            status != "P",
            fill("<a href='/hotel/vn/annex-{k}.html#x'>open</a>", {"k": k}),
        ).otherwise(F.lit("")),
        "sold": F.when(status == "F", F.lit("<div class='soldOut'>gone</div>")).otherwise(F.lit("")),
        "title": F.when(
            F.col("o_orderpriority") == "1-URGENT", F.lit("Access denied")
        ).otherwise(F.lit("Stays")),
    }
    html = fill(
        PAGE, {**values, "first": fill(CARD, values), "second": fill(ANNEX, values)}
    )
    return [
        k.alias("page_id"),
        fill("https://www.example.com/search?offset={k}", values).alias("url"),
        html.alias("html"),
        F.lit("search").alias("page_kind"),
        fill("City {t}", values).alias("city"),
        F.lit(0).alias("page"),
        fill("2024-05-01T08:00:00.{t}00001", values).alias("fetched_at"),
        F.expr("make_date(year(o_orderdate), 1, 1)").alias("scrape_date"),
    ]


DETAIL = """
<html><head><title>Stay {c}</title><script type="application/ld+json">{broken</script>
<script type="application/ld+json">{"@graph": [{"name": "x"}, {"geo": {"latitude": 10.{c}, "longitude": 106.5},
"address": {"streetAddress": "{c} Long Road", "addressLocality": "Old Town"}, "checkinTime": "from 14:00"}]}</script></head>
<body>{loaded}<div data-testid='property-description'><p>Stay number {c}.</p><p>It is quiet.</p></div>
<div id='hp_policies_box'><div>Check-out: until {h}:30 AM</div></div>
<ul data-testid='property-language-spoken'><li>English</li><li>Vietnamese</li><li>English</li></ul>
<div data-testid='property-most-popular-facilities-wrapper'><span>Free WiFi</span><span>{segment}</span></div>
<div data-testid='facility-group'><h3>Outdoors</h3><ul><li>Garden</li><li>Terrace</li></ul></div>
<div data-testid='facility-group'><ul><li>Lift</li></ul></div>
<table><tr data-testid='room-row'><td data-testid='room-name'>Double</td><td>1 double bed, 20 m², max 2 adults</td>
<td><strong class='price'>VND {c}000</strong></td><td>Free cancellation</td></tr>
<tr data-testid='room-row'><td data-testid='room-name'>Suite</td><td data-max-occupancy='4'>2 king beds</td></tr></table>
<div data-testid='review-score'><div aria-hidden='true'>9.{t}</div><div aria-hidden='false'><div>Superb</div><div>{c} reviews</div></div></div>
<div data-testid='review-subscore'>Staff <b>9.{t}</b></div><div data-testid='review-subscore'>Location 8.0</div>
{price}<div data-testid='excluded-charges'>Excludes city tax</div>
<ul data-testid='location-block'><li>North Beach {t}00 m</li><li>Night market 1.{h} km</li><li>Old hall {h} miles</li></ul>
<div data-testid='photo-grid-item'><img src='https://img.example.com/max300/{c}.jpg'></div></body></html>
"""


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One detail page per customer; those of one segment never loaded."""
    return dealt(table(spark, folder, "customer"), PAGES).select(*_detail_page())


@built_once
def _detail_page() -> list[Column]:
    c = F.col("c_custkey")
    values = {
        "c": c,
        "t": c % 10,
        "h": c % 9 + 1,
        "broken": F.lit("{broken"),
        "segment": F.col("c_mktsegment"),
        "loaded": F.when(
            F.col("c_mktsegment") != "MACHINERY", F.lit("<h2 class='hp__hotel-name'>Stay</h2>")
        ).otherwise(F.lit("")),
        "price": F.when(
            F.col("c_acctbal") > 0,
            fill("<span class='hprt-price-price'>VND {c}500</span><del>VND 9.000.000</del>", {"c": c}),
        ).otherwise(F.lit("")),
    }
    html = fill(DETAIL.replace("{broken<", "{broken}<"), values)
    kept = F.col("c_mktsegment") != "MACHINERY"
    html = F.when(kept, html).otherwise(F.regexp_replace(html, "property-description", "other"))
    return [
        c.alias("page_id"),
        fill("https://www.example.com/hotel/vn/stay-{c}.html", values).alias("url"),
        html.alias("html"),
        F.lit("detail").alias("page_kind"),
        F.lit(None).cast("string").alias("city"),
        F.lit(0).alias("page"),
        F.lit("2024-05-01T09:00:00.000001").alias("fetched_at"),
        F.lit(None).cast("date").alias("scrape_date"),
    ]


def joined(column: str) -> Column:
    return F.array_join(column, ",")


CARDS_SQL = """
    SELECT o_orderkey AS page_id, 0 AS unit, 'Stay & More ' || o_custkey AS name,
           'https://www.example.com/hotel/vn/stay-' || o_custkey || '.html' AS url,
           'stay-' || o_custkey AS hotel_id, o_orderkey || ' Main Street' AS address,
           (o_orderkey % 10) || ' km from centre' AS distance,
           CASE WHEN floor(o_totalprice) > 0 THEN CAST(floor(o_totalprice) AS DOUBLE) END AS price,
           CASE WHEN floor(floor(o_totalprice) * (100 + o_orderkey % 30) / 100) > floor(o_totalprice)
                THEN CAST(floor(floor(o_totalprice) * (100 + o_orderkey % 30) / 100) AS DOUBLE) END AS original,
           false AS taxes,
           CASE WHEN o_orderkey % 11 + (o_orderkey % 10) / 10.0 BETWEEN 1 AND 10
                THEN CAST(o_orderkey % 11 + (o_orderkey % 10) / 10.0 AS DOUBLE) END AS score,
           'Good' AS label, (o_orderkey + 1) * 1000 + 500 AS reviews,
           CAST(CASE WHEN o_orderkey % 7 BETWEEN 1 AND 5 THEN o_orderkey % 7 ELSE 2 END AS BIGINT) AS stars,
           CASE o_orderkey % 3 WHEN 0 THEN 'Hostel' WHEN 1 THEN 'Villa' END AS type,
           CASE WHEN o_orderkey % 4 = 1 THEN 'last_room' ELSE 'limited' END AS status,
           CAST(o_orderkey % 4 AS BIGINT) AS rooms_left,
           'Free cancellation,Breakfast included' AS badges, 'free_cancellation,free_breakfast' AS amenities,
           'https://img.example.com/' || o_orderkey || '.jpg,https://img.example.com/b.jpg' AS images,
           o_custkey, o_orderdate, o_orderkey % 10 AS t
    FROM orders WHERE o_orderpriority <> '1-URGENT' AND CAST(o_orderkey AS VARCHAR) NOT LIKE '%403%'
    UNION ALL
    SELECT o_orderkey, 1, 'Annex ' || o_orderkey,
           CASE WHEN o_orderstatus <> 'P' THEN 'https://www.example.com/hotel/vn/annex-' || o_orderkey || '.html' END,
           CASE WHEN o_orderstatus <> 'P' THEN 'annex-' || o_orderkey END,
           'street ' || o_orderkey || ' in ward ' || (o_orderkey % 10), NULL, NULL, NULL, NULL,
           8.1, 'Very good', 512, 3, 'Lodge', CASE WHEN o_orderstatus = 'F' THEN 'sold_out' ELSE 'available' END,
           NULL, '', 'swimming_pool,spa,pets_allowed', '', NULL, o_orderdate, o_orderkey % 10
    FROM orders WHERE o_orderpriority <> '1-URGENT' AND CAST(o_orderkey AS VARCHAR) NOT LIKE '%403%'
"""
CARD_FIELDS = (
    "page_id, CAST(unit AS BIGINT) AS unit, name, url, hotel_id, address, distance, price, original, "
    "CASE WHEN original > price THEN CAST(format('{:.1f}', (original - price) / original * 100) AS DOUBLE) END "
    "AS discount, taxes, score, label, reviews, stars, type, status, rooms_left, badges, amenities, images"
)


def _cards(spark: SparkSession, folder: str, only: list[str] | None = None) -> DataFrame:
    return listing.usable_cards(listing.extract_cards(search_pages(spark, folder), only=only, blocked=False))


@query("card_records", f"SELECT {CARD_FIELDS} FROM ({CARDS_SQL})")
def card_records(spark: SparkSession, folder: str) -> DataFrame:
    """Search pages to typed cards: two layouts, blocked pages left out."""
    records = listing.card_records(_cards(spark, folder))
    return records.select(
        "page_id",
        F.col("unit").cast("bigint").alias("unit"),
        "name",
        "url",
        "hotel_id",
        F.col("location.address").alias("address"),
        F.col("location.distance_from_center").alias("distance"),
        F.col("pricing.price_per_night_vnd").alias("price"),
        F.col("pricing.original_price_vnd").alias("original"),
        F.col("pricing.discount_pct").alias("discount"),
        F.col("pricing.taxes_included").alias("taxes"),
        F.col("rating.score").alias("score"),
        F.col("rating.label").alias("label"),
        F.col("rating.review_count").alias("reviews"),
        F.col("property.star_rating").cast("bigint").alias("stars"),
        F.col("property.type").alias("type"),
        F.col("property.availability_status").alias("status"),
        F.col("property.rooms_left").cast("bigint").alias("rooms_left"),
        joined("badges").alias("badges"),
        joined("amenities").alias("amenities"),
        joined("images").alias("images"),
    )


DETAILS_SQL = """
    SELECT c_custkey, 'https://www.example.com/hotel/vn/stay-' || c_custkey || '.html' AS url,
           CAST('10.' || c_custkey AS DOUBLE) AS latitude, CAST(106.5 AS DOUBLE) AS longitude, c_custkey || ' Long Road' AS address,
           'Stay number ' || c_custkey || '.' || chr(10) || 'It is quiet.' AS description,
           '14:00' AS checkin_time, lpad(CAST(c_custkey % 9 + 1 AS VARCHAR), 2, '0') || ':30' AS checkout_time,
           'English,Vietnamese' AS languages, 'Free WiFi,' || c_mktsegment AS popular, c_mktsegment,
           'Group 2=Lift;Outdoors=Garden,Terrace' AS facilities, 2 AS rooms,
           CASE WHEN c_custkey > 0 THEN CAST(c_custkey * 1000 AS DOUBLE) END AS room_price,
           CASE WHEN c_acctbal > 0 THEN CAST(c_custkey * 1000 + 500 AS DOUBLE)
                WHEN c_custkey > 0 THEN CAST(c_custkey * 1000 AS DOUBLE) END AS price,
           CASE WHEN c_acctbal > 0 AND 9000000 > c_custkey * 1000 + 500 THEN CAST(9000000 AS DOUBLE)
                WHEN c_acctbal <= 0 THEN NULL END AS original,
           'Excludes city tax' AS taxes_text, 9 + (c_custkey % 10) / 10.0 AS score, 'Superb' AS label,
           CAST(c_custkey AS BIGINT) AS reviews, 'location=8.0;staff=' || format('{:.1f}', 9 + (c_custkey % 10) / 10.0) AS categories,
           'https://img.example.com/max1280/' || c_custkey || '.jpg' AS images
    FROM customer WHERE c_mktsegment <> 'MACHINERY'
"""


def _pairs(column: Column, value) -> Column:
    entries = F.array_sort(F.map_entries(column))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), value(e["value"]))), ";"
    )


@query(
    "detail_records",
    f"""SELECT url, latitude, longitude, address, description, checkin_time, checkout_time, languages,
               popular, facilities, CAST(rooms AS BIGINT) AS rooms, room_price, price, original, taxes_text,
               CAST(score AS DOUBLE) AS score, label, reviews, categories, images
        FROM ({DETAILS_SQL})""",
)
def detail_records(spark: SparkSession, folder: str) -> DataFrame:
    """Detail pages to typed fields; pages that never loaded are left out."""
    details = listing.detail_records(listing.extract_details(detail_pages(spark, folder)))
    d = F.col("d")
    return details.select(
        "url",
        "d.latitude",
        "d.longitude",
        "d.address",
        "d.description",
        "d.checkin_time",
        "d.checkout_time",
        F.array_join("d.languages", ",").alias("languages"),
        F.array_join("d.popular", ",").alias("popular"),
        _pairs(d["all"], lambda v: F.array_join(v, ",")).alias("facilities"),
        F.size("d.room_types").cast("bigint").alias("rooms"),
        F.get("d.room_types", F.lit(0))["price_vnd"].alias("room_price"),
        F.col("d.pricing.price_per_night_vnd").alias("price"),
        F.col("d.pricing.original_price_vnd").alias("original"),
        F.col("d.pricing.taxes_fees_text").alias("taxes_text"),
        "d.score",
        "d.label",
        F.col("d.review_count").alias("reviews"),
        _pairs(d["review_categories"], lambda v: v.cast("string")).alias("categories"),
        F.array_join("d.images", ",").alias("images"),
    )


ENRICHED_SQL = f"""
    SELECT c.page_id, c.unit, c.name, c.url, c.hotel_id, c.o_orderdate, c.status, c.t,
           d.url IS NOT NULL AS enriched, d.latitude, coalesce(d.address, c.address) AS address,
           d.description, d.checkin_time, coalesce(d.languages, '') AS languages, c.type,
           CASE WHEN d.price IS NOT NULL THEN d.price ELSE c.price END AS price,
           CASE WHEN d.price IS NOT NULL THEN d.original ELSE c.original END AS original,
           CASE WHEN d.price IS NOT NULL THEN false ELSE c.taxes END AS taxes,
           d.taxes_text, coalesce(CAST(d.score AS DOUBLE), c.score) AS score, coalesce(d.label, c.label) AS label,
           coalesce(d.reviews, c.reviews) AS reviews, c.stars,
           CASE WHEN d.url IS NOT NULL THEN array_to_string(list_sort(list_distinct(
                string_split(c.amenities, ',') || ['free_wifi', lower(d.c_mktsegment)])), ',')
                ELSE c.amenities END AS amenities,
           coalesce(d.images, c.images) AS images, coalesce(d.rooms, 0) AS rooms,
           d.longitude, c.distance, c.rooms_left, d.checkout_time, c.badges, d.c_custkey, d.c_mktsegment
    FROM ({CARDS_SQL}) c LEFT JOIN ({DETAILS_SQL}) d ON c.url = d.url
"""


def enriched(
    spark: SparkSession, folder: str, cards: list[str] | None = None, details: list[str] | None = None
) -> DataFrame:
    pages = search_pages(spark, folder).unionByName(detail_pages(spark, folder))
    return daily.daily_records(pages, only_cards=cards, only_details=details)


@query(
    "enriched_records",
    f"""SELECT page_id, CAST(unit AS BIGINT) AS unit, url, enriched, latitude, address, description, checkin_time,
               languages, type, price, original, taxes, taxes_text, score, label, reviews, stars,
               amenities, images, CAST(rooms AS BIGINT) AS rooms
        FROM ({ENRICHED_SQL})""",
)
def enriched_records(spark: SparkSession, folder: str) -> DataFrame:
    """Cards with the fields of their detail page, by the precedence of each field."""
    return enriched(spark, folder).select(
        "page_id",
        F.col("unit").cast("bigint").alias("unit"),
        "url",
        "enriched",
        "location.latitude",
        "location.address",
        "detail.description",
        "detail.checkin_time",
        F.array_join("detail.languages", ",").alias("languages"),
        F.col("property.type").alias("type"),
        F.col("pricing.price_per_night_vnd").alias("price"),
        F.col("pricing.original_price_vnd").alias("original"),
        F.col("pricing.taxes_included").alias("taxes"),
        F.col("pricing.taxes_fees_text").alias("taxes_text"),
        "rating.score",
        "rating.label",
        F.col("rating.review_count").alias("reviews"),
        F.col("property.star_rating").cast("bigint").alias("stars"),
        joined("amenities").alias("amenities"),
        joined("images").alias("images"),
        F.size("property.room_types").cast("bigint").alias("rooms"),
    )


def _json_list(column: str) -> str:
    """SQL: the JSON text of a list that is kept as a text with commas."""
    return f"""CASE WHEN {column} = '' THEN '[]' ELSE '["' || replace({column}, ',', '", "') || '"]' END"""


FLAT_SQL = f"""
    SELECT page_id, CAST(unit AS BIGINT) AS unit, CAST(make_date(year(o_orderdate), 1, 1) AS VARCHAR) AS scrape_date,
           '2024-05-01T08:00:00.' || t || '00001' AS scraped_at, hotel_id, name, url, 'City ' || t AS city,
           'Vietnam' AS country, address, distance AS distance_from_center, latitude, longitude,
           price AS price_per_night_vnd, original AS original_price_vnd,
           CASE WHEN original > price THEN CAST(format('{{:.1f}}', (original - price) / original * 100) AS DOUBLE) END
           AS discount_pct,
           'VND' AS currency, taxes AS taxes_included, taxes_text AS taxes_fees_text, score AS rating_score,
           label AS rating_label, CAST(reviews AS BIGINT) AS review_count,
           CASE WHEN enriched THEN '{{"staff": ' || format('{{:.1f}}', 9 + (c_custkey % 10) / 10.0) || ', "location": 8.0}}'
                ELSE '{{}}' END AS review_categories,
           type AS property_type, stars AS star_rating, status AS availability_status, rooms_left,
           CASE WHEN enriched THEN
               '[{{"name": "Double", "beds": "1 double bed", "size_sqm": 20, "max_guests": 2, "price_vnd": '
               || CASE WHEN c_custkey > 0 THEN (c_custkey * 1000) || '.0' ELSE 'null' END || ', "cancellation": "free"}}, '
               || '{{"name": "Suite", "beds": "2 king beds", "size_sqm": null, "max_guests": 4, "price_vnd": null, "cancellation": null}}]'
               ELSE '[]' END AS room_types,
           checkin_time, checkout_time, {_json_list("languages")} AS languages, description,
           CASE WHEN enriched THEN '["Free WiFi", "' || c_mktsegment || '"]' ELSE '[]' END AS facilities_popular,
           CASE WHEN enriched THEN '{{"Outdoors": ["Garden", "Terrace"], "Group 2": ["Lift"]}}' ELSE '{{}}' END AS facilities_all,
           {_json_list("amenities")} AS amenities, {_json_list("badges")} AS badges, {_json_list("images")} AS images
    FROM ({ENRICHED_SQL})
"""


@query("flatten_record", FLAT_SQL)
def flatten_record(spark: SparkSession, folder: str) -> DataFrame:
    """Nested records to the flat row of 35 columns, nested values as JSON text."""
    flat = listing.flatten(enriched(spark, folder), keep=("page_id", "unit"))
    whole = {name: F.col(name).cast("bigint") for name in ("unit", "star_rating", "rooms_left")}
    return flat.withColumns(whole)


_FILLED = {
    "name": "name IS NOT NULL",
    "pricing.price_per_night_vnd": "price IS NOT NULL",
    "rating.score": "score IS NOT NULL",
    "property.availability_status": "status IS NOT NULL",
    "property.rooms_left": "rooms_left IS NOT NULL",
    "location.address": "address IS NOT NULL",
    "location.latitude": "latitude IS NOT NULL",
    "location.distance_from_center": "distance IS NOT NULL",
    "detail.description": "description IS NOT NULL",
    "detail.checkin_time": "checkin_time IS NOT NULL",
    "detail.checkout_time": "checkout_time IS NOT NULL",
    "property.room_types": "rooms > 0",
    "property.star_rating": "stars IS NOT NULL",
    "rating.review_categories": "enriched",
    "facilities.popular": "enriched",
    "images": "images <> ''",
}
#: The candidates that the 16 paths are read from.
_PROFILED_CARDS = [
    "href", "name", "address", "address_hint", "distance", "price", "rating_block", "rating_number", "rating_reader",
    "rating_visible", "stars", "sold_out", "urgency", "image",
]
_PROFILED_DETAILS = [
    "loaded", "linked_data", "latitude", "longitude", "latlng", "address", "description", "house_rules", "checkin",
    "checkout", "stars", "popular", "room_name", "room_row", "room_occupancy", "room_occupancy_text", "room_price",
    "rating_block", "rating_number", "rating_visible", "score_badge", "subscore", "price", "image",
]
RECORD_PROFILE_SQL = f"""
    WITH r AS ({ENRICHED_SQL}), p AS ({" UNION ALL ".join(
        f"SELECT '{path}' AS field, count_if({test}) AS filled, count(*) AS total FROM r" for path, test in _FILLED.items()
    )})
    SELECT field, CAST(filled AS BIGINT) AS filled, total, CAST(100 * filled // total AS BIGINT) AS percent FROM p
"""


@query("record_completeness", RECORD_PROFILE_SQL)
def record_completeness(spark: SparkSession, folder: str) -> DataFrame:
    """How many records have each of the 16 paths of the profile, counted in one pass."""
    return profile.completeness(enriched(spark, folder, _PROFILED_CARDS, _PROFILED_DETAILS))


@query(
    "enrichment_counts",
    f"""SELECT 'City ' || t AS city, CAST(0 AS BIGINT) AS page, count(*) AS rows,
               CAST(count_if(enriched) AS BIGINT) AS enriched, CAST(count_if(NOT enriched) AS BIGINT) AS failed
        FROM ({ENRICHED_SQL}) GROUP BY 1""",
)
def enrichment_counts(spark: SparkSession, folder: str) -> DataFrame:
    records = enriched(spark, folder, ["href"], ["loaded"])
    records = records.select("location.city", F.col("page").cast("bigint"), "enriched")
    return profile.partition_counts(
        records, ["city", "page"], {"enriched": F.col("enriched"), "failed": ~F.col("enriched")}
    )


@query(
    "room_table",
    f"""
    SELECT page_id, 0 AS pos, 'Double' AS name, '1 double bed' AS beds, 20 AS size_sqm, 2 AS max_guests, 'free' AS cancellation
    FROM ({ENRICHED_SQL}) WHERE enriched
    UNION ALL
    SELECT page_id, 1, 'Suite', '2 king beds', NULL, 4, NULL FROM ({ENRICHED_SQL}) WHERE enriched
    """.replace("0 AS pos", "CAST(0 AS BIGINT) AS pos").replace("20 AS size_sqm, 2 AS", "CAST(20 AS BIGINT) AS size_sqm, CAST(2 AS BIGINT) AS"),
)
def room_table(spark: SparkSession, folder: str) -> DataFrame:
    """Rooms as a child table."""
    needed = ["loaded", "room_name", "room_row", "room_occupancy", "room_occupancy_text", "room_price"]
    rooms = enriched(spark, folder, ["href"], needed).select(
        "page_id", F.posexplode("property.room_types").alias("pos", "room")
    )
    return rooms.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "room.name", "room.beds",
        F.col("room.size_sqm").cast("bigint").alias("size_sqm"),
        F.col("room.max_guests").cast("bigint").alias("max_guests"), "room.cancellation",
    )


PLACES_SQL = """
    SELECT 'stay-' || c_custkey AS hotel_id, pos, name, distance_km, type FROM (
        SELECT c_custkey, CAST(0 AS BIGINT) AS pos, 'North Beach ' || (c_custkey % 10) || '00 m' AS name,
               CAST((c_custkey % 10) / 10.0 AS DOUBLE) AS distance_km, 'beach' AS type
        FROM customer WHERE c_mktsegment <> 'MACHINERY'
        UNION ALL
        SELECT c_custkey, 1, 'Night market 1.' || (c_custkey % 9 + 1) || ' km', CAST(1 + (c_custkey % 9 + 1) / 10.0 AS DOUBLE), 'attraction'
        FROM customer WHERE c_mktsegment <> 'MACHINERY'
        UNION ALL
        SELECT c_custkey, 2, 'Old hall ' || (c_custkey % 9 + 1) || ' miles',
               CAST(format('{:.2f}', (c_custkey % 9 + 1) * CAST(1.609 AS DOUBLE)) AS DOUBLE), 'other'
        FROM customer WHERE c_mktsegment <> 'MACHINERY')
"""


def _places(spark: SparkSession, folder: str) -> DataFrame:
    found = listing.extract_details(detail_pages(spark, folder), only=["loaded", "place"])
    return listing.child_places(listing.detail_records(found, only=["places"]))


@query("places_table", PLACES_SQL)
def places_table(spark: SparkSession, folder: str) -> DataFrame:
    """Nearby places of the detail pages as a child table."""
    return _places(spark, folder).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "search_near_place",
    f"""
    SELECT page_id, hotel_id, CAST(score AS DOUBLE) AS score, price FROM ({CARDS_SQL})
    WHERE score >= 5 AND hotel_id IN (SELECT hotel_id FROM ({PLACES_SQL}) WHERE type = 'beach' AND distance_km <= 0.3)
    ORDER BY score DESC, price, page_id LIMIT 40
    """,
)
def search_near_place(spark: SparkSession, folder: str) -> DataFrame:
    """Well rated cards within 300 m of a beach, best first, then cheapest."""
    needed = ["href", "price", "rating_block", "rating_number", "rating_reader", "rating_visible"]
    cards = listing.card_records(_cards(spark, folder, needed)).select(
        "page_id", "hotel_id", F.col("rating.score").alias("score"),
        F.col("pricing.price_per_night_vnd").alias("price"),
    )
    near = gold.near_place(cards, _places(spark, folder), "beach", 0.3)
    order = [F.desc("score"), F.asc_nulls_last("price"), F.col("page_id")]
    return gold.search(near, [F.col("score") >= 5], order, 40).select("page_id", "hotel_id", "score", "price")


@query(
    "child_gold_tables",
    f"""
    WITH r AS (SELECT hotel_id, CAST(make_date(year(o_orderdate), 1, 1) AS VARCHAR) AS day,
                      max(enriched) AS enriched, max(t) FILTER (enriched) AS t, any_value(amenities) AS amenities
               FROM ({ENRICHED_SQL}) WHERE hotel_id LIKE 'stay-%' GROUP BY 1, 2),
    c AS (SELECT 'stay-' || c_custkey AS hotel_id, c_custkey % 10 AS t, c_custkey, lower(c_mktsegment) AS segment
          FROM customer WHERE c_mktsegment <> 'MACHINERY')
    SELECT 'room' AS kind, hotel_id, day, name AS key, CAST(value AS DOUBLE) AS value
    FROM r JOIN c USING (hotel_id), (VALUES ('Double'), ('Suite')) AS n(name),
         LATERAL (SELECT CASE WHEN name = 'Double' THEN nullif(c_custkey * 1000, 0) END AS value)
    UNION ALL
    SELECT 'review', hotel_id, day, name, CASE WHEN name = 'staff' THEN 9 + c.t / 10.0 ELSE 8 END
    FROM r JOIN c USING (hotel_id), (VALUES ('staff'), ('location')) AS n(name)
    UNION ALL
    SELECT 'amenity', hotel_id, day, unnest(['free_cancellation', 'free_breakfast', 'free_wifi', segment]), NULL
    FROM r JOIN c USING (hotel_id)
    """,
)
def child_gold_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rooms, amenities and review categories of the merged silver rows of detailed listings."""
    home = scratch(spark, "daily")
    pages = search_pages(spark, folder).unionByName(detail_pages(spark, folder))
    daily.run_day(spark, pages, f"{home}/bronze", f"{home}/silver", batch_id=1)
    rows = layers.read_layer(spark, f"{home}/silver", daily.SILVER)
    rows = rows.where(F.size("room_types") > 0)
    day = F.col("scrape_date").cast("string").alias("day")

    def part(frame: DataFrame, kind: str, key: str, value: Column) -> DataFrame:
        return frame.select(
            F.lit(kind).alias("kind"), "hotel_id", day, F.col(key).alias("key"), value.cast("double").alias("value")
        )

    return (
        part(listing.child_rooms(rows), "room", "name", F.col("price_vnd"))
        .unionByName(part(listing.child_amenities(rows), "amenity", "amenity", F.lit(None)))
        .unionByName(part(listing.child_review_categories(rows), "review", "category", F.col("score")))
    )


@query(
    "daily_two_batches",
    f"""
    SELECT hotel_id, CAST(make_date(year(o_orderdate), 1, 1) AS VARCHAR) AS scrape_date,
           arg_max(price, n) FILTER (price IS NOT NULL) AS price, arg_max(status, n) AS status
    FROM (SELECT *, row_number() OVER (ORDER BY page_id < (SELECT avg(o_orderkey) FROM orders), page_id) AS n
          FROM ({ENRICHED_SQL}) WHERE unit = 0) GROUP BY 1, 2
    """,
)
def daily_two_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of one run of pages: in the second the pages with smaller ids, which count as later.

    Page ids fall over the batches, so only the order of arrival gives the right price.
    """
    home = scratch(spark, "daily")
    details = detail_pages(spark, folder)
    pages = search_pages(spark, folder)
    middle = pages.select(F.expr("avg(page_id)")).scalar()
    for number, late in enumerate((False, True), 1):
        batch = pages.where((F.col("page_id") < middle) == F.lit(late))
        daily.run_day(spark, batch.unionByName(details), f"{home}/bronze", f"{home}/silver", number)
    silver = layers.read_layer(spark, f"{home}/silver", daily.SILVER)
    return silver.where(F.col("hotel_id").startswith("stay-")).select(
        "hotel_id", F.col("scrape_date").cast("string").alias("scrape_date"),
        F.col("price_per_night_vnd").alias("price"), F.col("availability_status").alias("status"),
    )


@query(
    "daily_silver",
    f"""
    WITH r AS (SELECT *, CAST(make_date(year(o_orderdate), 1, 1) AS VARCHAR) AS day,
                      row_number() OVER (PARTITION BY hotel_id, year(o_orderdate) ORDER BY page_id, unit) AS n
               FROM ({ENRICHED_SQL}))
    SELECT hotel_id, day AS scrape_date, arg_max(price, n) AS price, arg_max(status, n) AS status,
           coalesce(arg_max(address, length(address) * 1000000 - n) FILTER (length(address) >= 20),
                    arg_max(address, n)) AS address,
           CAST(max(rooms) AS BIGINT) AS rooms, arg_min('2024-05-01T08:00:00.' || t || '00001', n) AS scraped_at
    FROM r GROUP BY hotel_id, day
    """,
)
def daily_silver(spark: SparkSession, folder: str) -> DataFrame:
    """The daily run: pages to bronze to merged silver, read back."""
    home = scratch(spark, "daily")
    pages = search_pages(spark, folder).unionByName(detail_pages(spark, folder))
    daily.run_day(spark, pages, f"{home}/bronze", f"{home}/silver", batch_id=1)
    silver = layers.read_layer(spark, f"{home}/silver", daily.SILVER)
    return silver.select(
        "hotel_id",
        F.col("scrape_date").cast("string").alias("scrape_date"),
        F.col("price_per_night_vnd").alias("price"),
        F.col("availability_status").alias("status"),
        "address",
        F.coalesce(F.size("room_types"), F.lit(0)).cast("bigint").alias("rooms"),
        "scraped_at",
    )


@query(
    "rejected_pages",
    """
    WITH t AS (SELECT page_id, lower(url || ' ' || regexp_extract(html, '<title>([^<]*)</title>', 1)) AS x FROM pages)
    SELECT page_id, CASE WHEN regexp_matches(x, 'captcha|robot|blocked|access denied|403|unusual traffic')
                         THEN 'blocked' ELSE 'no cards' END AS reason
    FROM t
    UNION ALL
    SELECT o_orderkey, 'blocked' FROM orders WHERE o_orderpriority = '1-URGENT' OR CAST(o_orderkey AS VARCHAR) LIKE '%403%'
    """,
)
def rejected_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages to look at: block notices and pages without a known card."""
    real = dealt(table(spark, folder, "pages"), PAGES).select("page_id", "url", "html", F.lit(0).alias("origin"))
    made = search_pages(spark, folder).select("page_id", "url", "html", F.lit(1).alias("origin"))
    results = []
    for pages in (real, made):
        rejected = listing.rejected_pages(pages)
        results.append(rejected.select("page_id", "reason"))
    return results[0].unionByName(results[1])


@query(
    "card_dumps",
    """
    SELECT page_id, 0 AS origin, false AS has_card, md5(html) AS digest, CAST(NULL AS VARCHAR) AS first_line FROM pages
    UNION ALL
    SELECT o_orderkey, 1, true, NULL, 'Stay & More ' || o_custkey FROM orders
    """,
)
def card_dumps(spark: SparkSession, folder: str) -> DataFrame:
    """The first card of every page for diagnosis: its text, and its HTML, or the page's where it has no card."""
    real = dealt(table(spark, folder, "pages"), PAGES).select("page_id", "url", "html", F.lit(0).alias("origin"))
    made = search_pages(spark, folder).select("page_id", "url", "html", F.lit(1).alias("origin"))
    dumps = listing.card_dumps(real.unionByName(made))
    whole = F.col("html").startswith("<div data-testid='property-card'>") & F.col("html").endswith("b.jpg'></div>")
    return dumps.select(
        "page_id", "origin", "has_card",
        # A made page's card is known but for its numbers; anything else shows as a digest.
        F.when(~(F.col("has_card") & whole), F.md5("html")).alias("digest"),
        F.split("text", "\n")[0].alias("first_line"),
    )
