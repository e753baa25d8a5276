"""Stored pages to nested records, detail enrichment, and the flat row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger import fixed_values as fixed
from roomledger.functions import lists, places
from roomledger.functions.jsontext import json_text
from roomledger.functions.text import built_once, leading_text
from roomledger.plans import silver
from roomledger.schema import RECORD, ROOM
from roomledger.sources.html import Rule, extract
from roomledger.sources.matchers import card_rules, detail_rules


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _empty(kind: str) -> Column:
    if kind.startswith("map"):
        key, value = kind[4:-1].split(",", 1)
        return F.map_from_entries(F.array().cast(f"array<struct<k:{key},v:{value}>>"))
    return F.array().cast(kind)


def _notice(title: str | None, url: str | None) -> bool:
    """`places.is_blocked` where the pages are read."""
    return any(signal in text.lower() for text in (title, url) if text for signal in fixed.BLOCK_SIGNALS)


def extract_cards(
    search_pages: DataFrame, link_host: str | None = None, only: Sequence[str] | None = None, blocked: bool = True
) -> DataFrame:
    """A row per card of each search page; a page without cards keeps one row, unit null.

    With `only` other fields than these are not looked for. Without `blocked` the cards of block notices are not
    looked for either, which `usable_cards` drops: such a page keeps one row.
    """
    unless = None if blocked else _notice
    return extract(search_pages, card_rules(link_host), fixed.CARD_CONTAINERS, only=only, unless=unless)


def usable_cards(cards: DataFrame) -> DataFrame:
    """Cards of pages that are not a block notice."""
    blocked = places.is_blocked(F.col("page_title"), F.col("url"))
    return cards.where(F.col("unit").isNotNull() & ~blocked)


def rejected_pages(search_pages: DataFrame) -> DataFrame:
    """Pages for inspection, with their HTML: block notices, pages without any known card,
    empty pages among them, and pages that could not be read.

    One pass over the pages that only looks for the cards; nothing is joined.
    """
    found = extract(search_pages, [], fixed.CARD_CONTAINERS, keep_html=True)
    blocked = places.is_blocked(F.col("page_title"), F.col("url"))
    reason = (
        F.when(F.col("page_error").isNotNull(), F.concat(F.lit("unreadable: "), "page_error"))
        .when(blocked, F.lit("blocked"))
        .when(F.col("unit").isNull(), F.lit("no cards"))
    )
    firsts = found.where(F.col("unit").isNull() | (F.col("unit") == 0))
    rejected = firsts.withColumn("reason", reason).where(F.col("reason").isNotNull())
    return rejected.select(*search_pages.columns, "reason")


def card_dumps(search_pages: DataFrame) -> DataFrame:
    """What to look at when matchers fail: a row per page, with the HTML and the text of its first card.

    The card is the first match of the first container with any, as in extraction. A page without one
    keeps its whole HTML and has no text; `has_card` tells them apart.
    """
    rules = [
        Rule(field, container, take=take, first=True)
        for container in fixed.CARD_CONTAINERS
        for field, take in (("card_html", "html"), ("card_text", "text"))
    ]
    found = extract(search_pages, rules, keep_html=True)
    return found.withColumns({
        "has_card": F.size("card_html") > 0,
        "card_html": leading_text(F.col("card_html")),
        "card_text": leading_text(F.col("card_text")),
    }).select(
        *[c for c in search_pages.columns if c != "html"], "has_card",
        F.when(F.col("has_card"), F.col("card_html")).otherwise(F.col("html")).alias("html"),
        F.when(F.col("has_card"), F.col("card_text")).alias("text"),
    )


def card_records(
    cards: DataFrame, host: str = places.DEFAULT_HOST, country: str = fixed.COUNTRY
) -> DataFrame:
    """Nested records of cards, every field parsed by itself with null-safe expressions.

    Keeps the columns in front of the candidates (page key, city, dates).
    """
    cards = silver.standardise_prices(cards)
    cards = silver.standardise_ratings(cards)
    cards = silver.standardise_availability(cards)
    cards = silver.standardise_identity_and_place(cards, host=host)
    cards = silver.standardise_lists(cards)
    return cards.select(*_record(country))


@built_once
def _record(country: str) -> list[Column | str]:
    return [
        "page_id",
        "unit",
        "page",
        "scrape_date",
        F.col("fetched_at").alias("scraped_at"),
        "hotel_id",
        F.col("listing_name").alias("name"),
        F.col("canonical_url").alias("url"),
        F.struct(
            F.col("street_address").alias("address"),
            F.col("city"),
            F.lit(country).alias("country"),
            F.col("distance_text").alias("distance_from_center"),
            _null("double").alias("latitude"),
            _null("double").alias("longitude"),
        ).alias("location"),
        F.struct(
            _null("string").alias("description"),
            _null("string").alias("checkin_time"),
            _null("string").alias("checkout_time"),
            _empty("array<string>").alias("languages"),
        ).alias("detail"),
        F.struct(
            F.col("current_price").alias("price_per_night_vnd"),
            F.col("original_price").alias("original_price_vnd"),
            F.col("discount_pct"),
            F.lit(fixed.CURRENCY).alias("currency"),
            F.col("taxes_included"),
            _null("string").alias("taxes_fees_text"),
            _null("string").alias("meal_plan"),
        ).alias("pricing"),
        F.struct(
            F.col("rating_score").alias("score"),
            F.col("rating_label").alias("label"),
            F.col("review_count"),
            _empty("map<string,double>").alias("review_categories"),
        ).alias("rating"),
        F.struct(
            F.col("property_type").alias("type"),
            F.col("star_rating"),
            F.col("availability_status"),
            F.col("rooms_left"),
            _empty(f"array<{ROOM.simpleString()}>").alias("room_types"),
        ).alias("property"),
        F.struct(
            _empty("array<string>").alias("popular"),
            _empty("map<string,array<string>>").alias("all"),
        ).alias("facilities"),
        "badges",
        "amenities",
        "images",
    ]


def extract_details(detail_pages: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    return extract(detail_pages, detail_rules(), only=only)


def detail_records(
    details: DataFrame, host: str = places.DEFAULT_HOST, only: Sequence[str] | None = None
) -> DataFrame:
    """Typed fields of loaded detail pages, keyed by canonical url; with `only` just these fields.

    Of several pages with one url the last fetched counts, so the enrichment
    join cannot multiply cards.
    """
    details = details.where(F.get("loaded", F.lit(0))["text"] != "#0")
    details = silver.with_linked_items(details)
    details = silver.standardise_prices(details, silver.DETAIL)
    details = silver.standardise_ratings(details, silver.DETAIL)
    details = silver.standardise_availability(details, silver.DETAIL)
    details = silver.standardise_identity_and_place(details, silver.DETAIL, host)
    details = silver.standardise_lists(details, silver.DETAIL)
    values = details.select(*_detail())
    if only is not None:
        # A struct is kept whole by the aggregate, so fields that nobody reads would still be worked out.
        values = values.select("url", "_age", F.struct(*[F.col("d")[name].alias(name) for name in only]).alias("d"))
    return values.groupBy("url").agg(F.max_by("d", "_age").alias("d"))


@built_once
def _detail() -> list[Column]:
    return [
        F.col("canonical_url").alias("url"),
        F.struct("fetched_at", "page_id").alias("_age"),
        F.struct(
            F.col("position_latitude").alias("latitude"),
            F.col("position_longitude").alias("longitude"),
            F.col("street_address").alias("address"),
            F.col("description_text").alias("description"),
            F.col("checkin_time"),
            F.col("checkout_time"),
            F.col("languages"),
            F.col("property_type").alias("type"),
            F.col("star_rating"),
            F.col("popular_facilities").alias("popular"),
            F.col("all_facilities").alias("all"),
            F.col("room_types"),
            F.struct(
                F.col("current_price").alias("price_per_night_vnd"),
                F.col("original_price").alias("original_price_vnd"),
                F.col("discount_pct"),
                F.lit(fixed.CURRENCY).alias("currency"),
                F.col("taxes_included"),
                F.col("taxes_text").alias("taxes_fees_text"),
                F.col("meal_plan_text").alias("meal_plan"),
            ).alias("pricing"),
            F.col("rating_score").alias("score"),
            F.col("rating_label").alias("label"),
            F.col("review_count"),
            F.col("review_categories"),
            F.col("images"),
            F.col("places"),
        ).alias("d"),
    ]


def _prefer(new: Column, old: Column) -> Column:
    """The new text unless it is null or empty."""
    return F.coalesce(F.nullif(new, F.lit("")), old)


def enrich(
    cards: DataFrame, details: DataFrame, row_key: tuple[str, ...] = ("page_id", "unit")
) -> DataFrame:
    """Left join of cards with detail records and the precedence of each field.

    A card without detail page keeps its values; with one, some fields are
    overwritten even by nulls, others only by a value. Cards without url match
    nothing; they join on their row key, so that they do not meet in one task.
    """
    apart = F.concat_ws(":", F.lit("none"), *[F.col(c).cast("string") for c in row_key])
    keyed = cards.withColumn("_key", F.coalesce(F.nullif("url", F.lit("")), apart))
    joined = keyed.join(details.withColumnRenamed("url", "_key"), "_key", "left").drop("_key")
    return joined.withColumns(_preferred()).drop("d")


@built_once
def _preferred() -> dict[str, Column]:
    """The fields of a card with those of its detail page `d`."""
    d, found = F.col("d"), F.col("d").isNotNull()

    def overwrite(name: str, old: str) -> Column:
        return F.when(found, d[name]).otherwise(F.col(old))

    prices = d["pricing"]["price_per_night_vnd"].isNotNull()
    pricing = F.when(prices, d["pricing"]).otherwise(
        F.col("pricing").withField(
            "taxes_fees_text",
            _prefer(d["pricing"]["taxes_fees_text"], F.col("pricing.taxes_fees_text")),
        )
    )
    return {
        "location": F.col("location")
        .withField("latitude", overwrite("latitude", "location.latitude"))
        .withField("longitude", overwrite("longitude", "location.longitude"))
        .withField("address", _prefer(d["address"], F.col("location.address"))),
        "detail": F.struct(
            overwrite("description", "detail.description").alias("description"),
            overwrite("checkin_time", "detail.checkin_time").alias("checkin_time"),
            overwrite("checkout_time", "detail.checkout_time").alias("checkout_time"),
            overwrite("languages", "detail.languages").alias("languages"),
        ),
        "pricing": pricing,
        "rating": F.struct(
            F.coalesce(d["score"], F.col("rating.score")).alias("score"),
            _prefer(d["label"], F.col("rating.label")).alias("label"),
            F.coalesce(d["review_count"], F.col("rating.review_count")).alias("review_count"),
            overwrite("review_categories", "rating.review_categories").alias("review_categories"),
        ),
        "property": F.col("property")
        .withField("type", _prefer(d["type"], F.col("property.type")))
        .withField("star_rating", F.coalesce(d["star_rating"], F.col("property.star_rating")))
        .withField("room_types", overwrite("room_types", "property.room_types")),
        "facilities": F.struct(
            overwrite("popular", "facilities.popular").alias("popular"),
            overwrite("all", "facilities.all").alias("all"),
        ),
        "amenities": F.when(found, lists.merged_tags(F.col("amenities"), d["popular"])).otherwise(
            F.col("amenities")
        ),
        "images": F.when(F.size(d["images"]) > 0, d["images"]).otherwise(F.col("images")),
        "enriched": found,
    }


# flat column -> path in the nested record
FLAT_PATHS = {
    "city": "location.city",
    "country": "location.country",
    "address": "location.address",
    "distance_from_center": "location.distance_from_center",
    "latitude": "location.latitude",
    "longitude": "location.longitude",
    "price_per_night_vnd": "pricing.price_per_night_vnd",
    "original_price_vnd": "pricing.original_price_vnd",
    "discount_pct": "pricing.discount_pct",
    "currency": "pricing.currency",
    "taxes_included": "pricing.taxes_included",
    "taxes_fees_text": "pricing.taxes_fees_text",
    "rating_score": "rating.score",
    "rating_label": "rating.label",
    "review_count": "rating.review_count",
    "review_categories": "rating.review_categories",
    "property_type": "property.type",
    "star_rating": "property.star_rating",
    "availability_status": "property.availability_status",
    "rooms_left": "property.rooms_left",
    "room_types": "property.room_types",
    "checkin_time": "detail.checkin_time",
    "checkout_time": "detail.checkout_time",
    "languages": "detail.languages",
    "description": "detail.description",
    "facilities_popular": "facilities.popular",
    "facilities_all": "facilities.all",
}


def kind_of(column: str) -> T.DataType:
    """Type of a flat column before it is written as text."""
    kind: T.DataType = RECORD
    for name in FLAT_PATHS.get(column, column).split("."):
        kind = kind[name].dataType
    return kind


def flatten(records: DataFrame, as_text: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested records to the flat columns, in order; nested values as JSON text or as they are."""
    return records.select(*_flat(as_text), *keep)


@built_once
def _flat(as_text: bool) -> list[Column]:
    columns = []
    for name in fixed.FLAT_COLUMNS:
        if name == "scrape_date":
            columns.append(F.col(name).cast("string").alias(name) if as_text else F.col(name))
            continue
        path = FLAT_PATHS.get(name, name)
        kind = kind_of(name)
        value = F.col(path)
        if as_text and isinstance(kind, (T.ArrayType, T.MapType)):
            value = F.when(value.isNotNull(), json_text(value, kind))
        columns.append(value.alias(name))
    return columns


def child_rooms(silver_rows: DataFrame) -> DataFrame:
    """Gold child table: one row per room of a listing and day."""
    return silver_rows.select(
        "hotel_id", "scrape_date", F.posexplode("room_types").alias("pos", "room")
    ).select("hotel_id", "scrape_date", "pos", "room.*")


def child_places(details: DataFrame) -> DataFrame:
    """Gold child table: one row per nearby place of a detail page, for searches by kind and distance."""
    return details.select(
        places.slug_id(F.col("url")).alias("hotel_id"), F.posexplode("d.places").alias("pos", "place")
    ).select("hotel_id", "pos", "place.name", "place.distance_km", "place.type")


def child_amenities(silver_rows: DataFrame) -> DataFrame:
    return silver_rows.select("hotel_id", "scrape_date", F.explode("amenities").alias("amenity"))


def child_review_categories(silver_rows: DataFrame) -> DataFrame:
    return silver_rows.select(
        "hotel_id", "scrape_date", F.explode("review_categories").alias("category", "score")
    )
