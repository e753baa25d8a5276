"""The five silver jobs: candidate texts in, typed columns out.

Each job takes the rows of the extraction stage and adds columns; none of them
shuffles. ``card`` jobs read result cards, ``detail`` jobs detail pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions import lists, numbers, places, reviews, text
from roomledger.functions.text import built_once, first_of, first_text, leading_text
from roomledger.schema import ROOM

CARD, DETAIL = "card", "detail"


@built_once
def _prices(kind: str) -> tuple[dict[str, Column], dict[str, Column]]:
    struck = F.col("struck")
    if kind == CARD:
        struck = F.concat(F.col("struck_in_block"), struck)
    found = {
        "current_price": numbers.price(first_text(F.col("price"))),
        "struck_price": first_of(struck, lambda c: numbers.price(c["text"])),
        "taxes_text": first_text(F.col("taxes")),
    }
    derived = {
        "original_price": numbers.sane_original_price(F.col("struck_price"), F.col("current_price")),
        "discount_pct": numbers.discount_percent(
            F.col("struck_price"), F.col("current_price")
        ),
        "taxes_included": numbers.taxes_included(F.col("taxes_text")),
    }
    return found, derived


def standardise_prices(rows: DataFrame, kind: str = CARD) -> DataFrame:
    """Adds current_price, original_price, discount_pct, taxes_text and taxes_included."""
    found, derived = _prices(kind)
    return rows.withColumns(found).withColumns(derived).drop("struck_price")


@built_once
def _ratings(kind: str) -> tuple[dict[str, Column], dict[str, Column]]:
    block, number = F.col("rating_block"), F.col("rating_number")
    visible = F.col("rating_visible")
    if kind == CARD:
        rating = reviews.card_rating(block, number, F.col("rating_reader"), visible)
    else:
        rating = reviews.detail_rating(block, number, visible, F.col("score_badge"))
    found = {"_rating": rating, "star_rating": lists.star_candidates(F.col("stars"))}
    derived = {
        "rating_score": F.col("_rating.score"),
        "rating_label": F.col("_rating.label"),
        "review_count": F.col("_rating.review_count"),
    }
    if kind == DETAIL:
        blocks = F.filter(F.col("subscore"), lambda c: c["text"] != "")
        texts = F.transform(blocks, lambda c: c["text"])
        derived["review_categories"] = reviews.review_categories(texts)
    return found, derived


def standardise_ratings(rows: DataFrame, kind: str = CARD) -> DataFrame:
    """Adds rating_score, rating_label, review_count, star_rating and, on details, sub-scores."""
    found, derived = _ratings(kind)
    return rows.withColumns(found).withColumns(derived).drop("_rating")


@built_once
def _state() -> Column:
    return lists.availability(F.size("sold_out") > 0, first_text(F.col("urgency")))


@built_once
def _times() -> dict[str, Column]:
    rules = F.col("house_rules")

    def at(key: str, words: list[str], legacy: str) -> Column:
        return lists.check_time(F.col("_items"), key, rules, words, F.col(legacy))

    return {
        "checkin_time": at("checkinTime", ["check-in", "check in"], "checkin"),
        "checkout_time": at("checkoutTime", ["check-out", "check out"], "checkout"),
    }


def standardise_availability(rows: DataFrame, kind: str = CARD) -> DataFrame:
    """Cards: availability_status and rooms_left; details: checkin_time and checkout_time."""
    if kind == CARD:
        return (
            rows.withColumn("_state", _state())
            .withColumns(
                {
                    "availability_status": F.col("_state.status"),
                    "rooms_left": F.col("_state.rooms_left"),
                }
            )
            .drop("_state")
        )
    return with_linked_items(rows).withColumns(_times()).drop(*_own(rows))


@built_once
def _items() -> Column:
    return places.linked_items(F.transform(F.col("linked_data"), lambda c: c["text"]))


def with_linked_items(rows: DataFrame) -> DataFrame:
    """The items of the linked data, read once for the jobs that need them."""
    if "_items" in rows.columns:
        return rows
    return rows.withColumn("_items", _items())


def _own(rows: DataFrame) -> list[str]:
    return [] if "_items" in rows.columns else ["_items"]


@built_once
def _identity(kind: str, host: str) -> dict[str, Column]:
    if kind == CARD:
        return {
            "canonical_url": places.canonical_url(first_text(F.col("href")), host),
            "listing_name": first_text(F.col("name")),
            "street_address": places.card_address(F.col("address"), F.col("address_hint")),
            "distance_text": first_text(F.col("distance")),
            "property_type": places.property_type(F.col("type"), F.col("type_hint")),
        }
    kept_type = first_text(F.col("type"))
    return {
        "canonical_url": places.canonical_url(F.col("url"), host),
        "_position": places.coordinates(
            F.col("_items"),
            leading_text(F.col("latitude")),
            leading_text(F.col("longitude")),
            leading_text(F.col("latlng")),
        ),
        "street_address": F.coalesce(
            places.linked_address(F.col("_items"))["street"], first_text(F.col("address"))
        ),
        "property_type": F.when(F.length(kept_type) <= fixed.TYPE_LENGTH, kept_type),
        "places": places.nearby_places(F.col("place")),
    }


def standardise_identity_and_place(
    rows: DataFrame, kind: str = CARD, host: str = places.DEFAULT_HOST
) -> DataFrame:
    """Adds canonical_url, hotel_id, listing_name, property_type, street_address and position."""
    if kind == CARD:
        return rows.withColumns(_identity(kind, host)).withColumn(
            "hotel_id", places.slug_id(F.col("canonical_url"))
        )
    return (
        with_linked_items(rows)
        .withColumns(_identity(kind, host))
        .withColumns(
            {
                "position_latitude": F.col("_position.latitude"),
                "position_longitude": F.col("_position.longitude"),
            }
        )
        .drop("_position", *_own(rows))
    )


def standardise_lists(rows: DataFrame, kind: str = CARD) -> DataFrame:
    """Cards: badges, amenities, images; details: languages, facilities, rooms, images, texts."""
    return rows.withColumns(_lists(kind))


@built_once
def _lists(kind: str) -> dict[str, Column]:
    if kind == CARD:
        return {
            "badges": lists.badges(F.col("badge")),
            "amenities": text.keywords_found(
                F.coalesce(leading_text(F.col("card_text")), F.lit("")),
                fixed.AMENITY_PHRASES,
            ),
            "images": lists.card_images(F.col("image")),
        }
    room_list = lists.rooms(
        F.col("room_name"),
        F.col("room_row"),
        F.col("room_occupancy"),
        F.col("room_occupancy_text"),
        F.col("room_price"),
    )
    no_rooms = F.array().cast(f"array<{ROOM.simpleString()}>")
    return {
        "languages": lists.languages(F.col("language")),
        "popular_facilities": lists.popular_facilities(F.col("popular")),
        "all_facilities": lists.facility_map(
            F.col("facility_heading"), F.col("facility_item")
        ),
        "room_types": F.coalesce(room_list, no_rooms),
        "images": lists.image_list(F.col("image")),
        "description_text": text.squeeze(first_text(F.col("description"))),
        "meal_plan_text": first_text(F.col("meal_plan")),
    }
