"""URLs, ids, addresses, coordinates, property types and nearby places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions.numbers import round_half_even, trimmed_number
from roomledger.functions.text import (
    contains_any,
    first_keyword,
    first_of,
    first_text,
    group_of,
    let,
    none_if_empty,
    preferred,
    strip,
)

DEFAULT_HOST = "www.example.com"

# The parts of a linked-data blob that are read; everything else is skipped by the parser.
_ITEM = (
    "geo: STRUCT<latitude: STRING, longitude: STRING>, latitude: STRING, longitude: STRING, "
    "address: STRING, checkinTime: STRING, checkoutTime: STRING"
)
_BLOB = f"STRUCT<`@graph`: ARRAY<STRUCT<{_ITEM}>>, {_ITEM}>"
_BLOB_FIELDS = [
    "geo", "latitude", "longitude", "address", "checkinTime", "checkoutTime",
]


def canonical_url(href: Column, host: str = DEFAULT_HOST) -> Column:
    """Language-neutral URL without query, fragment and parameters, on one host.

    The address is taken apart by pattern, as a strict URL parser would refuse
    the spaces and bars that occur in page links.
    """
    path = F.regexp_extract(href, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(path, r"[\t\r\n]", "")
    path = F.regexp_replace(path, r";[^/]*$", "")
    path = F.regexp_replace(path, fixed.LANGUAGE_TAG, "$1")
    path = let(
        path, lambda p: F.when((p == "") | p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p))
    )
    return F.when(href != "", F.concat(F.lit(f"https://{host}"), path))


def slug_id(url: Column) -> Column:
    return group_of(url, fixed.SLUG_PATTERN)


def looks_like_address(text: Column) -> Column:
    low, high = fixed.ADDRESS_LENGTH
    return F.length(text).between(low, high) & text.rlike(fixed.ADDRESS_SIGNAL)


def card_address(direct: Column, hints: Column) -> Column:
    """First direct candidate, else the first hint that reads like an address."""
    return F.coalesce(
        first_text(direct),
        F.get(F.filter(hints, lambda c: looks_like_address(c["text"])), F.lit(0))["text"],
    )


def property_type(explicit: Column, hints: Column) -> Column:
    """Explicit badge if short enough, else the first list word in a short hint text."""

    def classify(c: Column) -> Column:
        words = {word: [word] for word in fixed.PROPERTY_TYPES}
        short = (c["text"] != "") & (F.length(c["text"]) <= fixed.TYPE_LENGTH)
        return F.when(short, first_keyword(c["text"], words))

    return let(
        first_text(explicit),
        lambda badge: F.when(F.length(badge) <= fixed.TYPE_LENGTH, badge).otherwise(
            F.initcap(first_of(hints, classify))
        ),
    )


def linked_items(blobs: Column) -> Column:
    """Texts of linked-data blobs to an array (one per blob) of arrays of items.

    A blob that is not valid JSON, or whose top level is not an object, gives
    no items.
    """

    def of_blob(blob: Column) -> Column:
        whole = F.array(F.struct(*[blob[name].alias(name) for name in _BLOB_FIELDS]))
        return F.coalesce(blob["@graph"], whole)

    def items(text: Column) -> Column:
        blob = F.from_json(text, _BLOB, {"allowSingleQuotes": "false"})
        return F.when(F.ltrim(text).startswith("{"), let(blob, of_blob))

    return F.filter(F.transform(blobs, items), lambda a: a.isNotNull())


def _truthy(number: Column) -> Column:
    """Text of a JSON number, null if empty or zero."""
    zero = F.coalesce(number.try_cast("double") == 0, F.lit(False))
    return F.when((number != "") & ~zero, number)


def coordinates(
    items: Column, meta_latitude: Column, meta_longitude: Column, pair: Column
) -> Column:
    """struct(latitude, longitude) from linked data, then meta tags, then a "lat,lon" text."""

    def position(item: Column) -> Column:
        lat = F.coalesce(_truthy(item["geo"]["latitude"]), _truthy(item["latitude"]))
        lon = F.coalesce(_truthy(item["geo"]["longitude"]), _truthy(item["longitude"]))
        return complete(lat, lon)

    def complete(lat: Column, lon: Column) -> Column:
        return let(
            F.struct(lat.alias("latitude"), lon.alias("longitude")),
            lambda p: F.when(p["latitude"].isNotNull() & p["longitude"].isNotNull(), p),
        )

    def both(a: Column, b: Column) -> Column:
        return complete(trimmed_number(a), trimmed_number(b))

    def in_blob(blob: Column) -> Column:
        return let(
            first_of(blob, position), lambda found: both(found["latitude"], found["longitude"])
        )

    def in_pair(parts: Column) -> Column:
        return F.when(F.size(parts) > 1, both(F.get(parts, F.lit(0)), F.get(parts, F.lit(1))))

    return F.coalesce(
        first_of(items, in_blob),
        both(none_if_empty(meta_latitude), none_if_empty(meta_longitude)),
        let(F.split(pair, ","), in_pair),
        F.struct(
            F.lit(None).cast("double").alias("latitude"),
            F.lit(None).cast("double").alias("longitude"),
        ),
    )


def linked_address(items: Column) -> Column:
    """struct(street, locality) of the first item with a street or a plain address text."""

    def address(item: Column) -> Column:
        return let(
            let(strip(item["address"]), parts), lambda a: F.when(a["street"] != "", a)
        )

    def parts(raw: Column) -> Column:
        nested = raw.startswith("{")
        street = F.when(nested, F.get_json_object(raw, "$.streetAddress")).otherwise(raw)
        locality = F.when(nested, F.get_json_object(raw, "$.addressLocality"))
        return F.struct(
            strip(street).alias("street"), none_if_empty(strip(locality)).alias("locality")
        )

    return first_of(F.flatten(items), address)


def nearby_place(text: Column) -> Column:
    """struct(name, distance_km, type) of one place text."""
    amount = F.struct(
        group_of(text, fixed.PLACE_DISTANCE).try_cast("double").alias("n"),
        F.lower(F.regexp_extract(text, fixed.PLACE_DISTANCE, 2)).alias("unit"),
    )

    def kilometres(a: Column) -> Column:
        scaled = F.when(a["unit"] == "m", a["n"] / 1000).otherwise(a["n"] * fixed.KM_PER_MILE)
        return F.when(a["unit"] == "km", a["n"]).otherwise(round_half_even(scaled, 2))

    kind = F.coalesce(first_keyword(text, fixed.PLACE_KEYWORDS), F.lit("other"))
    return F.struct(
        text.alias("name"), let(amount, kilometres).alias("distance_km"), kind.alias("type")
    )


def nearby_places(candidates: Column, cap: int = fixed.PLACE_CAP) -> Column:
    """Places of the first matcher with any usable text; only its first elements count."""
    cut = F.filter(candidates, lambda c: c["grp"] < cap)
    usable = F.filter(
        cut, lambda c: (c["text"] != "") & (F.length(c["text"]) <= fixed.PLACE_LENGTH)
    )
    return F.transform(let(usable, preferred), lambda c: nearby_place(c["text"]))


def is_blocked(title: Column, url: Column) -> Column:
    """Pages that answer with a block notice instead of content."""
    return F.coalesce(contains_any(F.lower(title), fixed.BLOCK_SIGNALS), F.lit(False)) | F.coalesce(
        contains_any(F.lower(url), fixed.BLOCK_SIGNALS), F.lit(False)
    )
