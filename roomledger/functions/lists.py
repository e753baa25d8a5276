"""Lists of a listing: badges, tags, images, facilities, rooms, times and availability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions.numbers import price, rooms_left, stars, time_of_day
from roomledger.functions.text import (
    contains_any,
    distinct_by_text,
    first_group_texts,
    first_of,
    first_text,
    group_of,
    let,
    lines_of,
    none_if_empty,
    preferred,
    strip,
)

_INT_MAX = 2147483647


def is_badge(text: Column) -> Column:
    return (
        (text != "")
        & (F.length(text) < fixed.BADGE_LENGTH)
        & ~text.rlike(fixed.BADGE_JUNK)
        & text.rlike(fixed.BADGE_SIGNAL)
    )


def badges(candidates: Column, cap: int = fixed.BADGE_CAP) -> Column:
    """Distinct badge texts; matchers after the one that reaches the cap are not used."""

    def within_cap(kept: Column) -> Column:
        last = F.coalesce(F.get(kept, F.lit(cap - 1))["prio"], F.lit(_INT_MAX))
        return let(last, lambda prio: F.filter(kept, lambda c: c["prio"] <= prio))

    kept = distinct_by_text(F.filter(candidates, lambda c: is_badge(c["text"])))
    return F.transform(let(kept, within_cap), lambda c: c["text"])


def merged_tags(tags: Column, popular: Column) -> Column:
    """Sorted union of tags and popular facilities written as keys."""
    short = F.filter(popular, lambda p: F.length(p) < fixed.AMENITY_SOURCE_LENGTH)
    keys = F.transform(short, lambda p: F.replace(F.lower(p), F.lit(" "), F.lit("_")))
    return F.when(
        F.size(popular) > 0,
        F.array_sort(F.array_union(F.coalesce(tags, F.array().cast("array<string>")), keys)),
    ).otherwise(tags)


def languages(candidates: Column) -> Column:
    return _or_empty(first_group_texts(candidates, lambda t: F.lit(True)))


def popular_facilities(candidates: Column) -> Column:
    return _or_empty(
        first_group_texts(candidates, lambda t: F.length(t) < fixed.POPULAR_LENGTH)
    )


def _or_empty(texts: Column) -> Column:
    return F.coalesce(texts, F.array().cast("array<string>"))


def facility_map(headings: Column, items: Column) -> Column:
    """Grouped facilities as MAP<heading, items>.

    Items equal to their heading are dropped and repeats kept, a group without
    heading is named by its number, a repeated heading keeps its last non-empty
    group, and empty groups are left out.
    """
    groups = F.array_sort(F.array_distinct(F.transform(items, lambda i: i["grp"])))

    def entry(group: Column) -> Column:
        heading = F.get(F.filter(headings, lambda h: h["grp"] == group), F.lit(0))["text"]
        named = F.coalesce(heading, F.concat(F.lit("Group "), (group + 1).cast("string")))

        def filled(name: Column) -> Column:
            texts = F.filter(
                items,
                lambda i: (i["grp"] == group)
                & (i["text"] != "")
                & (F.length(i["text"]) < fixed.FACILITY_LENGTH)
                & (i["text"] != name),
            )
            return F.struct(
                name.alias("key"), F.transform(texts, lambda i: i["text"]).alias("value")
            )

        return let(named, filled)

    def lasts(entries: Column) -> Column:
        names = F.transform(entries, lambda e: e["key"])
        return let(
            names,
            lambda all_names: F.filter(
                entries,
                lambda e, i: ~F.array_contains(F.slice(all_names, i + 2, F.size(all_names)), e["key"]),
            ),
        )

    entries = F.filter(F.transform(groups, entry), lambda e: F.size(e["value"]) > 0)
    empty = F.map_from_entries(F.array().cast("array<struct<key:string,value:array<string>>>"))
    return F.coalesce(F.map_from_entries(let(entries, lasts)), empty)


def room(name: Column, row: Column, occupancy: Column, amount: Column) -> Column:
    """One room from its name, row text, occupancy text and price text."""

    def read(text: Column) -> Column:
        in_text = F.coalesce(
            group_of(text, fixed.ROOM_GUESTS).try_cast("int"),
            group_of(text, fixed.ROOM_TIMES).try_cast("int"),
        )
        guests = let(
            occupancy, lambda o: F.when(o != "", o.try_cast("int")).otherwise(in_text)
        )
        cancellation = (
            F.when(text.contains("free cancellation"), F.lit("free"))
            .when(contains_any(text, ["non-refundable", "no refund"]), F.lit("non_refundable"))
            .when(text.contains("partially refundable"), F.lit("partial"))
        )
        return F.struct(
            name.alias("name"),
            strip(group_of(text, fixed.ROOM_BEDS)).alias("beds"),
            group_of(text, fixed.ROOM_SIZE).try_cast("int").alias("size_sqm"),
            guests.alias("max_guests"),
            price(amount).alias("price_vnd"),
            cancellation.alias("cancellation"),
        )

    return let(F.lower(row), read)


def rooms(
    names: Column,
    rows: Column,
    occupancy_attribute: Column,
    occupancy_text: Column,
    amounts: Column,
    cap: int = fixed.ROOM_CAP,
) -> Column:
    """Rooms of the first matcher that yields one.

    Only the first elements of a matcher are looked at, and names are made
    distinct inside that cut.
    """
    cut = F.filter(names, lambda c: (c["grp"] < cap) & (c["text"] != ""))
    chosen = distinct_by_text(let(cut, preferred))

    def beside(candidates: Column, of: Column) -> Column:
        same = F.filter(
            candidates, lambda c: (c["prio"] == of["prio"]) & (c["grp"] == of["grp"])
        )
        return F.get(same, F.lit(0))["text"]

    def build(c: Column) -> Column:
        occupancy = F.coalesce(
            none_if_empty(beside(occupancy_attribute, c)),
            group_of(beside(occupancy_text, c), r"(?U)(\d+)"),
        )
        return room(c["text"], beside(rows, c), occupancy, beside(amounts, c))

    return F.transform(chosen, build)


def image_list(
    candidates: Column,
    cap: int = fixed.DETAIL_IMAGE_CAP,
    full_size: str | None = fixed.IMAGE_FULL_SIZE,
    per_matcher: int | None = None,
) -> Column:
    """Distinct http(s) image addresses, thumbnails rewritten to the full size."""
    if per_matcher is not None:
        candidates = F.filter(candidates, lambda c: c["grp"] < per_matcher)
    linked = F.filter(candidates, lambda c: c["text"].startswith("http"))

    def rewrite(address: Column) -> Column:
        if full_size is None:
            return address
        for token in fixed.IMAGE_SIZES:
            address = F.regexp_replace(address, token, full_size)
        return address

    return F.slice(F.array_distinct(F.transform(linked, lambda c: rewrite(c["text"]))), 1, cap)


def card_images(candidates: Column) -> Column:
    cap = fixed.CARD_IMAGE_CAP
    return image_list(candidates, cap=cap, full_size=None, per_matcher=cap)


def star_candidates(candidates: Column) -> Column:
    """First candidate that reads as 1 to 5 stars; "#n" is a number of star elements."""

    def read(c: Column) -> Column:
        count = F.when(
            c["text"].startswith("#"), F.substring(c["text"], 2, 9).try_cast("int")
        )
        return stars(c["text"], count)

    return first_of(candidates, read)


def availability(sold_out: Column, message: Column) -> Column:
    """struct(status, rooms_left) from a sold-out mark and an urgency message."""

    def state(status: str, rooms: Column) -> Column:
        return F.struct(F.lit(status).alias("status"), rooms.cast("int").alias("rooms_left"))

    none = F.lit(None)

    def read(m: Column) -> Column:
        left, lowered = m["left"], m["text"]
        return (
            F.when(m["gone"], state("sold_out", none))
            .when(lowered.isNull() | (lowered == ""), state("available", none))
            .when((left == 1) | lowered.contains("last room"), state("last_room", F.lit(1)))
            .when(left.isNotNull(), state("limited", left))
            .when(contains_any(lowered, fixed.DEMAND_WORDS), state("limited", none))
            .otherwise(state("available", none))
        )

    parts = let(
        F.lower(message),
        lambda text: F.struct(
            sold_out.alias("gone"), text.alias("text"), rooms_left(text).alias("left")
        ),
    )
    return let(parts, read)


def check_time(items: Column, key: str, sections: Column, words: list[str], legacy: Column) -> Column:
    """A check-in or check-out time: linked data, then rule lines, then the old elements."""
    from_items = first_of(F.flatten(items), lambda item: time_of_day(item[key]))
    lines = F.flatten(F.transform(sections, lambda c: lines_of(c["text"])))
    from_lines = first_of(
        lines, lambda line: F.when(contains_any(F.lower(line), words), time_of_day(line))
    )
    return F.coalesce(from_items, from_lines, time_of_day(first_text(legacy)))
