"""Which page elements feed which field: plain tables read by the extraction stage."""

from __future__ import annotations

from dataclasses import dataclass

from roomledger import fixed_values as fixed


@dataclass(frozen=True)
class Rule:
    """Collect candidates of one field.

    ``scope`` narrows the search: each selector of the tuple is replaced by its
    first match inside the one before. With ``each`` the last scope selector
    keeps all matches, and a candidate carries the number of its scope.
    ``up`` goes from a match to its closest such ancestor and ``then`` to the
    first such element inside of that. ``take`` is "text", "count", "raw" or a
    list of attributes, the first non-empty of which counts.
    """

    field: str
    selector: str
    prio: int = 0
    take: str | tuple[str, ...] = "text"
    scope: tuple[str, ...] = ()
    each: bool = False
    first: bool = False
    up: str | None = None
    then: str | None = None


def _ordered(field: str, selectors: list[str], **options) -> list[Rule]:
    return [Rule(field, s, prio=i, **options) for i, s in enumerate(selectors)]


def _attribute(*names: str) -> tuple[str, ...]:
    return names


def _card_stars() -> list[Rule]:
    rules = []
    for container in fixed.CARD_STARS:
        steps = [(":self", _attribute("aria-label"))]
        steps += [(s, _attribute("aria-label")) for s in fixed.STAR_LABELLED]
        steps += [(fixed.STAR_TITLE, "raw")]
        steps += [(s, "count") for s in fixed.STAR_COUNTED]
        rules += [
            Rule("stars", s, prio=0, take=take, scope=(container,), first=True)
            for s, take in steps
        ]
    return [Rule(**{**r.__dict__, "prio": i}) for i, r in enumerate(rules)]


def _detail_stars() -> list[Rule]:
    rules = []
    for container in fixed.DETAIL_STARS:
        for s, take in [(":self", _attribute("aria-label")), ("span", "count")]:
            rules.append(Rule("stars", s, len(rules), take, (container,), first=True))
    rules.append(Rule("stars", fixed.DETAIL_STAR_TITLE, len(rules), "raw", first=True))
    return rules


def _rating() -> list[Rule]:
    block = (fixed.REVIEW_BLOCK,)
    return [
        Rule("rating_block", ":self", scope=block),
        Rule("rating_number", fixed.REVIEW_NUMBER, scope=block, first=True),
        Rule("rating_reader", fixed.REVIEW_READER, scope=block, first=True),
        Rule("rating_visible", "> div", scope=(*block, fixed.REVIEW_VISIBLE)),
    ]


def card_rules(link_host: str | None = None) -> list[Rule]:
    """Fields of a result card. ``link_host`` adds links to that host as a last resort."""
    hrefs = list(fixed.CARD_HREF)
    if link_host:
        hrefs.append(f"a[href*='{link_host}/hotel']")
    images = _attribute(*fixed.CARD_IMAGE_ATTRIBUTES)
    return [
        *_ordered("name", fixed.CARD_NAME),
        *_ordered("href", hrefs, take=_attribute("href")),
        *_ordered("address", fixed.CARD_ADDRESS),
        *_ordered("address_hint", fixed.CARD_ADDRESS_HINT),
        *_ordered("distance", fixed.CARD_DISTANCE),
        *_ordered("price", fixed.CARD_PRICE),
        *_ordered(
            "struck_in_block",
            fixed.CARD_STRUCK_IN_BLOCK,
            scope=(fixed.CARD_PRICE_BLOCK,),
            first=True,
        ),
        *_ordered("struck", fixed.CARD_STRUCK),
        *_ordered("taxes", fixed.CARD_TAXES),
        *_rating(),
        *_card_stars(),
        Rule("sold_out", fixed.CARD_SOLD_OUT, first=True),
        *_ordered("urgency", fixed.CARD_URGENCY),
        *_ordered("type", fixed.CARD_TYPE),
        *_ordered("type_hint", fixed.CARD_TYPE_HINT),
        *_ordered("badge", fixed.CARD_BADGES),
        Rule("card_text", ":self"),
        *_ordered("image", fixed.CARD_IMAGES, take=images),
    ]


def detail_rules() -> list[Rule]:
    """Fields of a detail page."""
    rating = [r for r in _rating() if r.field != "rating_reader"]
    group = (fixed.FACILITY_GROUP,)
    beside = {
        "room_row": {"take": "text"},
        "room_occupancy": {"take": _attribute("data-max-occupancy"), "then": fixed.ROOM_OCCUPANCY},
        "room_occupancy_text": {"take": "text", "then": fixed.ROOM_OCCUPANCY},
        "room_price": {"take": "text", "then": fixed.ROOM_PRICE},
    }
    rooms = _ordered("room_name", fixed.DETAIL_ROOMS)
    for field, options in beside.items():
        rooms += _ordered(field, fixed.DETAIL_ROOMS, up=fixed.ROOM_ROW, **options)
    return [
        Rule("loaded", fixed.DETAIL_LOADED, take="count"),
        Rule("linked_data", fixed.DETAIL_JSON, take="raw"),
        Rule("latitude", fixed.DETAIL_LATITUDE, take=_attribute("content"), first=True),
        Rule("longitude", fixed.DETAIL_LONGITUDE, take=_attribute("content"), first=True),
        Rule("latlng", fixed.DETAIL_LATLNG, take=_attribute("data-atlas-latlng"), first=True),
        *_ordered("address", fixed.DETAIL_ADDRESS),
        *_ordered("description", fixed.DETAIL_DESCRIPTION),
        *_ordered("house_rules", fixed.DETAIL_HOUSE_RULES, first=True),
        *_ordered("checkin", fixed.DETAIL_CHECKIN),
        *_ordered("checkout", fixed.DETAIL_CHECKOUT),
        *_ordered("language", fixed.DETAIL_LANGUAGES),
        *_ordered("type", fixed.DETAIL_TYPE),
        *_detail_stars(),
        *_ordered("popular", fixed.DETAIL_POPULAR),
        Rule("facility_heading", fixed.FACILITY_HEADING, scope=group, each=True, first=True),
        Rule("facility_item", fixed.FACILITY_ITEM, scope=group, each=True),
        *rooms,
        *rating,
        *_ordered("score_badge", fixed.DETAIL_SCORE),
        Rule("subscore", fixed.DETAIL_SUBSCORES),
        *_ordered("place", fixed.DETAIL_PLACES),
        *_ordered("taxes", fixed.DETAIL_TAXES),
        *_ordered("price", fixed.DETAIL_PRICE),
        *_ordered("struck", fixed.DETAIL_STRUCK),
        *_ordered("meal_plan", fixed.DETAIL_MEAL_PLAN),
        *_ordered("image", fixed.DETAIL_IMAGES, take=_attribute(*fixed.DETAIL_IMAGE_ATTRIBUTES)),
    ]


def web_rules() -> list[Rule]:
    """Fields any web page has."""
    return [
        Rule("title", "title", take="raw", first=True),
        Rule("heading", "h1", first=True),
        Rule("language", "html", take=_attribute("lang"), first=True),
        Rule("link", "a[href]", take=_attribute("href")),
    ]
