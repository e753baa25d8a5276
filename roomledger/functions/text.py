"""Trimming, blank tests, keyword tests and ordered candidates."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce, wraps
from operator import or_

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed


def strip(text: Column) -> Column:
    """Trim all Unicode white space; native trim, so only the ends are looked at."""
    return F.btrim(text, F.lit(fixed.WHITESPACE))


def built_once(build: Callable) -> Callable:
    """Columns that are built once per JVM, by arguments: each part of a Column is a call to it.

    Columns name what they read and belong to no rows, so they can be used again.
    """
    known: dict[tuple, object] = {}

    @wraps(build)
    def again(*args):
        key = (SparkContext._gateway, args)
        if key not in known:
            known[key] = build(*args)
        return known[key]

    return again


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """A value that is computed once per row and then used several times.

    Without it the expression of the value is repeated at every use, and inside
    a lambda it would be evaluated again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def overlay(old: Column, new: Column, fields: Iterable[str]) -> Column:
    """A struct updated with the non-null fields of another one."""
    return F.struct(*[F.coalesce(new[f], old[f]).alias(f) for f in fields])


def none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def group_of(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match of a pattern, null without a match."""
    return none_if_empty(F.regexp_extract(text, pattern, group))


def contains_any(text: Column, phrases: Iterable[str]) -> Column:
    """Any phrase inside the text; a phrase with another one inside needs no test of its own."""
    phrases = list(phrases)
    needed = [p for p in phrases if not any(q != p and q in p for q in phrases)]
    return reduce(or_, [text.contains(phrase) for phrase in needed])


def is_blank(text: Column) -> Column:
    """No value in the sense of the merge rule: null, empty or an empty literal."""
    return text.isNull() | strip(text).isin(fixed.BLANK_TEXTS)


def squeeze(text: Column) -> Column:
    """Trim, and turn runs of three or more white-space characters into a blank line."""
    return F.regexp_replace(strip(text), r"(?U)[\s\x1c-\x1f]{3,}", "\n\n")


def lines_of(text: Column) -> Column:
    """The trimmed non-blank lines of a text."""
    stripped = F.transform(F.split(text, r"[\n\r]+"), strip)
    return F.filter(stripped, lambda line: line != "")


def first_of(values: Column, parse: Callable[[Column], Column]) -> Column:
    """The first non-null result of a parser over an array."""
    parsed = F.filter(F.transform(values, parse), lambda value: value.isNotNull())
    return F.get(parsed, F.lit(0))


def first_text(candidates: Column) -> Column:
    """The first non-blank text of candidates ordered by preference; the first of them mostly is."""
    stripped = F.transform(candidates, lambda c: strip(c["text"]))
    found = F.get(F.filter(stripped, lambda text: text != ""), F.lit(0))
    return let(strip(leading_text(candidates)), lambda text: F.when(text != "", text).otherwise(found))


def leading_text(candidates: Column) -> Column:
    """The text of the very first candidate, blank or not."""
    return F.get(candidates, F.lit(0))["text"]


def first_group_texts(candidates: Column, keep: Callable[[Column], Column]) -> Column:
    """Distinct kept texts of the most preferred matcher that has any."""
    kept = F.filter(candidates, lambda c: (c["text"] != "") & keep(c["text"]))
    chosen = let(kept, preferred)
    return F.array_distinct(F.transform(chosen, lambda c: c["text"]))


def preferred(candidates: Column) -> Column:
    """The candidates of the first one's matcher; the argument must be bound by let."""
    first = F.get(candidates, F.lit(0))["prio"]
    return F.filter(candidates, lambda c: c["prio"] == first)


def distinct_by_text(candidates: Column) -> Column:
    """Keep the first candidate of each text."""
    def firsts(bound: Column) -> Column:
        texts = F.transform(bound, lambda c: c["text"])
        return let(
            texts,
            lambda t: F.filter(
                bound, lambda c, i: F.array_position(t, c["text"]) == (i + 1).cast("bigint")
            ),
        )

    return let(candidates, firsts)


def keywords_found(text: Column, phrases: dict[str, list[str]]) -> Column:
    """All keys with a phrase inside the text, in map order (plain substring test)."""
    def hits(lowered: Column) -> Column:
        found = [F.when(contains_any(lowered, w), F.lit(key)) for key, w in phrases.items()]
        return F.array_compact(F.array(*found))

    return let(F.lower(text), hits)


def first_keyword(text: Column, phrases: dict[str, list[str]]) -> Column:
    """The first key, in map order, with a phrase inside the text."""
    def first(lowered: Column) -> Column:
        return F.coalesce(
            *[F.when(contains_any(lowered, w), F.lit(key)) for key, w in phrases.items()]
        )

    return let(F.lower(text), first)
