"""Numbers out of text: scores, counts, prices, rooms, stars; discounts and tax flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions.text import contains_any, group_of, let, none_if_empty, strip


def within(value: Column, low: float, high: float) -> Column:
    """The value if inside the range, else null."""
    return let(value, lambda v: F.when(v.between(low, high), v))


def round_half_even(value: Column, digits: int) -> Column:
    """Round the exact binary value, ties to even.

    The built-in round works on the shortest decimal text of a double, so it
    sees a tie in 12.35 although the stored number lies below it. Here the
    built-in result is lowered by one unit where the double, multiplied exactly
    (as the sum of two doubles), lies below the tie or on it with an odd result.
    """
    scale = 10.0**digits
    twice = 2 * scale

    def product(v: Column) -> Column:
        spread = v * 134217729.0
        high = spread - (spread - v)
        return F.struct(
            v.alias("v"), (high * twice).alias("a"), ((v - high) * twice).alias("b"),
            F.round(v * 1, digits).alias("r"),
        )

    def with_error(p: Column) -> Column:
        total = p["a"] + p["b"]
        return F.struct(
            total.alias("t"), (p["b"] - (total - p["a"])).alias("e"),
            F.round(p["r"] * scale).alias("units"),
        )

    def corrected(q: Column) -> Column:
        above_tie = (q["t"] - (q["units"] * 2 - 1)) + q["e"]
        odd = q["units"].cast("bigint") % 2 != 0
        lower = (above_tie < 0) | ((above_tie == 0) & odd)
        return (q["units"] - F.when(lower, 1.0).otherwise(0.0)) / scale

    return let(let(let(value, product), with_error), corrected)


def score(text: Column) -> Column:
    """The first one- or two-digit number with at most one decimal, if within 1 to 10."""
    found = group_of(F.replace(text, F.lit(","), F.lit(".")), fixed.SCORE_PATTERN)
    return within(found.try_cast("double"), 1.0, 10.0)


def review_count(text: Column, least: int = fixed.LEAST_REVIEW_COUNT) -> Column:
    """The first comma-grouped integer that is not implausibly small."""
    tokens = F.regexp_extract_all(text, F.lit(fixed.COUNT_PATTERN), F.lit(1))
    numbers = F.transform(
        tokens, lambda t: F.replace(t, F.lit(","), F.lit("")).try_cast("bigint")
    )
    return F.get(F.filter(numbers, lambda n: n >= least), F.lit(0))


def price(text: Column) -> Column:
    """A positive amount; dots and commas are read by the shape of the number."""

    def amount(digits: Column) -> Column:
        without_commas = F.replace(digits, F.lit(","), F.lit(""))
        comma_as_dot = F.replace(digits, F.lit(","), F.lit("."))
        without_dots = F.replace(digits, F.lit("."), F.lit(""))
        plain = (
            F.when(~digits.contains(","), F.when(
                digits.rlike(fixed.DOT_THOUSANDS), without_dots).otherwise(digits))
            .when(
                digits.rlike(fixed.DOT_THOUSANDS),
                F.replace(without_dots, F.lit(","), F.lit(".")),
            )
            .when(digits.rlike(fixed.COMMA_THOUSANDS) | digits.contains("."), without_commas)
            .otherwise(comma_as_dot)
        )
        return let(plain.try_cast("double"), lambda number: F.when(number > 0, number))

    return let(F.regexp_replace(text, r"[^0-9.,]+", ""), amount)


def rooms_left(text: Column) -> Column:
    def counted(lowered: Column) -> Column:
        number = F.regexp_extract(lowered, fixed.ROOMS_PATTERN, 1)
        last = F.when(contains_any(lowered, fixed.LAST_ROOM_WORDS), F.lit(1))
        return let(number, lambda n: F.when(n != "", n.try_cast("int")).otherwise(last))

    return let(F.lower(text), counted)


def stars(label: Column, count: Column | None = None) -> Column:
    """Stars from a label, else from a number of star elements; 1 to 5 or null."""

    def from_label(lowered: Column) -> Column:
        return F.coalesce(
            *[
                within(group_of(lowered, pattern).try_cast("int"), 1, 5)
                for pattern in (fixed.STARS_OF, fixed.STARS_HYPHEN)
            ]
        )

    found = let(F.lower(label), from_label)
    return found if count is None else F.coalesce(found, within(count.cast("int"), 1, 5))


def discount_percent(original: Column, current: Column) -> Column:
    """Rebate in percent with one decimal; null unless the original price is higher."""

    def percent(p: Column) -> Column:
        raw = (p["o"] - p["c"]) / p["o"] * 100
        valid = (p["o"] > 0) & (p["c"] > 0) & (p["o"] > p["c"])
        return F.when(valid, round_half_even(raw, 1))

    return let(F.struct(original.alias("o"), current.alias("c")), percent)


def sane_original_price(original: Column, current: Column) -> Column:
    """Drop a struck-through price that does not exceed the current one."""
    return F.when(current.isNull() | (original > current), original)


def taxes_included(text: Column) -> Column:
    """False, true or unknown; exclusion phrases are tested first."""

    def flag(lowered: Column) -> Column:
        return F.when(contains_any(lowered, fixed.TAX_EXCLUDED), F.lit(False)).when(
            contains_any(lowered, fixed.TAX_INCLUDED), F.lit(True)
        )

    return let(F.lower(text), flag)


def nonzero(value: Column) -> Column:
    """Zero counts as missing."""
    return F.when(value != 0, value)


def time_of_day(text: Column) -> Column:
    """HH:MM: a 12-hour form becomes a padded 24-hour one, else the time as written."""

    def in_day(p: Column) -> Column:
        hour = (
            F.when((p["half"] == "PM") & (p["hour"] != 12), p["hour"] + 12)
            .when((p["half"] == "AM") & (p["hour"] == 12), F.lit(0))
            .otherwise(p["hour"])
        )
        return let(
            hour,
            lambda h: F.concat(
                F.when(h < 10, F.lit("0")).otherwise(F.lit("")), h.cast("string"), F.lit(":"),
                p["minute"],
            ),
        )

    def read(t: Column) -> Column:
        twelve = F.struct(
            none_if_empty(F.regexp_extract(t, fixed.TIME_12H, 1)).try_cast("int").alias("hour"),
            F.regexp_extract(t, fixed.TIME_12H, 2).alias("minute"),
            F.upper(F.regexp_extract(t, fixed.TIME_12H, 3)).alias("half"),
        )
        return F.coalesce(let(twelve, in_day), group_of(t, fixed.TIME_24H))

    return F.when(text.contains(":"), let(text, read))


def trimmed_number(text: Column) -> Column:
    return strip(text).try_cast("double")
