"""Gold tables and structured search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.operators.joins import null_safe_join


def daily_summary(
    silver: DataFrame,
    by: Sequence[str],
    price: Column,
    rating: Column,
    shares: dict[str, Column] | None = None,
) -> DataFrame:
    """Listings, price and rating figures per group, and the share of rows with a feature."""
    return silver.groupBy(*by).agg(
        F.count(F.lit(1)).alias("listings"),
        F.avg(price).alias("avg_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.avg(rating).alias("avg_rating"),
        F.count(rating).alias("rated"),
        *[
            (F.count_if(flag) / F.count(F.lit(1))).alias(f"{name}_share")
            for name, flag in (shares or {}).items()
        ],
    )


def daily_partials(rows: DataFrame, by: Sequence[str], amount: str) -> DataFrame:
    """Sums of an integral amount per group that add up: (rows, amounts, total, least, most)."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("listings"),
        F.count(amount).alias("priced"),
        F.sum(amount).alias("total"),
        F.min(amount).alias("least"),
        F.max(amount).alias("most"),
    )


def market_rollup(partials: DataFrame, fixed_by: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """Summaries at every level from stored partial sums: by all levels, by fewer from the right, by none.

    `depth` is the number of levels a row is grouped by, so that a null in the data
    and a level that is summed over differ. The raw rows are not read again.
    """
    sets = [[*fixed_by, *levels[:n]] for n in range(len(levels), -1, -1)]
    depth = F.lit(len(levels)) - sum((F.grouping(c).cast("int") for c in levels), F.lit(0))
    names = [*fixed_by, *levels]
    return partials.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in names]).agg(
        depth.alias("depth"),
        F.sum("listings").alias("listings"),
        (F.sum("total") / F.sum("priced")).alias("avg_price"),
        F.min("least").alias("min_price"),
        F.max("most").alias("max_price"),
    )


#: Leading bits of an amount that its cell of a summary keeps.
SUMMARY_BITS = 7


def _cell(amount: Column, bits: int) -> Column:
    """The least amount, away from zero, that has the same leading bits."""
    size = F.abs(amount)
    shift = F.greatest(F.length(F.bin(size)) - bits, F.lit(0))
    low = F.call_function("shiftleft", F.call_function("shiftright", size, shift), shift)
    return F.when(amount < 0, -low).otherwise(low)


def quantile_summary(rows: DataFrame, by: Sequence[str], amount: str, bits: int = SUMMARY_BITS) -> DataFrame:
    """(by, cell, n): how many integral amounts of a group fall into each cell.

    A cell holds the amounts with the same leading bits, so it is narrower than
    2 ** (1 - bits) of its amounts and exact below 2 ** bits. A group has at most
    a few thousand cells, whatever its rows.
    """
    cells = rows.where(F.col(amount).isNotNull()).select(*by, _cell(F.col(amount).cast("bigint"), bits).alias("cell"))
    return cells.groupBy(*by, "cell").agg(F.count(F.lit(1)).alias("n"))


def combine_summaries(summaries: DataFrame, by: Sequence[str]) -> DataFrame:
    """Summaries of finer groups, days for example, added up to coarser ones; no rows are read again."""
    return summaries.groupBy(*by, "cell").agg(F.sum("n").alias("n"))


def quantiles(summary: DataFrame, by: Sequence[str], shares: Sequence[float], bits: int = SUMMARY_BITS) -> DataFrame:
    """(by, share, n, low, high) with the exact quantile between low and high, both included.

    The quantile of a share is the least amount that this share of the amounts does
    not exceed. A window partition holds the cells of one group.
    """
    window = Window.partitionBy(*by).orderBy("cell")
    upto = F.sum("n").over(window)
    total = F.sum("n").over(Window.partitionBy(*by))
    walked = summary.select(*by, "cell", upto.alias("upto"), (upto - F.col("n")).alias("before"), total.alias("n"))
    asked = walked.select("*", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"))
    place = F.greatest(F.ceil(F.col("share") * F.col("n")), F.lit(1))
    found = asked.where((F.col("before") < place) & (place <= F.col("upto")))
    shift = F.greatest(F.length(F.bin(F.abs("cell"))) - bits, F.lit(0))
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift) - 1
    cell = F.col("cell")
    return found.select(
        *by, "share", "n",
        F.when(cell < 0, cell - width).otherwise(cell).alias("low"), F.when(cell < 0, cell).otherwise(cell + width).alias("high"),
    )


def amenity_shares(
    silver: DataFrame, by: Sequence[str], tags: str, listing: Sequence[str]
) -> DataFrame:
    """Share of a group's rows that carry each tag."""
    totals = silver.groupBy(*by).agg(F.count(F.lit(1)).alias("listings"))
    tagged = (
        silver.select(*by, *listing, F.explode(F.array_distinct(tags)).alias("tag"))
        .groupBy(*by, "tag")
        .agg(F.count(F.lit(1)).alias("tagged"))
    )
    return null_safe_join(tagged, totals, by).withColumn("share", F.col("tagged") / F.col("listings"))


def near_place(
    listings: DataFrame, near: DataFrame, kind: str, within_km: float, key: str = "hotel_id"
) -> DataFrame:
    """Listings with a place of a kind within a distance; each listing once."""
    fits = near.where((F.col("type") == kind) & (F.col("distance_km") <= within_km))
    return listings.join(fits.select(key), key, "left_semi")


def search(
    gold: DataFrame, conditions: Sequence[Column], order: Sequence[Column], limit: int
) -> DataFrame:
    """Rows that meet all conditions, the best first (a top-k without a full sort)."""
    for condition in conditions:
        gold = gold.where(condition)
    return gold.orderBy(*order).limit(limit)
