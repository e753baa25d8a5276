"""Expected against observed partitions, pagination gaps and refresh gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.operators.joins import null_safe_join


def expected_pages(
    partitions: DataFrame,
    first: Column,
    last: Column,
    pages: int,
    page_size: int = fixed.PAGE_SIZE,
) -> DataFrame:
    """Partition rows times days times page numbers, with the offset of each page.

    Days and pages are generated per row, so nothing is cross joined.
    """
    days = partitions.withColumn("day", F.explode(F.sequence(first, last)))
    return days.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)))).withColumn(
        "offset", F.col("page") * page_size
    )


def missing(expected: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected rows without an observation."""
    return null_safe_join(expected, observed.select(*keys).distinct(), keys, "left_anti")


def before_first_gap(counts: DataFrame, partition: Sequence[str], page: str, n: str) -> DataFrame:
    """Pages before the first empty one of their partition."""
    gaps = counts.groupBy(*partition).agg(
        F.min(F.when(F.col(n) == 0, F.col(page))).alias("_gap")
    )
    kept = null_safe_join(counts, gaps, partition)
    return kept.where(F.col("_gap").isNull() | (F.col(page) < F.col("_gap"))).drop("_gap")


def rotation(calendar: DataFrame, day: str, total: int | Column, per_day: int) -> DataFrame:
    """The positions due on each day: a window moving over the list, restarted each year."""
    start = F.pmod((F.dayofyear(day) - 1) * per_day, F.lit(total))
    steps = F.sequence(F.lit(0), F.lit(per_day - 1))
    return calendar.select("*", F.explode(steps).alias("slot")).withColumn(
        "position", F.pmod(start + F.col("slot"), F.lit(total))
    )


def refresh_gaps(visits: DataFrame, partition: str, day: str) -> DataFrame:
    """Days between consecutive visits of a partition.

    ``visits`` is made distinct first, so a partition has at most one row per
    calendar day however many observations it holds.
    """
    per_day = visits.select(partition, day).distinct()
    previous = F.lag(day).over(Window.partitionBy(partition).orderBy(day))
    return per_day.withColumn("previous", previous).withColumn(
        "gap_days", F.datediff(F.col(day), F.col("previous"))
    )
