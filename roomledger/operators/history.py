"""History of one row per key and day: changes, latest state, trailing averages.

The windows run over rows that were merged per key and day before, so a
partition holds at most one row per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def changes(history: DataFrame, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """Previous value of each column and, for numbers, the difference to it."""
    window = Window.partitionBy(key).orderBy(day)
    result = history.withColumn("previous_day", F.lag(day).over(window))
    kinds = dict(history.dtypes)
    for name in columns:
        before = f"previous_{name}"
        result = result.withColumn(before, F.lag(name).over(window))
        if kinds[name] == "string":
            changed = ~F.col(name).eqNullSafe(F.col(before)) & F.col("previous_day").isNotNull()
            result = result.withColumn(f"{name}_changed", changed)
        else:
            result = result.withColumn(f"{name}_change", F.col(name) - F.col(before))
    return result


def latest(history: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key, as an aggregation with partial results."""
    rest = [c for c in history.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return history.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}") for c in rest])


def trailing_average(
    history: DataFrame, key: str, day: str, amount: str, observations: int, name: str
) -> DataFrame:
    """Mean of an integral amount over the last observations of a key, this one included."""
    window = Window.partitionBy(key).orderBy(day).rowsBetween(1 - observations, 0)
    mean = F.sum(amount).over(window) / F.count(amount).over(window)
    return history.withColumn(name, mean)
