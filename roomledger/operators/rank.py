"""Dense rank inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomledger.operators.joins import null_safe_join
from roomledger.session import scratch

_INSIDE = (1 << 33) - 1  # of monotonically_increasing_id: the row inside its partition


def dense_rank_in(rows: DataFrame, groups: Sequence[str], value: str, name: str = "rank") -> DataFrame:
    """Add the dense rank of a column of any ordered type, highest first, null without value.

    A window over a whole group would gather the group in one task. Here the
    distinct values of all groups are sorted by range partitions and stored, so
    that a group is spread over as many partitions as it needs, each of even size.
    The rank of a value is its place in its partition plus the number of values
    its group has in the partitions before; only these counts, one per partition
    and group in it, meet in a window. Numbers may be negative or fractions; NaN
    is the highest, and -0.0 and 0.0 are one value, as for Spark's own windows.
    """
    groups = list(groups)
    spark = rows.sparkSession
    if not groups:
        one = F.lit(0).alias("_all")
        return dense_rank_in(rows.select("*", one), ["_all"], value, name).drop("_all")
    path = scratch(spark, "rank")
    distinct = rows.where(F.col(value).isNotNull()).select(*groups, value).distinct()
    ordered = distinct.orderBy(*groups, F.desc(value)).withColumn("_row", F.monotonically_increasing_id())
    ordered.write.parquet(path)
    place = F.col("_row")
    ordered = spark.read.schema(ordered.schema).parquet(path).select(
        *groups, value, F.shiftright(place, 33).alias("_part"), place.bitwiseAND(_INSIDE).alias("_row")
    )
    runs = ordered.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    ranks = null_safe_join(ordered, runs, [*groups, "_part"]).select(
        *groups, value, (F.col("_before") + F.col("_row") - F.col("_first") + 1).alias(name)
    )
    return null_safe_join(rows, ranks, [*groups, value], "left")
