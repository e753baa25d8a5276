"""Store statistics, completeness profiles and counts per partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger import fixed_values as fixed


def _type_of(schema: T.StructType, path: str) -> T.DataType:
    kind: T.DataType = schema
    for name in path.split("."):
        kind = kind[name].dataType
    return kind


def is_filled(path: str, schema: T.StructType) -> Column:
    """Not null and not an empty list or map; an empty text counts as filled."""
    kind = _type_of(schema, path)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(path) > 0, F.lit(False))
    return F.col(path).isNotNull()


def completeness(rows: DataFrame, paths: Sequence[str] = tuple(fixed.PROFILE_PATHS)) -> DataFrame:
    """(field, filled, total, percent) of each path, counted in one pass over the rows."""
    counts = [
        F.count_if(is_filled(path, rows.schema)).alias(f"c{i}") for i, path in enumerate(paths)
    ]
    one = rows.agg(F.count(F.lit(1)).alias("total"), *counts)
    entries = F.array(
        *[
            F.struct(F.lit(path).alias("field"), F.col(f"c{i}").alias("filled"))
            for i, path in enumerate(paths)
        ]
    )
    percent = F.coalesce(F.expr("(filled * 100) div nullif(total, 0)"), F.lit(0))
    return one.select("total", F.inline(entries)).select(
        "field", "filled", "total", percent.cast("bigint").alias("percent")
    )


def low_coverage(profile: DataFrame, paths: Sequence[str] = tuple(fixed.WATCHED_PATHS)) -> DataFrame:
    """Watched fields filled in fewer than half of the rows (half rounded down)."""
    return profile.where(F.col("field").isin(list(paths))).where(
        F.col("filled") < F.expr("total div 2")
    )


def average_size(column: str) -> Column:
    """Mean length of a list column; a missing list has length zero."""
    return F.avg(F.when(F.col(column).isNull(), F.lit(0)).otherwise(F.size(column)))


def distinct_texts(column: str) -> Column:
    """Sorted distinct non-empty texts of a column that names few things."""
    return F.array_sort(F.collect_set(F.nullif(F.col(column), F.lit(""))))


def store_stats(rows: DataFrame, date: str, city: str) -> DataFrame:
    """One row: total, first and last date, sorted distinct cities."""
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        distinct_texts(city).alias("cities"),
    )


def partition_counts(
    rows: DataFrame, partition: Sequence[str], flags: dict[str, Column] | None = None
) -> DataFrame:
    """Rows per partition, and the rows for which each flag holds."""
    return rows.groupBy(*partition).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(flag).alias(name) for name, flag in (flags or {}).items()],
    )


def silver_coverage(rows: DataFrame, pairs: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Per field: raw texts present, values read from them, and texts rejected."""
    one = rows.agg(
        *[F.count_if(raw.isNotNull() & (raw != "")).alias(f"r_{f}") for f, (raw, _) in pairs.items()],
        *[F.count_if(typed.isNotNull()).alias(f"t_{f}") for f, (_, typed) in pairs.items()],
        *[
            F.count_if(raw.isNotNull() & (raw != "") & typed.isNull()).alias(f"x_{f}")
            for f, (raw, typed) in pairs.items()
        ],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"r_{f}").alias("present"),
                F.col(f"t_{f}").alias("read"),
                F.col(f"x_{f}").alias("rejected"),
            )
            for f in pairs
        ]
    )
    return one.select(F.inline(entries))
