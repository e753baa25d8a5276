"""Schemas of partitioned Parquet days: discovery, drift between days, one schema for all of them.

Days are found by listing, and each day's schema is read from the footers of its files (merged, where they
differ inside a day). The driver sees a schema per day and no rows. Days of one schema are read together,
cast to the common schema, so a column that came later is null before and one that changed its type keeps
its values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.sources.layers import save_table

Days = Sequence[tuple[object, T.StructType]]

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)


def day_schemas(spark: SparkSession, path: str, day: str = "scrape_date") -> list[tuple[object, T.StructType]]:
    """(day, schema) of all days below a path, in order; names are those of the `day=` folders."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
        .select(F.col(day).cast("string").alias("day"), F.regexp_extract("path", f"^(.*/{day}=[^/]*)/", 1).alias("folder"))
        .distinct().orderBy("day", "folder").collect()
    )
    found: dict[object, list[str]] = {}
    for r in listed:
        found.setdefault(r["day"], []).append(r["folder"])
    return [(value, spark.read.option("mergeSchema", "true").parquet(*folders).schema) for value, folders in found.items()]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both; text where nothing else does."""
    if a == b:
        return a
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(a, (*_WHOLE, *_REAL)) and isinstance(b, (*_WHOLE, *_REAL)):
        return T.DoubleType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if {type(a), type(b)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def merged(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns in order of first sight, each of a type that holds all of its values."""
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            kinds[f.name] = wider(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


DRIFT = "day string, field string, change string, old_type string, new_type string"


def drift(spark: SparkSession, days: Days) -> DataFrame:
    """What changed on which day, against the day before and all columns known until then.

    `added`: never seen before. `back`: known, and not there the day before. `missing`:
    there the day before, and not now. `retyped`: another type than when last seen.
    """
    rows, last_kind, before = [], {}, None
    for value, schema in days:
        now = {f.name: f.dataType.simpleString() for f in schema}
        for name, kind in now.items():
            if before is not None and name not in last_kind:
                rows.append((value, name, "added", None, kind))
            elif before is not None and name not in before:
                rows.append((value, name, "back", last_kind[name], kind))
            if name in last_kind and last_kind[name] != kind:
                rows.append((value, name, "retyped", last_kind[name], kind))
        rows += [(value, name, "missing", kind, None) for name, kind in (before or {}).items() if name not in now]
        last_kind.update(now)
        before = now
    return spark.createDataFrame(rows, DRIFT)


def _cast(value, kind: T.DataType, old: T.DataType):
    if kind == old:
        return value
    if isinstance(kind, T.StringType) and isinstance(old, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value)
    if isinstance(kind, T.StructType):
        inner = {f.name: f.dataType for f in old}
        fields = [
            (_cast(value[f.name], f.dataType, inner[f.name]) if f.name in inner else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in kind
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _cast(v, kind.elementType, old.elementType))
    return value.cast(kind)


def read_all(spark: SparkSession, path: str, days: Days, day: str = "scrape_date") -> DataFrame:
    """The rows of all days in the merged schema, and the day as text; a scan for each different schema."""
    full = merged([schema for _, schema in days])
    groups: list[tuple[T.StructType, list[object]]] = []
    for value, schema in days:
        for known, values in groups:
            if known == schema:
                values.append(value)
                break
        else:
            groups.append((schema, [value]))
    parts = []
    for schema, values in groups:
        stored = T.StructType([*schema.fields, T.StructField(day, T.StringType())])
        own = {f.name: f.dataType for f in schema}
        rows = spark.read.schema(stored).parquet(path)
        some = F.col(day).isin([v for v in values if v is not None])
        rows = rows.where(some | F.col(day).isNull() if None in values else some)
        parts.append(rows.select(
            *[(_cast(F.col(f.name), f.dataType, own[f.name]) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in full],
            F.col(day),
        ))
    return reduce(DataFrame.unionAll, parts)


def catalogue(spark: SparkSession, path: str, table: str, day: str = "scrape_date", at: str | None = None) -> DataFrame:
    """Save all days below a path as one catalogued table of the merged schema; returns the drift report."""
    days = day_schemas(spark, path, day)
    rows = read_all(spark, path, days, day)
    save_table(rows, table, rows.schema, at, [day])
    return drift(spark, days)
