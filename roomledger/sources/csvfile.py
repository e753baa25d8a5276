"""The CSV sink and its rebuild from the line file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger import fixed_values as fixed
from roomledger.functions.jsontext import json_text
from roomledger.schema import FLAT
from roomledger.sources.jsonl import read_store

_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def as_csv_columns(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns in order; others are left out and nested ones become JSON text."""
    kinds = {f.name: f.dataType for f in rows.schema}
    selected = []
    for name in columns:
        value = F.col(name)
        if isinstance(kinds[name], (T.ArrayType, T.MapType, T.StructType)):
            value = F.when(value.isNotNull(), json_text(value, kinds[name]))
        selected.append(value.alias(name))
    return rows.select(*selected)


def write_csv(rows: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Header, fixed columns in order, an empty field for null."""
    table = as_csv_columns(rows, columns or fixed.FLAT_COLUMNS)
    table.write.mode("overwrite").options(nullValue="", emptyValue="", **_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = FLAT) -> DataFrame:
    """Read such a file back; quoted line breaks are part of a field."""
    reader = spark.read.schema(schema).options(multiLine="true", nullValue="", **_OPTIONS)
    return reader.csv(path)


def rebuild_csv(
    spark: SparkSession,
    source: str,
    target: str,
    keys: tuple[str, ...] = ("hotel_id", "scrape_date"),
    schema: T.StructType = FLAT,
    columns: list[str] | None = None,
) -> int:
    """Write the CSV anew from the line file; the number of rows, 0 leaves the CSV as it is."""
    rows = read_store(spark, source, keys, schema)
    count = rows.count()
    if count:
        write_csv(rows, target, columns)
    return count
