"""Line files: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.functions.text import strip
from roomledger.operators.merge import last_wins
from roomledger.schema import FLAT

# The position of a line: file, split of the file, place inside the split. A task
# reads a split from front to back, so this is the order of the lines in a file.
LINE_ORDER = ["_file", "_split", "_line"]
_OPTIONS = {"allowSingleQuotes": "false", "columnNameOfCorruptRecord": "_corrupt"}


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank lines with their position."""
    lines = spark.read.text(path).select(
        strip(F.col("value")).alias("value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_line"),
    )
    return lines.where(F.col("value") != "")


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: the number of non-blank lines."""
    text = spark.read.text(path).where(strip(F.col("value")) != "")
    return text.agg(F.count(F.lit(1)).alias("lines"))


def _parsed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All values are read as text first, so that no value costs its line."""
    texts = [T.StructField(f.name, T.StringType()) for f in schema]
    full = T.StructType([*texts, T.StructField("_corrupt", T.StringType())])
    record = F.from_json("value", full, _OPTIONS)
    return read_lines(spark, path).withColumn("record", record).withColumn(
        "good", F.col("value").startswith("{") & F.col("record._corrupt").isNull()
    )


def _typed(text: Column, kind: T.DataType) -> Column:
    """A value of the type; null for an empty text and for what is of another type."""
    if isinstance(kind, T.StringType):
        return text
    given = F.nullif(strip(text), F.lit(""))
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.from_json(given, kind)
    if isinstance(kind, T.IntegralType):
        # 10.0 is a whole number, too
        number = given.try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    return given.try_cast(kind)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = FLAT) -> DataFrame:
    """The lines that hold an object, with their position; see `_typed` for values that do not fit."""
    parsed = _parsed(spark, path, schema).where("good")
    values = [_typed(F.col("record")[f.name], f.dataType).alias(f.name) for f in schema]
    return parsed.select(*values, *LINE_ORDER)


def rejected_lines(spark: SparkSession, path: str, schema: T.StructType = FLAT) -> DataFrame:
    """The lines that do not: broken JSON and other JSON values."""
    return _parsed(spark, path, schema).where(~F.col("good")).select("value", *LINE_ORDER)


def read_variants(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines that hold an object, as `record`, parsed once, with their position.

    An object that repeats a key is none. The check sits in the generator: a filter would be pushed
    below the parse and parse again.
    """
    parsed = F.array(F.struct(F.try_parse_json("value").alias("record")))
    objects = F.filter(parsed, lambda p: F.schema_of_variant(p["record"]).startswith("OBJECT"))
    return read_lines(spark, path).select(F.inline(objects), *LINE_ORDER)


def value_at(record: Column, path: str, kind: T.DataType) -> Column:
    """The value under a path such as "location.city", typed as `read_jsonl` does; null if it does not fit."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.try_variant_get(record, f"$.{path}", kind.simpleString())
    return _typed(F.try_variant_get(record, f"$.{path}", "string"), kind)


def key_state(record: Column, path: str) -> Column:
    """"absent", "null" (written as such), "empty" (a text without content) or "given"."""
    part = F.try_variant_get(record, f"$.{path}", "variant")
    blank = strip(F.try_variant_get(record, f"$.{path}", "string")) == ""
    return F.when(part.isNull(), "absent").when(F.is_variant_null(part), "null").when(blank, "empty").otherwise("given")


def key_states(lines: DataFrame, fields: dict[str, T.DataType]) -> DataFrame:
    """(path, absent, nulls, empty, given, unfit) per path over the lines of `read_variants`, in one pass.

    `unfit` are given values that are not of the type.
    """
    kinds = ("absent", "null", "empty", "given")
    each = F.array(*[
        F.struct(
            F.lit(path).alias("path"), key_state(F.col("record"), path).alias("state"),
            value_at(F.col("record"), path, kind).isNull().alias("none"),
        )
        for path, kind in fields.items()
    ])
    rows = lines.select(F.inline(each))
    counts = [F.count_if(F.col("state") == k).alias("nulls" if k == "null" else k) for k in kinds]
    return rows.groupBy("path").agg(*counts, F.count_if((F.col("state") == "given") & F.col("none")).alias("unfit"))


def read_store(
    spark: SparkSession,
    path: str | list[str],
    keys: tuple[str, ...] = ("hotel_id", "scrape_date"),
    schema: T.StructType = FLAT,
) -> DataFrame:
    """One row per key; of lines with one key the last counts.

    A missing part of a text key and an empty one are the same key: the writer of
    flat rows puts the empty text where it has no value.
    """
    rows = last_wins(read_jsonl(spark, path, schema), list(keys), LINE_ORDER)
    return rows.select(*[f.name for f in schema])


def write_jsonl(rows: DataFrame, path: str) -> None:
    """Rewrite a line file; nulls are written and non-ASCII text is kept."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
