"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.session import scratch

#: White space that separates words: blank, and the controls from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(docs: DataFrame, name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(docs[name], F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """The words between white space."""
    return F.array_remove(F.split(text, SPACES), "")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that lost executors cost no recomputation."""
    spark: SparkSession = frame.sparkSession
    path = scratch(spark, name)
    frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def frequent(counts: DataFrame, size: int) -> list[tuple[str, int]]:
    """The words of a stored table (word, c) with the largest counts, at most `size` of them.

    Words of equal count are all in or all out, so that a first step over the counts finds the least one
    and only the chosen words come to the driver. They are in order of count, then word.
    """
    steps = counts.groupBy("c").agg(F.count("*").alias("words")).orderBy(F.desc("c")).limit(size).collect()
    least, words = None, 0
    for step in steps:
        words += step["words"]
        if words > size:
            break
        least = step["c"]
    if least is None:
        return []
    rows = counts.where(F.col("c") >= least).select("word", "c").collect()
    return sorted(((r["word"], r["c"]) for r in rows), key=lambda r: (-r[1], r[0]))


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a few hundred rows, so that what is made from a part stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
