"""Sources read under guard: what can not be read goes to a quarantine table, all others are kept.

All sources are read in one job. If that fails, the halves are read, and so on down to the sources that
fail alone: with b broken ones of n that is about b log n jobs, and one job where none is broken. A source
counts as a whole, so no part of a broken one is kept. What was read is written to a staging table and read
from there, so every source was read to its end before its rows are used.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARANTINE = "source string, reason string, message string"
_LONGEST = 500  # characters of a message
_CONDITION = re.compile(r"\[([A-Z][A-Z0-9_]*)(?:\.[A-Z0-9_.]+)?\]")

Reader = Callable[[SparkSession, list[str]], DataFrame]


def parquet_reader(schema: T.StructType) -> Reader:
    """Parquet files of a schema."""
    return lambda spark, paths: spark.read.schema(schema).parquet(*paths)


def json_reader(schema: T.StructType) -> Reader:
    """JSON lines of a schema; a broken line breaks its source."""
    return lambda spark, paths: spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def _reason(error: Exception) -> tuple[str, str]:
    """The innermost Spark condition among an error and its causes, or its class; and the line that says it."""
    text = str(error)
    found = list(_CONDITION.finditer(text))
    if not found:
        return type(error).__name__, text[:_LONGEST]
    return found[-1][1], text[found[-1].start() :].split("\n")[0][:_LONGEST]


def union_guarded(
    spark: SparkSession, sources: Sequence[tuple[str, Reader]], staging: str
) -> tuple[DataFrame | None, DataFrame]:
    """The rows of all sources that can be read, and (source, reason, message) of the others.

    A source is a path and its reader; sources of one reader are read together. Rows
    have the column `source` beside those of their reader. None if nothing can be read.
    """
    readers: dict[int, tuple[Reader, list[str]]] = {}
    for path, reader in sources:
        readers.setdefault(id(reader), (reader, []))[1].append(path)
    broken, parts = [], []
    waiting = [(reader, paths) for reader, paths in readers.values()]
    while waiting:
        reader, paths = waiting.pop()
        target = f"{staging}/part-{len(parts)}-{len(broken)}-{len(waiting)}-{len(paths)}"
        try:
            rows = reader(spark, paths)
            named = _with_source(rows, paths)
            named.write.mode("overwrite").parquet(target)
        except (PySparkException, Py4JJavaError) as error:
            if len(paths) == 1:
                broken.append((paths[0], *_reason(error)))
            else:
                middle = len(paths) // 2
                waiting += [(reader, paths[middle:]), (reader, paths[:middle])]
        else:
            parts.append(spark.read.schema(named.schema).parquet(target))
    kept = None
    for part in parts:
        kept = part if kept is None else kept.unionByName(part, allowMissingColumns=True)
    return kept, spark.createDataFrame(sorted(broken), QUARANTINE)


def _with_source(rows: DataFrame, paths: Sequence[str]) -> DataFrame:
    """The path of the list that a row's file lies under."""
    file = F.col("_metadata.file_path")
    tails = [(p.rstrip("/").split(":")[-1].lstrip("/"), p) for p in paths]
    found = F.coalesce(*[F.when(F.contains(F.concat(file, F.lit("/")), F.lit(f"/{tail}/")), F.lit(p)) for tail, p in tails])
    return rows.select("*", found.alias("source"))
