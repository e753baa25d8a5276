"""Bronze, silver and gold Parquet tables.

Bronze is only ever added to. A silver day is always the merge of all bronze
rows of that day, and only the days a batch touches are rewritten, so a job may
be repeated after a failure: it writes the same table again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.operators.merge import merge_rows


def append_bronze(batch: DataFrame, path: str, day: str = "scrape_date") -> None:
    """Add raw rows, partitioned by day."""
    batch.write.mode("append").partitionBy(day).parquet(path)


# What orders bronze rows: the run, its batch, and then the order inside of the batch.
ARRIVAL = ["run", "ingest"]


def put_batch(
    batch: DataFrame, path: str, batch_id: int, day: str = "scrape_date", run: int = 0
) -> None:
    """Add one numbered batch of a run; writing the same number of it again replaces all of it.

    Runs never touch each other's batches, so a second source or a stream with a
    renewed checkpoint adds to bronze. Later runs need larger numbers.
    """
    (
        batch.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(day)
        .parquet(f"{path}/run={run}/ingest={batch_id}")
    )


def bronze_schema(rows: T.StructType, day: str = "scrape_date") -> T.StructType:
    """The columns of stored batches."""
    return T.StructType(
        [
            *[f for f in rows if f.name != day],
            T.StructField("run", T.LongType()),
            T.StructField("ingest", T.LongType()),
            rows[day],
        ]
    )


def refresh_silver(
    bronze: DataFrame,
    touched: DataFrame,
    path: str,
    keys: Sequence[str],
    seq: Sequence[str],
    day: str = "scrape_date",
    policies: Mapping[str, str] | None = None,
) -> None:
    """Rewrite the silver days in ``touched`` from bronze.

    The semi join on the partition column lets Spark prune bronze to these days.
    """
    rows = bronze.join(touched.select(day).distinct(), day, "left_semi")
    silver = merge_rows(rows, keys, seq, policies)
    write_days(silver, path, day)


def write_days(rows: DataFrame, path: str, day: str = "scrape_date") -> None:
    """Replace exactly the days that occur in the rows.

    Rebalancing by day gives files of even size: a large day is split over
    several tasks, and small days do not leave a file per task.
    """
    (
        rows.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def register(spark: SparkSession, tables: Mapping[str, tuple[str, T.StructType]]) -> None:
    """Name stored tables for SQL, each with its explicit schema."""
    for name, (path, schema) in tables.items():
        read_layer(spark, path, schema).createOrReplaceTempView(name)


def save_table(
    rows: DataFrame, name: str, schema: T.StructType, path: str | None = None, by: Sequence[str] = ()
) -> None:
    """Write a catalogued table of exactly this schema; with a path its files are kept there."""
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    writer = typed.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    (writer.partitionBy(*by) if by else writer).saveAsTable(name)


def publish_snapshot(spark: SparkSession, source: str, target: str) -> None:
    """Overwrite one fixed target with the lines of a source that must exist."""
    try:
        lines = spark.read.text(source)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"nothing to publish at {source}") from error
        raise
    lines.write.mode("overwrite").text(target)
