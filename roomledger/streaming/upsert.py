"""The daily upsert as a stream.

Each micro-batch goes to bronze under its run and batch number and then
rewrites the silver days it touches. Both steps give the same tables when Spark
repeats a batch after a failure. Rows that are delivered again change nothing,
however late, since the merge of a key is the same with and without repeats.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roomledger.sources.layers import (
    ARRIVAL,
    bronze_schema,
    put_batch,
    read_layer,
    refresh_silver,
)


def run_of(spark: SparkSession, checkpoint: str) -> int:
    """The number of the checkpoint's run: the time when it was new, kept beside it."""
    path = f"{checkpoint}/run-number"
    try:
        rows = spark.read.schema("run bigint").parquet(path).collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    if rows:
        return rows[0]["run"]
    run = time.time_ns() // 1000
    spark.createDataFrame([(run,)], "run bigint").coalesce(1).write.mode("overwrite").parquet(path)
    return run


def upsert_stream(
    stream: DataFrame,
    bronze: str,
    silver: str,
    checkpoint: str,
    keys: Sequence[str],
    seq: Sequence[str],
    day: str = "scrape_date",
    policies: Mapping[str, str] | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start the query; by default it takes what is there and stops."""
    stored = bronze_schema(stream.schema, day)
    run = run_of(stream.sparkSession, checkpoint)
    order = [*ARRIVAL, *seq]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        put_batch(batch, bronze, batch_id, day, run)
        history = read_layer(spark, bronze, stored)
        touched = history.where((F.col("run") == run) & (F.col("ingest") == batch_id))
        refresh_silver(history, touched, silver, keys, order, day, policies)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

