"""Replays taken out by event time, and late rows kept beside.

Spark's `dropDuplicatesWithinWatermark` keeps the keys it has seen only as long as the watermark asks, so
its state is bounded; but it also drops rows that come later than that, unseen. Two queries in a row lose
none of them:

1. `split_stream` deals every batch into rows in time and late ones, by the watermark that the batches
   before it left (the largest event time less the delay), and commits the batch with its largest time.
2. `distinct_stream` reads the rows in time and keeps the first of each key. Its own watermark can only be
   behind that of the first query, as it has seen no more batches, so it drops no row for being late.

Late rows stay in their own table; `late_rows` has those whose key the main table lacks, each key once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

_COMMIT = "batch bigint, latest timestamp, late bigint"


def split_commits(spark: SparkSession, home: str) -> DataFrame:
    """(batch, latest, late): the batches that are done, their largest event time, how many rows were late."""
    try:
        return spark.read.schema(_COMMIT).parquet(f"{home}/batches").distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COMMIT)


def split_stream(
    stream: DataFrame, home: str, time: str, delay: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Deal the rows of every batch to `late=false` and `late=true`; rows without a time are in time.

    ``time`` names a timestamp column, ``delay`` is an interval such as "2 days".
    """
    wait = F.expr(f"INTERVAL {delay}")
    none = split_commits(stream.sparkSession, home).limit(0)
    none.coalesce(1).write.mode("append").parquet(f"{home}/batches")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = split_commits(spark, home)
        if done.where(F.col("batch") == batch_id).count():
            return  # committed before; the second query may have read its files
        passed = done.where(F.col("batch") < batch_id).select((F.max("latest") - wait).alias("mark")).first()["mark"]
        late = F.coalesce(F.col(time) <= F.lit(passed).cast("timestamp"), F.lit(False))
        seen = Observation()
        (
            batch.withColumn("late", late)
            .observe(seen, F.max(time).alias("latest"), F.count_if("late").alias("late"))
            .write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy("late").parquet(f"{home}/split/batch={batch_id}")
        )
        row = (batch_id, seen.get["latest"], seen.get["late"])
        spark.createDataFrame([row], _COMMIT).coalesce(1).write.mode("append").parquet(f"{home}/batches")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{home}/checkpoint-split")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _split(spark: SparkSession, home: str, schema: T.StructType, late: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{home}/split/batch=*/late={late}")


def distinct_stream(
    spark: SparkSession,
    home: str,
    schema: T.StructType,
    keys: Sequence[str],
    time: str,
    delay: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Append the first row of every key to `{home}/main`; state is kept for the delay only."""
    rows = spark.readStream.schema(schema).parquet(f"{home}/split/batch=*/late=false")
    first = rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
    return (
        first.writeStream.format("parquet").outputMode("append")
        .option("path", f"{home}/main").option("checkpointLocation", f"{home}/checkpoint-main")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def main_rows(spark: SparkSession, home: str, schema: T.StructType) -> DataFrame:
    """What came in time, each key once."""
    return spark.read.schema(schema).parquet(f"{home}/main")


def late_rows(spark: SparkSession, home: str, schema: T.StructType, keys: Sequence[str], time: str) -> DataFrame:
    """What came late and is not a replay of a row in time: the first row by time of every key."""
    try:
        late = _split(spark, home, schema, "true")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    known = main_rows(spark, home, schema).select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    rest = [f.name for f in schema if f.name not in keys]
    best = F.min_by(F.struct(*rest), F.col(time)).alias("_row")
    return late.join(known, same, "left_anti").groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}") for c in rest])
