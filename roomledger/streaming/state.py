"""The upsert as a stream over a state of winners, so that a batch never reads earlier batches.

The state has one row per key: for every column its winning value and the order that made it win
(`merge.merge_state`). A micro-batch becomes such a state itself, and is combined with the state of the
days it touches. A batch so reads its own rows and at most one row per key of those days, however many
batches the days had before; what it read is in the commits.

Nothing is overwritten in place. The combined days are written as a new version, and then the version is
committed with the list of its days; a reader takes the last committed version of every day. A batch that
fails before its commit is not seen, and one that is repeated writes the same version again. States are
idempotent, so rows that are delivered again change nothing.

One stream writes a state at a time. Versions that no day uses any more can be dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roomledger.operators.merge import combine_states, merge_state, state_values
from roomledger.sources.layers import ARRIVAL
from roomledger.streaming.upsert import run_of


def _version(run: int, batch_id: int) -> str:
    """Texts that sort as the numbers do."""
    return f"{run:020d}-{batch_id:012d}"


def state_schema(rows: DataFrame, keys: Sequence[str], seq: Sequence[str], policies: Mapping[str, str] | None = None) -> T.StructType:
    """The columns of a state of such rows."""
    empty = rows.sparkSession.createDataFrame([], rows.schema)
    return merge_state(empty, keys, seq, policies).schema


def commits(spark: SparkSession, state: str, day: T.StructField) -> DataFrame:
    """(version, day, batch_rows, state_rows): which version has which day, and what its batch read in all."""
    schema = T.StructType(
        [T.StructField("version", T.StringType()), day, T.StructField("batch_rows", T.LongType()), T.StructField("state_rows", T.LongType())]
    )
    try:
        return spark.read.schema(schema).parquet(f"{state}/commits").distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _latest(known: DataFrame, day: str) -> list[tuple]:
    """(day, its last version); the driver sees a row per day."""
    return [tuple(r) for r in known.groupBy(day).agg(F.max("version")).collect()]


def _of_days(spark: SparkSession, state: str, schema: T.StructType, day: str, latest: Sequence[tuple]) -> DataFrame:
    """The state of some days, each of one version; the files of others are pruned."""
    if not latest:
        return spark.createDataFrame([], schema)
    by_version: dict[str, list] = {}
    for value, version in latest:
        by_version.setdefault(version, []).append(value)
    full = T.StructType([*[f for f in schema if f.name != day], schema[day], T.StructField("version", T.StringType())])
    rows = spark.read.schema(full).option("basePath", f"{state}/data").parquet(*[f"{state}/data/version={v}" for v in by_version])

    def wanted(version: str, days: list):
        some = F.col(day).isin([d for d in days if d is not None])
        return (F.col("version") == version) & (some | F.col(day).isNull() if None in days else some)

    return rows.where(reduce(or_, [wanted(v, d) for v, d in by_version.items()])).select(*schema.names)


def read_state(spark: SparkSession, state: str, schema: T.StructType, day: str = "scrape_date") -> DataFrame:
    """The last committed state of all days; `schema` is that of `state_schema`."""
    return _of_days(spark, state, schema, day, _latest(commits(spark, state, schema[day]), day))


def read_silver(
    spark: SparkSession, state: str, schema: T.StructType, keys: Sequence[str], day: str = "scrape_date"
) -> DataFrame:
    """The merged rows of all days."""
    return state_values(read_state(spark, state, schema, day), keys)


def merge_batch(
    batch: DataFrame,
    state: str,
    version: str,
    keys: Sequence[str],
    seq: Sequence[str],
    day: str = "scrape_date",
    policies: Mapping[str, str] | None = None,
) -> None:
    """Combine a batch with the state of its days, as a new version; `day` is one of the keys."""
    spark = batch.sparkSession
    read, known = Observation(), Observation()
    count = F.count(F.lit(1)).alias("rows")
    own = merge_state(batch.observe(read, count), keys, seq, policies)
    schema = own.schema
    # The batch is computed once; its state is stored and read twice.
    own.write.mode("overwrite").parquet(f"{state}/incoming")
    own = spark.read.schema(schema).parquet(f"{state}/incoming")
    days = [r[0] for r in own.select(day).distinct().collect()]
    if not days:
        return
    earlier = commits(spark, state, schema[day]).where(F.col("version") < version)
    touched = [(value, v) for value, v in _latest(earlier, day) if value in days]
    before = _of_days(spark, state, schema, day, touched).observe(known, count)
    combined = combine_states(before.unionByName(own), keys)
    (
        combined.hint("rebalance", day)
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
        .partitionBy(day).parquet(f"{state}/data/version={version}")
    )
    done = own.select(
        F.lit(version).alias("version"), day,
        F.lit(read.get["rows"]).cast("bigint").alias("batch_rows"), F.lit(known.get["rows"]).cast("bigint").alias("state_rows"),
    ).distinct()
    done.coalesce(1).write.mode("append").parquet(f"{state}/commits")


def state_stream(
    stream: DataFrame,
    state: str,
    checkpoint: str,
    keys: Sequence[str],
    seq: Sequence[str],
    day: str = "scrape_date",
    policies: Mapping[str, str] | None = None,
    arrival: bool = True,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Start the query; by default it takes what is there and stops.

    With ``arrival`` later batches come after earlier ones whatever ``seq`` says, as in bronze;
    without it ``seq`` alone decides, and the result does not depend on how rows fell into batches.
    """
    spark = stream.sparkSession
    run = run_of(spark, checkpoint)
    none = commits(spark, state, stream.schema[day]).limit(0)
    none.coalesce(1).write.mode("append").parquet(f"{state}/commits")

    def write(batch: DataFrame, batch_id: int) -> None:
        if arrival:
            batch = batch.withColumns({"run": F.lit(run).cast("bigint"), "ingest": F.lit(batch_id).cast("bigint")})
        merge_batch(batch, state, _version(run, batch_id), keys, order, day, policies)

    order = [*ARRIVAL, *seq] if arrival else list(seq)
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def drop_superseded(spark: SparkSession, state: str, day: T.StructField) -> list[str]:
    """Delete the versions that no day uses any more; not while others read the state."""
    known = commits(spark, state, day)
    used = {version for _, version in _latest(known, day.name)}
    gone = sorted({r["version"] for r in known.select("version").distinct().collect()} - used)
    context = spark.sparkContext
    for version in gone:
        path = context._jvm.org.apache.hadoop.fs.Path(f"{state}/data/version={version}")
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return gone
