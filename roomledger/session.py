"""Session settings and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", name: str = "roomledger") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.roomledger.tasks", "8" if cpus == "*" else str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers of all executors, once per application.

    The archive is made on the driver, and Spark itself hands it out from there.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="roomledger-")) / package.name
    context.addPyFile(
        shutil.make_archive(str(archive), "zip", root_dir=package.parent, base_dir=package.name)
    )
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, as named by spark.checkpoint.dir.

    Only a local session may go without it; it gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="roomledger-")


#: Pages of one task: about a minute of reading.
PAGES = 20_000

#: Rows of one task where short texts are parsed.
ROWS = 500_000


def dealt(rows: DataFrame, each: int | None = None) -> DataFrame:
    """Rows over as many tasks as the setting spark.roomledger.tasks says; as they are without it.

    For CPU-bound work behind a scan of few splits. With `each` a task gets at most about so many rows, with
    or without the setting: a file of many small rows is one split, and its work would be one task. The rows
    are counted for that, which a Parquet table answers from its footers.
    """
    spark = rows.sparkSession
    tasks = spark.conf.get("spark.roomledger.tasks", None)
    if each is None:
        return rows.repartition(int(tasks)) if tasks else rows
    return rows.repartition(max(int(tasks or spark.sparkContext.defaultParallelism), -(-rows.count() // each)))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/roomledger/{name}-{uuid.uuid4().hex}"
