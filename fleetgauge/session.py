"""Session helper. Calendar days depend on the session zone, so it is pinned to UTC."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "fleetgauge", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` uses `__` for dots in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Stored days must not shift between runs, so jobs only write in the pinned zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


@contextmanager
def utc(spark: SparkSession) -> Iterator[None]:
    """The pinned zone for a block, for sessions that come with another."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# Input bytes (compressed) per shuffle partition before adaptive execution merges small ones.
BYTES_PER_PARTITION = 64 * 1024**2
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the initial number of shuffle partitions to fit the input; never lowers it.

    The default of 200 would put half a terabyte of a 100 TB input into each task. Starting with many is
    cheap, because adaptive execution merges small partitions once their sizes are known.
    """
    present = int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(present, input_bytes // BYTES_PER_PARTITION)
    if wanted > present:
        spark.conf.set(_INITIAL, str(wanted))
    return wanted


def input_bytes(df: DataFrame) -> int:
    """Size of a table on disk as the optimizer knows it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="fleetgauge-")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, named by `spark.checkpoint.dir`.

    Only a local session without that setting falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_folder(context.applicationId)


def removed_at_exit(spark: SparkSession, folder: str) -> None:
    """Have a folder, which need not exist yet, removed when the application ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
