"""The ledger: which file versions are in bronze, in which batch.

Each batch appends one small file, a delta. `fold_ledger` writes a snapshot of what is still needed, the newest version of every path and one row for each
batch, and then removes the deltas it holds; ingest does so by itself when there are many. So reading the ledger means reading
the snapshot and the open deltas, however long the history is.

A snapshot counts when its last part is complete, and the deltas go only after that. A run that stops in between leaves entries twice or a
snapshot without effect; everything derived from the ledger is the same then, and the next fold clears the rest.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetgauge.sources.landing import FILE_SIZE, FILE_TIME, VERSION
from fleetgauge.sources.layers import Layers, folder_exists, folder_names, remove_file, remove_folder

LEDGER, SNAPSHOT = "ingested_files", "ledger_snapshot"
LEDGER_SCHEMA = (
    f"_source_file string, {FILE_TIME} timestamp, {FILE_SIZE} long, feed string, ingest_batch int, taken_at timestamp, refused boolean"
)
BATCHES_SCHEMA = "feed string, ingest_batch int, files long, bytes long, taken_at timestamp"
# Deltas after which ingest folds them.
OPEN_DELTAS = 50


def of_batches(batches: Sequence[tuple[str, int]]) -> Column:
    """Rows of the given batches, by a condition that prunes partitions."""
    wanted = F.lit(False)
    for feed in sorted({f for f, _ in batches}):
        numbers = [n for f, n in batches if f == feed]
        wanted = wanted | ((F.col("feed") == feed) & F.col("ingest_batch").isin(numbers))
    return wanted


def record_versions(versions: DataFrame, layers: Layers, feed: str, batch: int) -> None:
    """Enter the versions as those of a batch: one delta. `taken_at` is now and `refused` false, unless `versions` says otherwise."""
    made = {"feed": F.lit(feed), "ingest_batch": F.lit(batch).cast("int")}
    if "taken_at" not in versions.columns:
        made["taken_at"] = F.current_timestamp()
    made["refused"] = F.coalesce("refused", F.lit(False)) if "refused" in versions.columns else F.lit(False)
    entries = versions.withColumns(made).select(*VERSION, "feed", "ingest_batch", "taken_at", "refused")
    layers.append(entries.coalesce(1), LEDGER)


def _numbers(spark: SparkSession, layers: Layers) -> list[int]:
    found = (re.fullmatch(r"v=(\d+)", name) for name in folder_names(spark, layers.path(SNAPSHOT)))
    return sorted(int(match[1]) for match in found if match)


def _place(layers: Layers, number: int, part: str) -> str:
    return f"{layers.path(SNAPSHOT)}/v={number}/{part}"


def _in_force(spark: SparkSession, layers: Layers) -> int | None:
    """The newest complete snapshot: its batches are written last."""
    whole = (n for n in reversed(_numbers(spark, layers)) if folder_exists(spark, f"{_place(layers, n, 'batches')}/_SUCCESS"))
    return next(whole, None)


def _open_deltas(spark: SparkSession, layers: Layers) -> DataFrame:
    return layers.read(spark, LEDGER, LEDGER_SCHEMA)


def ledger(spark: SparkSession, layers: Layers) -> DataFrame:
    """The known file versions: of each path the newest at least, and the newest that was not refused. Entries may occur twice."""
    deltas, number = _open_deltas(spark, layers), _in_force(spark, layers)
    if number is None:
        return deltas
    return spark.read.schema(LEDGER_SCHEMA).parquet(_place(layers, number, "files")).unionByName(deltas)


def batches(spark: SparkSession, layers: Layers) -> DataFrame:
    """(feed, ingest_batch, files, bytes, taken_at) of every batch so far."""
    entered = _open_deltas(spark, layers).groupBy("feed", "ingest_batch").agg(
        F.count(F.lit(1)).alias("files"), F.sum(FILE_SIZE).alias("bytes"), F.max("taken_at").alias("taken_at")
    )
    number = _in_force(spark, layers)
    if number is None:
        return entered
    folded = spark.read.schema(BATCHES_SCHEMA).parquet(_place(layers, number, "batches"))
    # a delta holds its whole batch, so one that was folded but not removed yet says the same again
    return folded.unionByName(entered).groupBy("feed", "ingest_batch").agg(
        *[F.max(name).alias(name) for name in ("files", "bytes", "taken_at")]
    )


def newest_versions(entries: DataFrame, *by: str) -> DataFrame:
    """Of each path (and `by`) the entry that was taken last; a version entered again counts from its first entry."""
    first = entries.groupBy(*VERSION, *by).agg(
        F.min("taken_at").alias("taken_at"), F.min(F.struct("feed", "ingest_batch")).alias("_batch")
    )
    last = F.max(F.struct("taken_at", FILE_TIME, FILE_SIZE, "_batch")).alias("_last")
    return first.groupBy("_source_file", *by).agg(last).select(
        "_source_file", *by, f"_last.{FILE_TIME}", f"_last.{FILE_SIZE}", "_last._batch.feed", "_last._batch.ingest_batch", "_last.taken_at"
    )


def fold_ledger(spark: SparkSession, layers: Layers) -> int:
    """Write a new snapshot from the one in force and the open deltas, then remove these; returns their number."""
    deltas = _open_deltas(spark, layers).inputFiles() if layers.exists(spark, LEDGER) else []
    if not deltas:
        return 0
    old = _numbers(spark, layers)
    number = max(old, default=0) + 1
    entries = ledger(spark, layers).withColumn("refused", F.coalesce("refused", F.lit(False)))
    kept = newest_versions(entries, "refused").select(*VERSION, "feed", "ingest_batch", "taken_at", "refused")
    kept.write.mode("overwrite").parquet(_place(layers, number, "files"))
    batches(spark, layers).coalesce(1).write.mode("overwrite").parquet(_place(layers, number, "batches"))
    for file in deltas:
        remove_file(spark, file)
    for n in old:
        remove_folder(spark, f"{layers.path(SNAPSHOT)}/v={n}")
    return len(deltas)


def fold_if_many(spark: SparkSession, layers: Layers, open_deltas: int = OPEN_DELTAS) -> int:
    if not layers.exists(spark, LEDGER) or len(_open_deltas(spark, layers).inputFiles()) <= open_deltas:
        return 0
    return fold_ledger(spark, layers)
