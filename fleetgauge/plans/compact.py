"""Compaction of bronze: many small batches become few of an even size.

The planner takes the batches' bytes from the ledger, oldest first, and packs them by their running sum up to a target size. Only batches that the
clean layers include are taken, so that no refresh reads a row twice, and only those of under half the target, so that a
batch is not copied again and again.

A merge writes the new batch, then notes which batches it replaces, then empties those. If a run stops before the note, rows lie in bronze twice,
which dedupe absorbs, and the next run merges them once more. After the note, `finish_merges` empties what is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.plans.ingest import (
    BATCH_DAYS, FILES, PROGRESS, PROGRESS_SCHEMA, batch_folder, mark_taken_in, next_batch, read_batch, write_batch,
)
from fleetgauge.plans.ledger import batches, ledger, record_versions
from fleetgauge.sources.landing import VERSION
from fleetgauge.sources.layers import Layers, remove_folder

MERGED = "merged_batches"
MERGED_SCHEMA = "feed string, ingest_batch int, merged_into int"
TARGET_BYTES = 1024**3
# Batches that one run looks at; the oldest come first, so the others have their turn.
MOST_BATCHES = 10_000


def live_batches(spark: SparkSession, layers: Layers) -> DataFrame:
    """(feed, ingest_batch, files, bytes, taken_at) of the batches that the clean layers include and no merge has replaced."""
    taken = layers.read(spark, PROGRESS, PROGRESS_SCHEMA).select("feed", "ingest_batch")
    gone = layers.read(spark, MERGED, MERGED_SCHEMA)
    key = ["feed", "ingest_batch"]
    return batches(spark, layers).join(taken, key, "left_semi").join(gone, key, "left_anti")


def plan_merges(spark: SparkSession, layers: Layers, target_bytes: int = TARGET_BYTES) -> list[list[tuple[str, int]]]:
    """Groups of small batches, oldest first, each of about the target's size; a batch without a partner is left alone.

    The batches, not their files or rows, pass through one window and the driver: at most `MOST_BATCHES`.
    """
    age = ["taken_at", "feed", "ingest_batch"]
    small = live_batches(spark, layers).where(F.col("bytes") * 2 < target_bytes).orderBy(*age).limit(MOST_BATCHES)
    before = F.sum("bytes").over(Window.orderBy(*age).rowsBetween(Window.unboundedPreceding, -1))
    packed = small.withColumn("_group", F.floor(F.coalesce(before, F.lit(0)) / target_bytes)).orderBy(*age)
    groups: dict[int, list[tuple[str, int]]] = {}
    for row in packed.select("_group", "feed", "ingest_batch").collect():
        groups.setdefault(row["_group"], []).append((row["feed"], row["ingest_batch"]))
    return [group for group in groups.values() if len(group) > 1]


def merge_batches(
    spark: SparkSession, layers: Layers, merged: Sequence[tuple[str, int]], cfg: SensorConfig = DEFAULT
) -> int:
    """Copy the batches into one new batch of even files, then empty them; returns its number.

    Only the folders of these batches are opened. Merge only batches that a refresh has already taken in; the new one is marked as
    taken in too.
    """
    rows = None
    for feed, batch in merged:
        part = read_batch(spark, layers, feed, batch)
        rows = part if rows is None else rows.unionByName(part)
    number = next_batch(spark, layers)
    write_batch(rows, layers, FILES, number, cfg)
    # the versions keep the time at which they were first taken, so the newest of a path stays the newest
    known = ledger(spark, layers).groupBy(*VERSION).agg(F.min("taken_at").alias("taken_at"))
    versions = read_batch(spark, layers, FILES, number).select(*VERSION).distinct()
    record_versions(versions.join(known, VERSION, "left"), layers, FILES, number)
    mark_taken_in(spark, layers, [(FILES, number)])
    notes = [(feed, batch, number) for feed, batch in merged]
    layers.append(spark.createDataFrame(notes, MERGED_SCHEMA).coalesce(1), MERGED)
    for feed, batch in merged:
        _empty(spark, layers, feed, batch, cfg)
    return number


def _empty(spark: SparkSession, layers: Layers, feed: str, batch: int, cfg: SensorConfig) -> None:
    remove_folder(spark, f"{layers.path(BATCH_DAYS)}/feed={feed}/ingest_batch={batch}")
    read_batch(spark, layers, feed, batch).limit(0).write.mode("overwrite").partitionBy(cfg.day).parquet(batch_folder(layers, feed, batch))


def finish_merges(spark: SparkSession, layers: Layers, cfg: SensorConfig = DEFAULT) -> list[tuple[str, int]]:
    """Empty the batches of merges that stopped after their note; returns them."""
    held = layers.read(spark, BATCH_DAYS, "date date, feed string, ingest_batch int").select("feed", "ingest_batch").distinct()
    left = layers.read(spark, MERGED, MERGED_SCHEMA).join(held, ["feed", "ingest_batch"], "left_semi")
    found = [(row["feed"], row["ingest_batch"]) for row in left.select("feed", "ingest_batch").distinct().collect()]
    for feed, batch in found:
        _empty(spark, layers, feed, batch, cfg)
    return found


def compact(
    spark: SparkSession, layers: Layers, target_bytes: int = TARGET_BYTES, cfg: SensorConfig = DEFAULT
) -> list[int]:
    """Finish what an earlier run left, plan, and merge; returns the numbers of the new batches."""
    finish_merges(spark, layers, cfg)
    return [merge_batches(spark, layers, group, cfg) for group in plan_merges(spark, layers, target_bytes)]
