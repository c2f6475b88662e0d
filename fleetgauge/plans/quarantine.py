"""Bad lines set aside with the file version they came in, and released when the file is corrected.

`set_aside` copies the lines of new bronze batches that cannot be trusted to the quarantine table, batch by batch; running it again replaces the
same batch. Values of columns that only the file has are no fault. A line is known by its file, the version of the file, and its content; equal lines of a version are one row with their count.

Whether a line is still open follows from the ledger: when a newer version of its file has been read, the lines of older versions are released, and
those that are still bad stand there anew under the new version. So a corrected file empties its quarantine, whatever became of the
line. A version that was refused releases nothing, because none of its lines was read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.operators.quarantine import split_quarantine
from fleetgauge.plans.ingest import BATCH_SCHEMA, read_batch
from fleetgauge.plans.ledger import batches as known_batches, ledger, newest_versions
from fleetgauge.sources.landing import FILE_SIZE, FILE_TIME, NAMES, VERSION
from fleetgauge.sources.layers import Layers

QUARANTINE, SET_ASIDE = "quarantined_lines", "batches_set_aside"
SET_ASIDE_SCHEMA = "feed string, ingest_batch int"
_CONTENT = [*NAMES, "_rescued_data"]
QUARANTINE_SCHEMA = (
    BATCH_SCHEMA.replace(", date date", "") + ", _reason string, line_key long, copies long, feed string, ingest_batch int"
)


def set_aside(
    spark: SparkSession, layers: Layers, batches: Sequence[tuple[str, int]] | None = None, cfg: SensorConfig = DEFAULT
) -> list[tuple[str, int]]:
    """Copy the bad lines of the given bronze batches, or of all not looked at yet, to quarantine; returns the batches."""
    if batches is None:
        known = known_batches(spark, layers).select("feed", "ingest_batch")
        done = layers.read(spark, SET_ASIDE, SET_ASIDE_SCHEMA)
        left = known.join(done, ["feed", "ingest_batch"], "left_anti").orderBy("feed", "ingest_batch")
        batches = [(row["feed"], row["ingest_batch"]) for row in left.collect()]
    for feed, batch in batches:
        bad = split_quarantine(read_batch(spark, layers, feed, batch).drop(cfg.day), cfg, extras_are_faults=False)[1]
        lines = bad.withColumn("line_key", F.xxhash64(*_CONTENT))
        names = [c for c in lines.columns if c != "line_key"]
        counted = lines.groupBy(*names, "line_key").agg(F.count(F.lit(1)).alias("copies"))
        counted.write.mode("overwrite").option("maxRecordsPerFile", layers.rows_per_file).parquet(
            f"{layers.path(QUARANTINE)}/feed={feed}/ingest_batch={batch}"
        )
        layers.append(spark.createDataFrame([(feed, batch)], SET_ASIDE_SCHEMA).coalesce(1), SET_ASIDE)
    return list(batches)


def versions_in_force(spark: SparkSession, layers: Layers) -> DataFrame:
    """(_source_file, _newest, _newest_size): of each file the version that was read last; refused ones do not count."""
    read = ledger(spark, layers).where("NOT coalesce(refused, false)")
    return newest_versions(read).select("_source_file", F.col(FILE_TIME).alias("_newest"), F.col(FILE_SIZE).alias("_newest_size"))


def quarantined(spark: SparkSession, layers: Layers) -> DataFrame:
    """Every line set aside so far: its content, `_reason`, `copies`, `since` and `released_by`.

    `since` is the time of the first version of the file that had this very line; `released_by` the time of the version that replaced the
    line's own, NULL while it is open. Lines without a file, or of a file that the ledger does not know, stay open.
    """
    lines = layers.read(spark, QUARANTINE, QUARANTINE_SCHEMA).drop("feed", "ingest_batch")
    lines = lines.dropDuplicates([*VERSION, "line_key", "_reason"])
    same_line = Window.partitionBy("_source_file", "line_key")
    lines = lines.withColumn("since", F.min(FILE_TIME).over(same_line))
    marked = lines.join(versions_in_force(spark, layers), "_source_file", "left")
    replaced = (F.col("_newest") != F.col(FILE_TIME)) | (F.col("_newest_size") != F.col(FILE_SIZE))
    return marked.withColumn("released_by", F.when(replaced, F.col("_newest"))).select(
        *_CONTENT, "_ingested_at", *VERSION, "_reason", "line_key", "copies", "since", "released_by"
    )


def open_quarantine(spark: SparkSession, layers: Layers) -> DataFrame:
    """The lines that wait for a corrected file."""
    return quarantined(spark, layers).where("released_by IS NULL").drop("released_by")


def quarantine_report(spark: SparkSession, layers: Layers) -> DataFrame:
    """(_source_file, _reason, open_lines, released_lines, oldest): one row for each file and reason."""
    open_ = F.col("released_by").isNull()
    return quarantined(spark, layers).groupBy("_source_file", "_reason").agg(
        F.coalesce(F.sum(F.when(open_, F.col("copies"))), F.lit(0)).alias("open_lines"),
        F.coalesce(F.sum(F.when(~open_, F.col("copies"))), F.lit(0)).alias("released_lines"),
        F.min(F.when(open_, F.col("since"))).alias("oldest"),
    )
