"""Landing files to the bronze layer, file version by file version.

Bronze lies at `feed=<feed>/ingest_batch=<n>/date=<day>`. A batch is always written as a whole, so writing
it again after a crash replaces it. The ledger lists every file version already in bronze; a file changed
in place shows up with a new time or size and is read again. The copies this leaves are dropped by dedupe.

Columns are found by the names in each file's header. A file whose header names no column of the schema, or one twice,
is refused: it goes to the `refused_files` table with its reason and to the ledger, and the other files of its batch are
read. A file that cannot be read to its end is refused as a whole, once the batch has failed over it. A corrected file is a new
version and is read.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.functions.quality import with_day
from fleetgauge.session import require_utc
from fleetgauge.plans.ledger import batches, fold_if_many, ledger, of_batches, record_versions
from fleetgauge.plans.staging import Staging
from fleetgauge.sources.headers import damaged_files, file_layouts
from fleetgauge.sources.landing import BAD_LINE, FILE_SIZE, FILE_TIME, NAMES, VERSION, landing_versions, read_by_name
from fleetgauge.sources.layers import BRONZE, Layers, packed

_LOG = logging.getLogger(__name__)

FILES, STREAM = "files", "stream"
REFUSED = "refused_files"
# What Spark calls a failure while it reads a file, and the reason such a file is refused for.
UNREAD, DAMAGED = "FAILED_READ_FILE", "cannot be read to its end"
REFUSED_SCHEMA = (
    f"_source_file string, {FILE_TIME} timestamp, {FILE_SIZE} long, header string, reason string, "
    "feed string, ingest_batch int"
)
BRONZE_SCHEMA = (
    "timestamp timestamp, turbine_id int, wind_speed double, wind_direction int, power_output double, "
    f"_rescued_data string, _ingested_at timestamp, _source_file string, {FILE_TIME} timestamp, "
    f"{FILE_SIZE} long, feed string, ingest_batch int, date date"
)
BATCH_SCHEMA = BRONZE_SCHEMA.replace("feed string, ingest_batch int, ", "")
# The days of each bronze batch, so that a job opens only the folders it needs.
BATCH_DAYS = "batch_days"
BATCH_DAYS_SCHEMA = "date date, feed string, ingest_batch int"
# Batches the silver and gold layers already include, and the version of the values in force with them.
PROGRESS = "taken_in"
PROGRESS_SCHEMA = "feed string, ingest_batch int, snapshot string"


def batch_folder(layers: Layers, feed: str, batch: int) -> str:
    return f"{layers.path(BRONZE)}/feed={feed}/ingest_batch={batch}"


def write_batch(
    rows: DataFrame, layers: Layers, feed: str, batch: int, cfg: SensorConfig = DEFAULT
) -> None:
    """Write one bronze batch; the same number again replaces it."""
    require_utc(rows.sparkSession)
    (
        packed(with_day(rows, cfg), cfg.day)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", layers.rows_per_file)
        .partitionBy(cfg.day)
        .parquet(batch_folder(layers, feed, batch))
    )
    days = read_batch(rows.sparkSession, layers, feed, batch).select(F.col(cfg.day).alias("date")).distinct()
    days.write.mode("overwrite").parquet(f"{layers.path(BATCH_DAYS)}/feed={feed}/ingest_batch={batch}")


def read_batch(spark: SparkSession, layers: Layers, feed: str, batch: int) -> DataFrame:
    """One bronze batch with the file version of every row."""
    return spark.read.schema(BATCH_SCHEMA).parquet(batch_folder(layers, feed, batch))


def pending_versions(spark: SparkSession, layers: Layers, landing: str) -> DataFrame:
    """Files in the landing folder whose present version is not in the ledger."""
    return landing_versions(spark, landing).join(ledger(spark, layers).select(*VERSION), VERSION, "left_anti")


def next_batch(spark: SparkSession, layers: Layers, feed: str = FILES) -> int:
    last = batches(spark, layers).filter(F.col("feed") == feed).agg(F.max("ingest_batch"))
    return (last.first()[0] or 0) + 1


def take_files(
    spark: SparkSession, layers: Layers, versions: DataFrame, feed: str, batch: int, cfg: SensorConfig = DEFAULT
) -> None:
    """Bring the listed files into one bronze batch, all but the refused ones, and enter all in the ledger.

    `versions` is small and cheap to read again: its file names pass through the driver, as in any Spark file read.
    Writing the same batch again replaces it, refusals included.
    """
    paths = {row["_source_file"]: row["path"] for row in versions.select("_source_file", "path").collect()}
    if not paths:
        return
    layouts, found = file_layouts(spark, paths, NAMES, [BAD_LINE])

    def write_rows() -> None:
        rows = read_by_name(spark, paths, layouts, cfg)
        write_batch(no_readings(spark, cfg) if rows is None else rows, layers, feed, batch, cfg)

    try:
        write_rows()
    except Exception as failure:
        damaged = damaged_files(spark, list(layouts)) if UNREAD in str(failure) else []
        if not damaged:
            raise
        for name, damage in damaged:
            found.append((name, ",".join(layouts.pop(name).names), f"{DAMAGED}: {damage}"))
        write_rows()
    refused = spark.createDataFrame(found, "_source_file string, header string, reason string")
    (
        versions.drop("path").join(refused, "_source_file")
        .select(*VERSION, "header", "reason")
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(f"{layers.path(REFUSED)}/feed={feed}/ingest_batch={batch}")
    )
    for name, _, reason in found:
        _LOG.warning("refused %s: %s", name, reason)
    names = refused.select("_source_file", F.lit(True).alias("refused"))
    record_versions(versions.join(names, "_source_file", "left"), layers, feed, batch)


def no_readings(spark: SparkSession, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """An empty table shaped like `read_landing`."""
    return spark.createDataFrame([], BATCH_SCHEMA).drop(cfg.day)


def refused(spark: SparkSession, layers: Layers) -> DataFrame:
    """The files that were refused so far, with their first line and the reason."""
    return layers.read(spark, REFUSED, REFUSED_SCHEMA)


def ingest_files(
    spark: SparkSession,
    layers: Layers,
    landing: str,
    cfg: SensorConfig = DEFAULT,
    files_per_batch: int = 10_000,
) -> int:
    """Bring every new or changed file into bronze; returns the number of batches written.

    The folder is listed once. The work list is written, cut into parts of at most `files_per_batch` files; one part at
    a time passes through the driver, besides Spark's own listing.
    """
    return take_pending(spark, layers, pending_versions(spark, layers, landing), FILES, cfg, files_per_batch)


def take_pending(
    spark: SparkSession, layers: Layers, versions: DataFrame, feed: str, cfg: SensorConfig = DEFAULT, files_per_batch: int = 10_000
) -> int:
    """Bring the file versions into bronze, in batches of at most `files_per_batch` files; returns their number."""
    with Staging(spark, layers) as staging:
        pending = staging.keep(versions, "pending")
        files = pending.count()
        if not files:
            return 0
        work = staging.keep(_in_parts(pending, files, files_per_batch), "work", by="part")
        parts = [row["part"] for row in work.select("part").distinct().orderBy("part").collect()]
        first = next_batch(spark, layers, feed)
        for number, part in enumerate(parts):
            take_files(spark, layers, work.filter(F.col("part") == part).drop("part"), feed, first + number, cfg)
    fold_if_many(spark, layers)
    return len(parts)


def _in_parts(pending: DataFrame, files: int, files_per_batch: int) -> DataFrame:
    """Number parts of at most `files_per_batch` files, in name order within groups of about a hundred parts,
    so that no task sorts the names of a whole backlog."""
    groups = -(-files // (100 * files_per_batch))
    group = F.pmod(F.xxhash64("_source_file"), F.lit(groups))
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_source_file")) - 1
    part = F.col("_group") * 1_000_000 + F.floor(place / files_per_batch)
    return pending.withColumn("_group", group).withColumn("part", part.cast("long")).drop("_group")


def read_bronze(spark: SparkSession, layers: Layers) -> DataFrame:
    """Bronze readings as delivered, without the columns that only serve the layout."""
    return bronze_by_day(spark, layers).drop("feed", "ingest_batch", "date")


def bronze_by_day(spark: SparkSession, layers: Layers) -> DataFrame:
    """Bronze readings with feed, batch and day, for pruning. Lists the whole table; see `bronze_on_days`."""
    return layers.read(spark, BRONZE, BRONZE_SCHEMA).drop(FILE_TIME, FILE_SIZE)


def _bronze_folders(spark: SparkSession, layers: Layers, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], BRONZE_SCHEMA).drop(FILE_TIME, FILE_SIZE)
    reader = spark.read.schema(BRONZE_SCHEMA).option("basePath", layers.path(BRONZE))
    return reader.parquet(*folders).drop(FILE_TIME, FILE_SIZE)


def bronze_of_batches(spark: SparkSession, layers: Layers, wanted: Sequence[tuple[str, int]]) -> DataFrame:
    """Bronze readings of the given batches; no other folder is listed."""
    return _bronze_folders(spark, layers, [batch_folder(layers, feed, batch) for feed, batch in wanted])


def bronze_on_days(spark: SparkSession, layers: Layers, days: Iterable[date | None]) -> DataFrame:
    """Bronze readings of the given days from all batches; no other folder is listed.

    The folder names pass through the driver: one for each batch that holds rows of a day.
    """
    wanted = spark.createDataFrame([(day,) for day in days], "wanted date")
    held = layers.read(spark, BATCH_DAYS, BATCH_DAYS_SCHEMA)
    found = held.join(wanted, F.col("date").eqNullSafe(F.col("wanted")), "left_semi").distinct().collect()
    return _bronze_folders(spark, layers, [
        f"{batch_folder(layers, row['feed'], row['ingest_batch'])}/date={row['date'] or '__HIVE_DEFAULT_PARTITION__'}"
        for row in found
    ])


def batch_bytes(
    spark: SparkSession, layers: Layers, wanted: Sequence[tuple[str, int]] | None = None
) -> int:
    """Bytes of the landing files behind the given batches, or behind all of bronze."""
    found = batches(spark, layers)
    if wanted is not None:
        found = found.filter(of_batches(wanted))
    return found.agg(F.sum("bytes")).first()[0] or 0


def mark_taken_in(
    spark: SparkSession, layers: Layers, taken: Sequence[tuple[str, int]], snapshot: str | None = None
) -> None:
    """Note that the clean layers include these batches, and which values are in force from now on."""
    rows = [(feed, batch, snapshot) for feed, batch in taken] or [(None, None, snapshot)]
    marks = spark.createDataFrame(rows, PROGRESS_SCHEMA).withColumn("taken_at", F.current_timestamp())
    layers.append(marks.coalesce(1), PROGRESS)


def snapshot_in_force(spark: SparkSession, layers: Layers) -> str | None:
    """The version of the values in force that was noted last."""
    marks = layers.read(spark, PROGRESS, PROGRESS_SCHEMA + ", taken_at timestamp").filter("snapshot IS NOT NULL")
    return marks.agg(F.max_by("snapshot", "taken_at")).first()[0]


def new_batches(spark: SparkSession, layers: Layers) -> list[tuple[str, int]]:
    """Ingested batches the clean layers do not include yet."""
    known = batches(spark, layers).select("feed", "ingest_batch")
    taken = layers.read(spark, PROGRESS, PROGRESS_SCHEMA)
    left = known.join(taken, ["feed", "ingest_batch"], "left_anti").orderBy("feed", "ingest_batch")
    return [(row["feed"], row["ingest_batch"]) for row in left.collect()]
