"""Silver and gold: the full build, and the refresh that only touches days that change.

The full build recomputes everything from bronze. The refresh takes in new bronze batches and recomputes

* the days that received rows, and
* later days on which a device of the new batches starts from other values than before.

Two small tables carry the fill from day to day. `day_values` holds for each device-day with rows its last valid
values, its opening values (in force before the day) and its number of rows, partitioned by day; readings without a time
are the partition without a day, before all others. `values_in_force` holds the last valid values of every device, however long ago
they came. A device goes on from the opening of its first stored day at or after its new rows, or else from the values in force, so
nothing before the first touched day is read. Only days that change are written. New readings without a time make the refresh read
the day values of those devices from the start on, but it still writes only days on which an opening changed.

Every write replaces whole partitions. The values in force are written as a new version, which the mark of the batches
names, last of all: a run that stopped half-way is simply run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.functions.quality import quoted, with_day
from fleetgauge.operators.anomalies import day_stats, flag_anomalies
from fleetgauge.operators.clean import flagged_readings
from fleetgauge.operators.fill import cell_tails, fill_from_openings, opening_values
from fleetgauge.operators.residuals import warn_remaining, watch_nulls
from fleetgauge.operators.summary import daily_summary
from fleetgauge.plans.ingest import (
    batch_bytes, bronze_of_batches, bronze_on_days, ingest_files, mark_taken_in, new_batches, read_bronze,
    snapshot_in_force,
)
from fleetgauge.plans.staging import Staging
from fleetgauge.session import require_utc, size_shuffles
from fleetgauge.sources.layers import ANOMALIES, SILVER, SUMMARY, Layers, packed, remove_folder

DAY_VALUES, IN_FORCE = "day_values", "values_in_force"
NULL_REPORT = "remaining_nulls"
ROWS = "row_count"


def _busy(values: DataFrame, cfg: SensorConfig) -> DataFrame | None:
    """Device-days too big for one task, from written day values, or None if there are none (the usual case)."""
    found = values.filter(F.col(ROWS) > cfg.busy_day_rows).select(cfg.key, cfg.day)
    return None if found.isEmpty() else found


def _openings(values: DataFrame, cfg: SensorConfig) -> DataFrame:
    return values.select(cfg.key, cfg.day, *[F.col(f"open_{n}").alias(n) for n in cfg.value_names])


def write_silver(
    cleaned: DataFrame, layers: Layers, cfg: SensorConfig = DEFAULT, only_touched: bool = False
) -> dict[str, int]:
    """Write silver by day in even files; reports, warns about and returns the NULLs left in it."""
    require_utc(cleaned.sparkSession)
    rows, watch = watch_nulls(sorted_days(cleaned, cfg), cfg=cfg)
    layers.overwrite(rows, SILVER, [cfg.day], only_touched)
    counts = {name: watch.get[name] for name in cfg.value_names}
    warn_remaining(counts)
    report = cleaned.sparkSession.createDataFrame(list(counts.items()), "column_name string, null_count long")
    layers.append(report.withColumn("reported_at", F.current_timestamp()).coalesce(1), NULL_REPORT)
    return counts


def sorted_days(df: DataFrame, cfg: SensorConfig) -> DataFrame:
    """Rows packed by day and sorted by device in each file, so that a query for one device skips most
    row groups. The write needs the sort by day anyway."""
    return packed(df, cfg.day).sortWithinPartitions(cfg.day, cfg.key, cfg.time)


def build_silver(
    spark: SparkSession, layers: Layers, cfg: SensorConfig = DEFAULT
) -> dict[str, int]:
    """Recompute silver, and the values that a later refresh goes on from, from all of bronze.

    Bronze is read once: the flagged readings are staged, and day values, busy days and the fill come from them.
    """
    size_shuffles(spark, batch_bytes(spark, layers))
    with Staging(spark, layers) as staging:
        readings = staging.keep(with_day(flagged_readings(read_bronze(spark, layers), cfg), cfg), "flagged")
        tails = staging.keep(cell_tails(readings, [cfg.key, cfg.day], cfg, counted=ROWS), "tails")
        known = tails.withColumns({f"tail_{n}": F.col(n) for n in cfg.value_names})
        values = staging.keep(_opened(known, None, cfg), "day_values")
        counts = write_silver(fill_from_openings(readings, _openings(values, cfg), cfg, _busy(values, cfg)), layers, cfg)
        layers.overwrite(packed(values, cfg.day), DAY_VALUES, [cfg.day])
        _publish(spark, layers, _last_values(values, None, cfg), [])
    return counts


def build_gold(spark: SparkSession, layers: Layers, cfg: SensorConfig = DEFAULT) -> None:
    """Recompute both gold tables from all of silver."""
    silver = layers.read(spark, SILVER)
    layers.overwrite(packed(daily_summary(silver, cfg), cfg.day), SUMMARY, [cfg.day])
    with Staging(spark, layers) as staging:
        stats = staging.keep(day_stats(silver, cfg), "day_stats")
        layers.overwrite(sorted_days(flag_anomalies(silver, cfg, stats), cfg), ANOMALIES, [cfg.day])


def build_all(spark: SparkSession, layers: Layers, cfg: SensorConfig = DEFAULT) -> dict[str, int]:
    """Recompute silver and gold and mark the batches known at the start, so that a refresh has nothing left to do."""
    batches = new_batches(spark, layers)
    counts = build_silver(spark, layers, cfg)
    build_gold(spark, layers, cfg)
    if batches:
        mark_taken_in(spark, layers, batches)
    return counts


def _on_days(df: DataFrame, days: Iterable[date | None], cfg: SensorConfig) -> DataFrame:
    """Rows of the given days, by a condition that prunes partitions."""
    days = list(days)
    dated = [d for d in days if d is not None]
    wanted: Column = F.col(cfg.day).isin(dated) if dated else F.lit(False)
    if None in days:
        wanted = wanted | F.col(cfg.day).isNull()
    return df.filter(wanted)


def _days_of(df: DataFrame, cfg: SensorConfig) -> list[date | None]:
    """The distinct days of a table: as many as the calendar has, at most."""
    return [row[0] for row in df.select(cfg.day).distinct().collect()]


def _kinds(cfg: SensorConfig, readings: DataFrame) -> tuple[str, str]:
    """Schemas of the day values and of the values in force."""
    kinds = {f.name: f.dataType.simpleString() for f in readings.schema.fields}
    key = f"{cfg.key} {kinds[cfg.key]}"
    values = ", ".join(f"tail_{n} {kinds[n]}, open_{n} {kinds[n]}" for n in cfg.value_names)
    plain = ", ".join(f"{n} {kinds[n]}" for n in cfg.value_names)
    return f"{key}, {ROWS} long, {values}, {cfg.day} date", f"{key}, {plain}"


def _position(cfg: SensorConfig) -> Column:
    """Place of a day in a device's order; readings without a time come before all days."""
    return F.coalesce(F.unix_date(cfg.day).cast("long"), F.lit(-(2**40)))


def _same_key(left: DataFrame, right: DataFrame, cfg: SensorConfig) -> Column:
    return left[cfg.key].eqNullSafe(right["_key"])


def _opened(rows: DataFrame, start: DataFrame | None, cfg: SensorConfig) -> DataFrame:
    """Day values with their openings, from the tails of each device's days and the values in force before them."""
    opened = opening_values(rows.withColumns({n: F.col(f"tail_{n}") for n in cfg.value_names}), cfg, start=start)
    return opened.withColumnsRenamed({n: f"open_{n}" for n in cfg.value_names})


def _last_values(values: DataFrame, start: DataFrame | None, cfg: SensorConfig) -> DataFrame:
    """Values in force after the given days of each device."""
    names = cfg.value_names
    rows = values.select(cfg.key, _position(cfg).alias("_at"), *[F.col(f"tail_{n}").alias(n) for n in names])
    if start is not None:
        rows = rows.unionByName(start.select(cfg.key, F.lit(-(2**41)).alias("_at"), *names))
    last = [F.expr(f"max_by({quoted(n)}, _at) FILTER (WHERE {quoted(n)} IS NOT NULL) AS {quoted(n)}") for n in names]
    return rows.groupBy(cfg.key).agg(*last)


def _newer(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """Rows of `new`, and those of `old` whose key columns (NULL is a key too) are not in it."""
    rest = [c for c in old.columns if c not in by]
    both = old.withColumn("_new", F.lit(0)).unionByName(new.select(*old.columns).withColumn("_new", F.lit(1)))
    picked = both.groupBy(*by).agg(F.max_by(F.struct(*rest), "_new").alias("_row"))
    return picked.select(*by, "_row.*").select(*old.columns)


def _in_force(spark: SparkSession, layers: Layers, schema: str) -> DataFrame:
    version = snapshot_in_force(spark, layers)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{layers.path(IN_FORCE)}/{version}")


def _publish(spark: SparkSession, layers: Layers, values: DataFrame, batches: list[tuple[str, int]]) -> None:
    """Write the values in force as a new version and name it in the mark; the version before goes."""
    before, version = snapshot_in_force(spark, layers), uuid.uuid4().hex
    packed(values).write.parquet(f"{layers.path(IN_FORCE)}/{version}")
    mark_taken_in(spark, layers, batches, version)
    if before:
        remove_folder(spark, f"{layers.path(IN_FORCE)}/{before}")


def _moved_values(
    old: DataFrame, in_force: DataFrame, tails: DataFrame, moved: DataFrame, staging: Staging, cfg: SensorConfig
) -> tuple[DataFrame, DataFrame]:
    """Day values of the devices in the new batches, each from its first new day on, with their openings as stored
    (`was_*`, `stored`); and the values in force before that day."""
    names = cfg.value_names
    first = moved.withColumnRenamed(cfg.key, "_key")

    def onward(df: DataFrame) -> DataFrame:
        return df.join(first, _same_key(df, first, cfg) & (_position(cfg) >= F.col("_first"))).drop("_key", "_first")

    stored = staging.keep(onward(old), "stored")
    begun = stored.groupBy(cfg.key).agg(
        F.min_by(F.struct(*[F.col(f"open_{n}").alias(n) for n in names]), _position(cfg)).alias("_row")
    ).select(cfg.key, "_row.*")
    silent = in_force.join(first, _same_key(in_force, first, cfg), "left_semi")
    start = staging.keep(_newer(silent, begun, [cfg.key]), "start")

    was = stored.withColumnsRenamed({f"open_{n}": f"was_{n}" for n in names}).withColumn("stored", F.lit(True))
    now = onward(tails).withColumnsRenamed({n: f"tail_{n}" for n in names}).withColumn("_now", F.lit(True))
    fresh = "coalesce(bool_or(_now), false)"
    rows = was.unionByName(now, allowMissingColumns=True).groupBy(cfg.key, cfg.day).agg(
        F.expr("coalesce(bool_or(stored), false) AS stored"),
        *[
            F.expr(f"CASE WHEN {fresh} THEN max({quoted(n)}) FILTER (WHERE _now) ELSE max({quoted(n)}) END AS {quoted(n)}")
            for n in [ROWS, *[f"tail_{n}" for n in names]]
        ],
        *[F.expr(f"max({quoted(f'was_{n}')}) AS {quoted(f'was_{n}')}") for n in names],
    )
    return staging.keep(_opened(rows, start, cfg), "moved_values"), start


def _days_with_new_openings(moved: DataFrame, touched: list[date | None], cfg: SensorConfig) -> list[date | None]:
    """Days without new rows on which a device starts from other values than before."""
    changed = F.lit(False)
    for n in cfg.value_names:
        changed = changed | ~F.col(f"was_{n}").eqNullSafe(F.col(f"open_{n}"))
    return [d for d in _days_of(moved.filter(F.col("stored") & changed), cfg) if d not in touched]


def _write_gold_days(
    spark: SparkSession,
    layers: Layers,
    staging: Staging,
    schema: StructType,
    days: list[date | None],
    cfg: SensorConfig,
) -> None:
    chosen = set(days).__contains__
    silver = layers.read_days(spark, SILVER, schema, chosen, cfg.day)
    layers.overwrite(packed(daily_summary(silver, cfg), cfg.day), SUMMARY, [cfg.day], only_touched=True)
    found = flag_anomalies(silver, cfg, staging.keep(day_stats(silver, cfg), "day_stats"))
    layers.overwrite(sorted_days(found, cfg), ANOMALIES, [cfg.day], only_touched=True)
    # A day whose last real reading was corrected away has no rows to replace its old ones with.
    real = silver.filter(~F.col(f"{cfg.target}_was_imputed") & F.col(cfg.key).isNotNull())
    present = layers.read_days(spark, ANOMALIES, found.schema, chosen, cfg.day)
    for day in set(_days_of(present, cfg)) - set(_days_of(real, cfg)):
        found.limit(0).drop(cfg.day).write.mode("overwrite").parquet(
            f"{layers.path(ANOMALIES)}/{cfg.day}={day}"
        )


def refresh(spark: SparkSession, layers: Layers, cfg: SensorConfig = DEFAULT) -> list[date | None]:
    """Take new bronze batches into silver and gold; returns the days rewritten."""
    batches = new_batches(spark, layers)
    if not batches:
        return []
    size_shuffles(spark, batch_bytes(spark, layers, batches))
    fresh = bronze_of_batches(spark, layers, batches)
    touched = _days_of(fresh, cfg)
    if not touched:
        mark_taken_in(spark, layers, batches)
        return []

    def flagged_on(days: list[date | None]) -> DataFrame:
        return flagged_readings(bronze_on_days(spark, layers, days).drop("feed", "ingest_batch"), cfg)

    with Staging(spark, layers) as staging:
        flagged = staging.keep(flagged_on(touched), "flagged")
        value_kinds, plain_kinds = _kinds(cfg, flagged)
        first = None if None in touched else min(touched)
        old = layers.read_days(spark, DAY_VALUES, value_kinds, lambda d: first is None or d is not None and d >= first, cfg.day)
        in_force = _in_force(spark, layers, plain_kinds)
        tails = cell_tails(flagged, [cfg.key, cfg.day], cfg, counted=ROWS)
        moved = staging.keep(fresh.groupBy(cfg.key).agg(F.min(_position(cfg)).alias("_first")), "moved")
        moved_values, start = _moved_values(old, in_force, tails, moved, staging, cfg)
        changed = _days_with_new_openings(moved_values, touched, cfg)
        days = touched + changed

        new = _on_days(moved_values, days, cfg).select(*old.columns)
        same_days = layers.read_days(spark, DAY_VALUES, value_kinds, set(days).__contains__, cfg.day)
        values = staging.keep(_newer(same_days, new, [cfg.key, cfg.day]), "day_values")
        last = _newer(in_force, _last_values(moved_values, start, cfg), [cfg.key])
        readings = flagged.unionByName(flagged_on(changed)) if changed else flagged
        cleaned = fill_from_openings(readings, _openings(values, cfg), cfg, _busy(values, cfg))
        write_silver(cleaned, layers, cfg, only_touched=True)
        _write_gold_days(spark, layers, staging, cleaned.schema, days, cfg)
        layers.overwrite(packed(values, cfg.day), DAY_VALUES, [cfg.day], only_touched=True)
        _publish(spark, layers, last, batches)
    return days


def run_all(
    spark: SparkSession, layers: Layers, landing: str, cfg: SensorConfig = DEFAULT, full: bool = False
) -> None:
    """One daily run: landing files to bronze, then silver and gold, by refresh or in `full`."""
    ingest_files(spark, layers, landing, cfg)
    if full:
        build_all(spark, layers, cfg)
    else:
        refresh(spark, layers, cfg)
