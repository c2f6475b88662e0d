"""Absent readings of devices that each keep a time step of their own (off by default, not part of cleaning).

A device's step is the most frequent difference between its consecutive times, the smaller one of a tie. Times count in whole
`resolution` seconds, so a device-day holds at most 86,400 / resolution of them: that bounds each window over a device-day. The step from a
day to the next comes from a table of the days' first and last times, whose windows hold a device's calendar.
Differences are counted in the map tasks first. No grid is built, and nothing is joined but the steps, one row for each device.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.functions.quality import quoted

DAY = 86_400
# Absent times are listed in two steps of at most this many, so that one wild time puts no giant array into a row.
CHUNK = 10_000


def _seconds(df: DataFrame, cfg: SensorConfig, resolution: int) -> DataFrame:
    """(device, day, second): the distinct times of every device, in wall-clock seconds since 1970, cut to the resolution."""
    time = quoted(cfg.time)
    clock = f"hour({time}) * 3600 + minute({time}) * 60 + second({time})"
    second = f"datediff(to_date({time}), DATE'1970-01-01') * bigint({DAY}) + ({clock}) div {resolution} * {resolution}"
    kept = df.select(F.col(cfg.key), F.expr(second).alias("_s")).where(F.col(cfg.key).isNotNull() & F.col("_s").isNotNull())
    return kept.withColumn("_day", F.expr(f"floor(_s / {DAY})")).distinct()


def consecutive_times(df: DataFrame, cfg: SensorConfig = DEFAULT, resolution: int = 1) -> DataFrame:
    """(device, _s, _next): each time of a device and its next one, in seconds."""
    if not 1 <= resolution <= DAY:
        raise ValueError("resolution must be a second to a day")
    seen = _seconds(df, cfg, resolution)
    in_day = Window.partitionBy(cfg.key, "_day").orderBy("_s")
    inside = seen.select(cfg.key, "_s", F.lead("_s").over(in_day).alias("_next"))
    days = seen.groupBy(cfg.key, "_day").agg(F.min("_s").alias("_first"), F.max("_s").alias("_last"))
    over_days = Window.partitionBy(cfg.key).orderBy("_day")
    between = days.select(cfg.key, F.col("_last").alias("_s"), F.lead("_first").over(over_days).alias("_next"))
    return inside.where("_next IS NOT NULL").unionByName(between.where("_next IS NOT NULL"))


def _steps(pairs: DataFrame, cfg: SensorConfig) -> DataFrame:
    counts = pairs.groupBy(cfg.key, (F.col("_next") - F.col("_s")).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    step = F.max_by("_d", F.struct(F.col("_n"), -F.col("_d")))
    return counts.groupBy(cfg.key).agg(step.alias("step_seconds"), F.max("_n").alias("seen"), F.sum("_n").alias("differences"))


def device_steps(df: DataFrame, cfg: SensorConfig = DEFAULT, resolution: int = 1) -> DataFrame:
    """(device, step_seconds, seen, differences): each device's step, how often it occurs, and of how many differences.

    Devices with a single time have no step and no row.
    """
    return _steps(consecutive_times(df, cfg, resolution), cfg)


def _spans(df: DataFrame, cfg: SensorConfig, resolution: int) -> DataFrame:
    """(device, _s, _d, _n): after `_s`, `_n` readings are absent at steps of `_d` seconds."""
    pairs = consecutive_times(df, cfg, resolution)
    joined = pairs.join(_steps(pairs, cfg).select(cfg.key, F.col("step_seconds").alias("_d")), cfg.key)
    # a time counts as the nearest place of the grid that begins at the one before it
    absent = joined.withColumn("_n", F.expr("(2 * (_next - _s) + _d) div (2 * _d) - 1"))
    return absent.where("_n > 0").select(cfg.key, "_s", "_d", "_n")


def _as_time(df: DataFrame, cfg: SensorConfig, second: str) -> Column:
    kind = df.schema[cfg.time].dataType
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.expr(f"int(floor(({second}) / {DAY}))"))
    return day.cast(kind) + F.make_dt_interval(secs=F.expr(f"pmod({second}, {DAY})"))


def absent_spans(df: DataFrame, cfg: SensorConfig = DEFAULT, resolution: int = 1) -> DataFrame:
    """(device, first_absent, last_absent, step_seconds, absent): the stretches without readings, one row each."""
    spans = _spans(df, cfg, resolution)
    return spans.select(
        cfg.key, _as_time(df, cfg, "_s + _d").alias("first_absent"), _as_time(df, cfg, "_s + _n * _d").alias("last_absent"),
        F.col("_d").alias("step_seconds"), F.col("_n").alias("absent"),
    )


def absent_readings(df: DataFrame, cfg: SensorConfig = DEFAULT, resolution: int = 1) -> DataFrame:
    """(device, time) of every reading that a device's own step makes one expect between its first and last."""
    spans = _spans(df, cfg, resolution)
    chunks = spans.withColumn("_from", F.explode(F.expr(f"sequence(bigint(1), _n, bigint({CHUNK}))")))
    places = chunks.withColumn("_k", F.explode(F.expr(f"sequence(_from, least(_from + {CHUNK - 1}, _n))")))
    return places.select(cfg.key, _as_time(df, cfg, "_s + _k * _d").alias(cfg.time))


def with_absent_readings(df: DataFrame, cfg: SensorConfig = DEFAULT, resolution: int = 1) -> DataFrame:
    """All readings plus an empty row for every absent one, marked `_was_absent`."""
    empty = absent_readings(df, cfg, resolution).withColumn("_was_absent", F.lit(True))
    return df.withColumn("_was_absent", F.lit(False)).unionByName(empty, allowMissingColumns=True)
