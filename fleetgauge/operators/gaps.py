"""Hours for which a device sent no row at all (off by default, not part of cleaning)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType

from fleetgauge.config import DEFAULT, SensorConfig


def _hour_start(day: Column, hour: Column, kind: DataType) -> Column:
    return day.cast(kind) + F.make_dt_interval(hours=hour)


def absent_hours(df: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """(device, hour) pairs without a reading, between each device's first and last hour.

    Each hour with readings is compared with the device's next one, and the hours between are listed; the
    full grid is never built. Readings shrink to distinct hours before they meet, so the window holds the
    hours of a calendar at most. Hours are listed by way of days, so that one wild timestamp cannot put
    a giant array into one row.
    """
    kind = df.schema[cfg.time].dataType
    seen = df.select(
        cfg.key, _hour_start(F.to_date(cfg.time), F.hour(cfg.time), kind).alias("_hour")
    ).distinct()
    hour = F.expr("INTERVAL '1' HOUR")
    following = F.lead("_hour").over(Window.partitionBy(cfg.key).orderBy("_hour"))
    gaps = seen.select(
        cfg.key, (F.col("_hour") + hour).alias("_from"), (following - hour).alias("_to")
    ).filter("_to >= _from")
    # Rows without device list nothing. A filter on the device would sink to the scan, and the readings
    # could then not share their dedupe shuffle with this branch in `with_absent_hours`.
    first_day = F.when(F.col(cfg.key).isNotNull(), F.to_date("_from"))
    days = gaps.withColumn("_day", F.explode(F.sequence(first_day, F.to_date("_to"))))
    hours = days.withColumn("_h", F.explode(F.sequence(F.lit(0), F.lit(23)))).withColumn(
        cfg.time, _hour_start(F.col("_day"), F.col("_h"), kind)
    )
    return hours.filter(F.col(cfg.time).between(F.col("_from"), F.col("_to"))).select(cfg.key, cfg.time)


def with_absent_hours(df: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """All readings plus an empty row for every absent hour, marked `_was_absent`."""
    empty = absent_hours(df, cfg).withColumn("_was_absent", F.lit(True))
    return df.withColumn("_was_absent", F.lit(False)).unionByName(empty, allowMissingColumns=True)
