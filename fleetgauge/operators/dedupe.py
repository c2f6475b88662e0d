"""One row per (device, time): the version ingested last."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.functions.quality import newest_first, quoted


def dedupe_readings(df: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """Keep the newest version of every reading.

    The `rank = 1` form lets Spark cut each group to one row per map task before the
    shuffle, so a reading with a huge number of copies never meets in one task.
    """
    reading = f"{quoted(cfg.key)}, {quoted(cfg.time)}"
    rank = f"row_number() OVER (PARTITION BY {reading} ORDER BY {newest_first(df, cfg)}) AS _version"
    return df.selectExpr("*", rank).filter("_version = 1").drop("_version")
