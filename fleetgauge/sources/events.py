"""Readings derived from the `events` test table, which stands in for a sensor feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetgauge.session import input_bytes, size_shuffles


# Which events become which dirty value, checked in this order.
_POWER = """CASE WHEN event_id < 60 OR event_id % 83 = 0 THEN NULL WHEN event_id % 79 = 0 THEN double('NaN')
  WHEN event_id % 89 = 0 THEN -value ELSE value END"""
_SPEED = """CASE WHEN event_id % 107 = 0 THEN NULL WHEN event_id % 103 = 0 THEN double('NaN')
  WHEN event_id % 97 = 0 THEN -3.2D WHEN event_id % 101 = 0 THEN 150D
  ELSE double((event_id * 37) % 200) / 10 END"""
_DIRECTION = """int(CASE WHEN event_id % 127 = 0 THEN NULL WHEN event_id % 109 = 0 THEN 400
  WHEN event_id % 113 = 0 THEN -15 ELSE (event_id * 53) % 360 END)"""


def event_readings(spark: SparkSession, folder: str) -> DataFrame:
    """One reading per event: ten users make a device, times are cut to the hour.

    Cutting to the hour yields real duplicates and gaps; dirt follows from the event number. A
    device-day holds at most 24 readings after dedupe, which bounds every window over it.
    """
    events = spark.read.parquet(f"{folder}/events.parquet")
    size_shuffles(spark, input_bytes(events))
    return events.selectExpr(
        "CAST(to_date(ts) AS timestamp_ntz) + make_dt_interval(0, hour(ts)) AS timestamp",
        "int(floor(user_id / 10)) + 1 AS turbine_id",
        f"{_SPEED} AS wind_speed",
        f"{_DIRECTION} AS wind_direction",
        f"{_POWER} AS power_output",
        "ts AS _ingested_at",
        "concat('data_group_', string(int(floor(floor(user_id / 10) / 5)) + 1), '.csv') AS _source_file",
        "event_id",
    )


def event_text(spark: SparkSession, folder: str, rows: str = "true") -> DataFrame:
    """The same feed as text, as a landing file would hold it, with values that do not parse; `rows` picks events."""
    return event_readings(spark, folder).filter(rows).selectExpr(
        "CASE WHEN event_id % 211 = 0 THEN 'bad' ELSE date_format(timestamp, 'yyyy-MM-dd HH:mm:ss') END AS timestamp",
        "CASE WHEN event_id % 307 = 0 THEN 'T-7' ELSE string(turbine_id) END AS turbine_id",
        "string(wind_speed) AS wind_speed",
        "CASE WHEN event_id % 113 = 0 THEN '180.5' WHEN event_id % 109 = 0 THEN 'abc' "
        "ELSE string(wind_direction) END AS wind_direction",
        "CASE WHEN event_id % 223 = 0 THEN 'n/a' ELSE string(power_output) END AS power_output",
        "string(NULL) AS _line",
    )
