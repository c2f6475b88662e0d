"""Questions asked of the finished tables. `turbine=None` answers for the whole fleet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.functions.quality import any_flag
from fleetgauge.operators.anomalies import with_verdict


def _one(df: DataFrame, turbine: int | None) -> DataFrame:
    return df if turbine is None else df.filter(F.col("turbine_id") == F.lit(turbine))


def turbine_list(df: DataFrame) -> DataFrame:
    """Every device, in order. Works on any table with the device column."""
    return df.select("turbine_id").distinct().orderBy("turbine_id")


def turbine_daily(summary: DataFrame, turbine: int | None = None) -> DataFrame:
    """Daily summary by date."""
    return _one(summary, turbine).orderBy("turbine_id", "date")


def turbine_anomalies(anomalies: DataFrame, turbine: int | None = None) -> DataFrame:
    """Anomalous readings by time."""
    return (
        _one(anomalies, turbine)
        .filter("is_anomaly")
        .select("turbine_id", "date", "timestamp", "power_output")
        .orderBy("turbine_id", "timestamp")
    )


def turbine_kpis(summary: DataFrame, anomalies: DataFrame, turbine: int | None = None) -> DataFrame:
    """Days, filled readings, anomalies and the unweighted mean of daily means, per device.

    A device asked for by number always has its row, of zeros and no mean if nothing is known of it.
    """
    days = _by_device(_one(summary, turbine), turbine).agg(
        F.count(F.lit(1)).alias("days_of_data"),
        F.coalesce(F.sum("imputed_count"), F.lit(0)).alias("total_imputed"),
        F.avg("avg_power_output").alias("mean_daily_power"),
    )
    if turbine is not None:
        days = _named(days, turbine, summary.schema["turbine_id"].dataType)
    found = anomaly_counts(_one(anomalies, turbine))
    return days.join(found, "turbine_id", "left").select(
        "turbine_id", "days_of_data", "total_imputed",
        F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"), "mean_daily_power",
    )


def turbine_kpis_in_one_pass(
    silver: DataFrame, turbine: int | None = None, cfg: SensorConfig = DEFAULT
) -> DataFrame:
    """`turbine_kpis` straight from clean readings that are not written yet (see `with_verdict`)."""
    days = with_verdict(_one(silver, turbine), cfg).groupBy(cfg.key, cfg.day).agg(
        F.avg(cfg.target).alias("_mean"),
        F.count_if(F.col(f"{cfg.target}_was_imputed")).alias("_imputed"),
        F.count_if("is_anomaly").alias("_anomalies"),
    )
    found = _by_device(days, turbine, cfg.key).agg(
        F.count(F.lit(1)).alias("days_of_data"),
        F.coalesce(F.sum("_imputed"), F.lit(0)).alias("total_imputed"),
        F.coalesce(F.sum("_anomalies"), F.lit(0)).alias("anomaly_count"),
        F.avg("_mean").alias("mean_daily_power"),
    )
    return found if turbine is None else _named(found, turbine, silver.schema[cfg.key].dataType, cfg.key)


def _by_device(df: DataFrame, turbine: int | None, key: str = "turbine_id") -> GroupedData:
    """Groups of devices; of one device a single group, which has a result even without rows."""
    return df.groupBy(key) if turbine is None else df.groupBy()


def _named(df: DataFrame, turbine: int, kind: DataType, key: str = "turbine_id") -> DataFrame:
    return df.select(F.lit(turbine).cast(kind).alias(key), "*")


def fleet_quality(silver: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """Rows per device with any value missing, any value impossible, or a filled target."""
    return silver.groupBy("turbine_id").agg(
        F.count_if(F.expr(any_flag(cfg, "was_missing"))).alias("missing_count"),
        F.count_if(F.expr(any_flag(cfg, "was_invalid"))).alias("invalid_count"),
        F.count_if(F.col(f"{cfg.target}_was_imputed")).alias("imputed_count"),
        F.count(F.lit(1)).alias("total_readings"),
    )


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    """Anomalies per device; devices without any are absent."""
    return anomalies.filter("is_anomaly").groupBy("turbine_id").agg(
        F.count(F.lit(1)).alias("anomaly_count")
    )


def flakiest(quality: DataFrame, top: int = 5) -> DataFrame:
    """Devices with the highest share of issues, from `fleet_quality`; ties go to the lower id.

    A row can be both missing and invalid in different columns, so the share can exceed 1.
    """
    issues = F.col("missing_count") + F.col("invalid_count")
    return (
        quality.select(
            "turbine_id", (issues / F.col("total_readings")).alias("issue_rate"),
            "missing_count", "invalid_count", "total_readings",
        )
        .orderBy(F.col("issue_rate").desc(), "turbine_id")
        .limit(top)
    )


def invalid_direction_rows(silver: DataFrame, turbine: int | None = None) -> DataFrame:
    """Clean readings whose wind direction arrived out of range."""
    return _one(silver, turbine).filter("wind_direction_was_invalid")


def anomalous_rows(anomalies: DataFrame) -> DataFrame:
    """All anomalous readings with every column."""
    return anomalies.filter("is_anomaly")


def imputed_days(summary: DataFrame) -> DataFrame:
    """Device-days with at least one filled target value."""
    return summary.filter("imputed_count > 0")


def chart_feed(summary: DataFrame, anomalies: DataFrame, turbine: int | None = None) -> DataFrame:
    """Daily band and mean, with one row per anomalous reading of the day (NULL if none).

    A left join in two halves: days with points by inner join, whose hot side Spark can split, which it
    cannot in the outer form, and the other days by anti join.
    """
    key = ["turbine_id", "date"]
    days = _one(summary, turbine).select(*key, "min_power_output", "max_power_output", "avg_power_output")
    points = _one(anomalies, turbine).filter("is_anomaly").selectExpr(
        *key, "timestamp AS anomaly_time", "power_output AS anomaly_power"
    )
    quiet = days.join(points.select(*key).distinct(), key, "left_anti")
    return days.join(points, key).unionByName(quiet, allowMissingColumns=True)


def chart_feed_in_one_pass(
    silver: DataFrame, turbine: int | None = None, cfg: SensorConfig = DEFAULT
) -> DataFrame:
    """`chart_feed` straight from clean readings that are not written yet (see `with_verdict`)."""
    day = Window.partitionBy(cfg.key, cfg.day)
    value, shown = F.col(cfg.target), F.coalesce("is_anomaly", F.lit(False))
    rows = with_verdict(_one(silver, turbine), cfg).withColumns({
        f"min_{cfg.target}": F.min(value).over(day),
        f"max_{cfg.target}": F.max(value).over(day),
        f"avg_{cfg.target}": F.avg(value).over(day),
        "_points": F.count_if(shown).over(day),
        "_row": F.row_number().over(day.orderBy(F.col(cfg.time).asc_nulls_first())),
    })
    return rows.filter(shown | ((F.col("_points") == 0) & (F.col("_row") == 1))).select(
        cfg.key, cfg.day, f"min_{cfg.target}", f"max_{cfg.target}", f"avg_{cfg.target}",
        F.when(shown, F.col(cfg.time)).alias("anomaly_time"), F.when(shown, value).alias("anomaly_power"),
    )
