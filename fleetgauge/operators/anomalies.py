"""Readings far from their own device-day's mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.functions.quality import quoted, replaced, with_day


def _imputed(cfg: SensorConfig) -> str:
    return quoted(f"{cfg.target}_was_imputed")


def _placed(cfg: SensorConfig) -> str:
    return f"{quoted(cfg.key)} IS NOT NULL AND {quoted(cfg.day)} IS NOT NULL"


def _verdict(cfg: SensorConfig) -> str:
    """FALSE without a deviation or with one that is only rounding; NULL for a NULL value."""
    value = quoted(cfg.target)
    mean, deviation = quoted(f"mean_{cfg.target}"), quoted(f"stddev_{cfg.target}")
    return (
        f"CASE WHEN {deviation} IS NULL THEN false WHEN {value} IS NULL THEN NULL "
        f"WHEN {deviation} <= abs({mean}) * {cfg.flat_tolerance!r}D THEN false "
        f"ELSE abs({value} - {mean}) > {deviation} * {cfg.threshold!r}D END"
    )


def real_readings(df: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """Rows whose target was measured, or is still NULL, but was not filled."""
    return with_day(df, cfg).filter(f"NOT {_imputed(cfg)}")


def day_stats(df: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """Mean and sample standard deviation of the real readings per device-day."""
    return (
        real_readings(df, cfg)
        .groupBy(cfg.key, cfg.day)
        .agg(
            F.avg(cfg.target).alias(f"mean_{cfg.target}"),
            F.stddev_samp(cfg.target).alias(f"stddev_{cfg.target}"),
        )
    )


def _ordered(df: DataFrame, readings: DataFrame, cfg: SensorConfig) -> DataFrame:
    rest = [c for c in readings.columns if c not in (cfg.key, cfg.day)]
    names = [cfg.key, cfg.day, *rest, f"mean_{cfg.target}", f"stddev_{cfg.target}"]
    return df.selectExpr(*map(quoted, names), f"{_verdict(cfg)} AS is_anomaly")


def flag_anomalies(
    df: DataFrame, cfg: SensorConfig = DEFAULT, stats: DataFrame | None = None
) -> DataFrame:
    """Real readings with their day's figures and `is_anomaly`, by aggregate and join.

    For written tables: the figures are pre-aggregated in the map tasks, and Spark broadcasts them when their
    measured size is small. Beyond that, adaptive execution splits the hot side of the join only if `stats`, the
    figures of `day_stats`, comes from a written table, as the build jobs do it; it does not split a join right above
    an aggregate. Rows without device or day drop out.
    """
    readings = real_readings(df, cfg)
    figures = day_stats(df, cfg) if stats is None else stats
    return _ordered(readings.join(figures, [cfg.key, cfg.day]), readings, cfg)


def _with_day_figures(df: DataFrame, counted: str, cfg: SensorConfig) -> DataFrame:
    day = f"(PARTITION BY {quoted(cfg.key)}, {quoted(cfg.day)})"
    real = f"CASE WHEN {counted} THEN {quoted(cfg.target)} END"
    return replaced(df, {
        f"mean_{cfg.target}": f"avg({real}) OVER {day}",
        f"stddev_{cfg.target}": f"stddev_samp({real}) OVER {day}",
    })


def with_verdict(df: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """Every reading with its day's figures over real readings and `is_anomaly`, in one pass.

    Filled readings and those without device or day get no verdict. For inputs still being computed,
    which a join would compute twice, and only where a device-day holds a known, moderate number of rows.
    """
    judged = f"(NOT {_imputed(cfg)} AND {_placed(cfg)})"
    rows = _with_day_figures(with_day(df, cfg), judged, cfg)
    return rows.selectExpr("*", f"CASE WHEN {judged} THEN {_verdict(cfg)} END AS is_anomaly")


def flag_anomalies_windowed(df: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """The rows of `flag_anomalies` in one pass, under the same condition as `with_verdict`."""
    readings = real_readings(df, cfg).filter(_placed(cfg))
    return _ordered(_with_day_figures(readings, "true", cfg), readings, cfg)
