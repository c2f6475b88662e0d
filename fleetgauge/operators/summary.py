"""Daily figures per device."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.functions.quality import quoted, with_day


def daily_summary(df: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """Min, max and mean of the target per device-day, filled values included.

    `reading_count` counts every row, `imputed_count` the rows whose target was filled.
    """
    value, imputed = quoted(cfg.target), quoted(f"{cfg.target}_was_imputed")
    figures = (
        f"min({value}) AS min_{cfg.target}",
        f"max({value}) AS max_{cfg.target}",
        f"avg({value}) AS avg_{cfg.target}",
        "count(1) AS reading_count",
        f"sum(CAST({imputed} AS INT)) AS imputed_count",
    )
    return with_day(df, cfg).groupBy(cfg.key, cfg.day).agg(*[F.expr(e) for e in figures])
