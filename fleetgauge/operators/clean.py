"""The cleaning chain from raw to clean readings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetgauge.config import DEFAULT, WHOLE_HISTORY_PER_DAY, SensorConfig
from fleetgauge.functions.quality import with_day
from fleetgauge.operators.dedupe import dedupe_readings
from fleetgauge.operators.fill import fill_whole_history, forward_fill
from fleetgauge.operators.flags import flag_and_nullify


def flagged_readings(df: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """Dedupe, then flag: duplicates are not counted twice, and the newest version decides."""
    return df.transform(dedupe_readings, cfg).transform(flag_and_nullify, cfg)


def clean_readings(
    df: DataFrame, cfg: SensorConfig = DEFAULT, busy: DataFrame | None = None
) -> DataFrame:
    """Dedupe, flag, forward fill; adds the day column. `busy` as in `forward_fill`.

    On a coarse time grid (`cfg.readings_per_day`) a device's whole history is small after dedupe and
    one window fills it with the fewest shuffles; otherwise the fill works cell by cell.
    """
    readings = with_day(flagged_readings(df, cfg), cfg)
    if cfg.readings_per_day and cfg.readings_per_day <= WHOLE_HISTORY_PER_DAY:
        return fill_whole_history(readings, cfg)
    return forward_fill(readings, cfg, busy)
