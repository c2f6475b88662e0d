"""NULLs that survive cleaning because nothing came before them. They are reported, never an error."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, functions as F

from fleetgauge.config import DEFAULT, SensorConfig

logger = logging.getLogger(__name__)


def remaining_nulls(
    df: DataFrame, columns: Sequence[str] | None = None, cfg: SensorConfig = DEFAULT
) -> DataFrame:
    """One row (column_name, null_count) per column, from a single pass."""
    names = list(columns or cfg.value_names)
    counts = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    return counts.unpivot([], names, "column_name", "null_count")


def watch_nulls(
    df: DataFrame, columns: Sequence[str] | None = None, cfg: SensorConfig = DEFAULT
) -> tuple[DataFrame, Observation]:
    """Count the same NULLs while `df` is written, at no extra job.

    Apply it after the last shuffle before the write: tasks of the final stage count once even when
    executors are lost and earlier stages run again.
    """
    watch = Observation("remaining_nulls")
    names = list(columns or cfg.value_names)
    return df.observe(watch, *[F.count_if(F.col(n).isNull()).alias(n) for n in names]), watch


def warn_remaining(counts: Mapping[str, int]) -> None:
    """One warning per column with NULLs left; silent otherwise."""
    for name, count in counts.items():
        if count:
            logger.warning("%s: %d values stay NULL, no earlier valid reading to fill from", name, count)


def report_remaining_nulls(
    df: DataFrame, columns: Sequence[str] | None = None, cfg: SensorConfig = DEFAULT
) -> None:
    """Count with one job and warn."""
    warn_remaining({r["column_name"]: r["null_count"] for r in remaining_nulls(df, columns, cfg).collect()})
