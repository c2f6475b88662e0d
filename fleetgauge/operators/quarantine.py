"""Rows set aside before cleaning (off by default)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.sources.landing import BAD_LINE, NAMES


def quarantine_reason(df: DataFrame, cfg: SensorConfig = DEFAULT, extras_are_faults: bool = True) -> Column:
    """Why a raw row cannot be trusted, or NULL.

    Any rescued data is a reason; without `extras_are_faults`, values of columns that only the file has are none.
    """
    reason = F.when(F.col(cfg.key).isNull(), F.lit("no device")).when(
        F.col(cfg.time).isNull(), F.lit("no time")
    )
    if cfg.rescued in df.columns:
        unparsed = F.col(cfg.rescued).isNotNull()
        if not extras_are_faults:
            own = F.array(*[F.lit(name) for name in (*NAMES, BAD_LINE)])
            # what is kept there in another form than an object of names is a fault too
            unparsed = F.coalesce(F.arrays_overlap(F.json_object_keys(cfg.rescued), own), unparsed)
        reason = reason.when(unparsed, F.lit("unparsed value"))
    return reason


def split_quarantine(
    df: DataFrame, cfg: SensorConfig = DEFAULT, extras_are_faults: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined); together they are the input, the second with `_reason`."""
    marked = df.withColumn("_reason", quarantine_reason(df, cfg, extras_are_faults))
    return marked.filter(F.col("_reason").isNull()).drop("_reason"), marked.filter(F.col("_reason").isNotNull())
