"""Audit flags: why a value is not usable, recorded before it is set to NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.functions.quality import impossible, missing, quoted, replaced


def flag_and_nullify(
    df: DataFrame, cfg: SensorConfig = DEFAULT, ceilings: dict[str, str] | None = None
) -> DataFrame:
    """Add `{c}_was_missing` and `{c}_was_invalid` per value column and set bad values to NULL.

    The range test only counts for values that are present: NaN sorts above every number, so an
    unguarded upper limit would call it invalid. Both flags are always TRUE or FALSE. `ceilings` maps a
    value column to an expression for its upper limit in each row.
    """
    made: dict[str, str] = {}
    for measure in cfg.measures:
        name = measure.name
        absent = missing(df, name)
        bad = f"(NOT {absent} AND {impossible(measure, (ceilings or {}).get(name))})"
        made[f"{name}_was_missing"] = absent
        made[f"{name}_was_invalid"] = bad
        made[name] = f"CASE WHEN NOT ({absent} OR {bad}) THEN {quoted(name)} END"
    return replaced(df, made)


def flag_with_capacity(
    df: DataFrame,
    capacity: DataFrame,
    cfg: SensorConfig = DEFAULT,
    rated: str = "rated_power",
) -> DataFrame:
    """`flag_and_nullify` with each device's rated power as the upper limit of its output.

    Devices without a row in `capacity` keep no upper limit; of several rows of a device the least rating counts, so
    no reading is repeated. No broadcast hint is given: Spark broadcasts the limits when their measured size allows.
    """
    limits = capacity.groupBy(cfg.key).agg(F.expr(f"min({quoted(rated)})").alias("_rated"))
    joined = df.join(limits, cfg.key, "left").select(*df.columns, "_rated")
    return flag_and_nullify(joined, cfg, {cfg.target: "_rated"}).drop("_rated")
