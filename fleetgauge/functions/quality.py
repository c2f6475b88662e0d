"""SQL expressions for missing, impossible and out-of-order values.

Expressions are text, parsed once by Spark: a wide projection then costs a handful of calls to the JVM
instead of one per operator and column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, FloatType, MapType

from fleetgauge.config import Measure, SensorConfig


def quoted(name: str) -> str:
    return f"`{name}`"


def replaced(df: DataFrame, made: dict[str, str]) -> DataFrame:
    """`df` with the columns in `made` computed: known names in place, new ones at the end."""
    known = [f"{made[c]} AS {quoted(c)}" if c in made else quoted(c) for c in df.columns]
    return df.selectExpr(*known, *[f"{e} AS {quoted(c)}" for c, e in made.items() if c not in df.columns])


def missing(df: DataFrame, name: str) -> str:
    """NULL, or NaN where the column's type can hold one."""
    value = quoted(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return f"({value} IS NULL OR isnan({value}))"
    return f"({value} IS NULL)"


def impossible(measure: Measure, ceiling: str | None = None) -> str:
    """TRUE where a present value lies outside its range; `ceiling` adds an upper limit per row."""
    value = quoted(measure.name)
    found = []
    if measure.low is not None:
        found.append(f"{value} < {measure.low}")
    if measure.high is not None:
        found.append(f"{value} {'>' if measure.high_is_valid else '>='} {measure.high}")
    if ceiling is not None:
        found.append(f"{value} > {ceiling}")
    return f"coalesce({' OR '.join(found)}, false)" if found else "false"


def any_flag(cfg: SensorConfig, suffix: str) -> str:
    """TRUE where any value column carries the given flag."""
    return "(" + " OR ".join(quoted(f"{n}_{suffix}") for n in cfg.value_names) + ")"


def newest_first(df: DataFrame, cfg: SensorConfig) -> str:
    """Total order over the versions of one reading, newest first.

    Ingestion time decides; every other column follows as a tie-break, so that the winner
    never depends on the order in which rows arrive.
    """
    leading = [cfg.ingested, cfg.source, *cfg.value_names]
    rest = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    names = [n for n in leading if n in df.columns]
    names += [n for n in rest if n not in names and n not in (cfg.key, cfg.time)]
    return ", ".join(f"{quoted(n)} DESC NULLS LAST" for n in names)


def with_day(df: DataFrame, cfg: SensorConfig) -> DataFrame:
    """Add the calendar day of the reading unless the table already carries it."""
    if cfg.day in df.columns:
        return df
    return df.selectExpr("*", f"to_date({quoted(cfg.time)}) AS {quoted(cfg.day)}")
