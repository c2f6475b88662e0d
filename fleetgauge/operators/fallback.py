"""Values from a second source where a device's own are absent or too old (off by default, not part of cleaning).

For each cell that is still empty, the newest usable value of the same device and column in the second source is taken, if it is at most
`within` old at the time of the reading. Such cells carry a flag of their own, `{c}_was_substituted`; they are not imputed.

This is an as-of join in bounded pieces. Time is cut into buckets as wide as `within`, so a usable value lies in the bucket of its
reading or in the one before. Of the bucket before only the last value of each column matters: it is found by partial aggregation and
travels on as one row. Each task thus holds the readings and source rows of one device and bucket. Only rows with an empty cell
take part; all others pass without a shuffle.

Rows without device or time are never given a value, and give none. Of several source rows with one device and time the newest version counts, by the
same total order as in `dedupe_readings`. Source values that are missing or impossible are not used. Columns that the source does
not have are never substituted.
"""

from __future__ import annotations

from datetime import timedelta
from math import ceil

from pyspark.sql import DataFrame, functions as F

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.functions.quality import quoted, replaced
from fleetgauge.operators.dedupe import dedupe_readings
from fleetgauge.operators.flags import flag_and_nullify

SUFFIX = "was_substituted"


def _bucket(cfg: SensorConfig, within: timedelta) -> str:
    time, width = quoted(cfg.time), max(1, ceil(within.total_seconds()))
    clock = f"hour({time}) * 3600 + minute({time}) * 60 + second({time})"
    return f"floor((datediff(to_date({time}), DATE'1970-01-01') * 86400L + {clock}) / {width})"


def usable_values(source: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """(device, time, values): the newest version of each source row, with unusable values as NULL."""
    names = [n for n in cfg.value_names if n in source.columns]
    known = source.where(f"{quoted(cfg.key)} IS NOT NULL AND {quoted(cfg.time)} IS NOT NULL")
    absent = {n: "CAST(NULL AS double)" for n in cfg.value_names if n not in names}
    clean = flag_and_nullify(dedupe_readings(replaced(known, absent), cfg), cfg)
    return clean.selectExpr(quoted(cfg.key), quoted(cfg.time), *map(quoted, cfg.value_names))


def substitute(df: DataFrame, source: DataFrame, within: timedelta, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """`df` with empty cells taken from `source`, and a flag for each value column.

    `df` is read twice, for the rows with and without empty cells; give a written table where it costs much to compute.
    """
    if within < timedelta(0):
        raise ValueError("within must not be negative")
    names, key, time = cfg.value_names, quoted(cfg.key), quoted(cfg.time)
    kinds = {n: df.schema[n].dataType.simpleString() for n in names}
    empty = " OR ".join(f"{quoted(n)} IS NULL" for n in names)
    needy = f"({empty}) AND {key} IS NOT NULL AND {time} IS NOT NULL"
    flags = {f"{n}_{SUFFIX}": "false" for n in names}
    untouched = replaced(df.where(f"NOT coalesce({needy}, false)"), flags)

    bucket = _bucket(cfg, within)
    # each usable value travels with its time
    held = [
        f"CASE WHEN {quoted(n)} IS NOT NULL THEN struct({time} AS t, CAST({quoted(n)} AS {kinds[n]}) AS v) END AS `_v_{n}`" for n in names
    ]
    offered = usable_values(source, cfg).selectExpr(key, time, f"{bucket} AS _bucket", *held)
    last = offered.groupBy(cfg.key, "_bucket").agg(*[F.max(f"_v_{n}").alias(f"_v_{n}") for n in names])
    before = last.selectExpr(key, "_bucket + 1 AS _bucket", "0 AS _kind", *[f"`_v_{n}`" for n in names])
    wanting = df.where(needy).selectExpr("*", f"{bucket} AS _bucket", "2 AS _kind")
    rows = wanting.unionByName(before, allowMissingColumns=True).unionByName(
        offered.selectExpr("*", "1 AS _kind"), allowMissingColumns=True
    )
    # the value from the bucket before comes first; a source row counts for readings of its own time
    order = "CASE WHEN _kind > 0 THEN " + time + " END NULLS FIRST, _kind"
    so_far = f"PARTITION BY {key}, _bucket ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    found = rows.selectExpr("*", *[f"last_value(`_v_{n}`) IGNORE NULLS OVER ({so_far}) AS `_f_{n}`" for n in names]).where("_kind = 2")
    limit = f"make_dt_interval(0, 0, 0, {within.total_seconds()})"
    made = {}
    for n in names:
        used = f"({quoted(n)} IS NULL AND coalesce({time} - `_f_{n}`.t <= {limit}, false))"
        made[n] = f"CASE WHEN {used} THEN `_f_{n}`.v ELSE {quoted(n)} END"
        made[f"{n}_{SUFFIX}"] = used
    given = found.selectExpr(*[f"{made.get(c, quoted(c))} AS {quoted(c)}" for c in untouched.columns])
    return untouched.unionByName(given)

