"""Forward fill: a missing value takes the device's last valid value, across days.

`fill_whole_history` is the literal definition, one window over a device's whole history. It puts
that history into one task, so it is meant for short histories.

`forward_fill` gives the same rows in bounded tasks. Readings are cut into cells (a device-day, or a
second of it on days listed in `busy`). The last valid value of every cell is found by partial
aggregation, passed forward over that much smaller table, and handed to each cell as one extra row
sorted before its readings. An ordinary window inside the cell does the rest. No window sees more
than the seconds of a day, the days of a calendar, or the readings of one cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.functions.quality import quoted, replaced, with_day

CELL = "_cell"
SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_AT = "_at_"


def fill_whole_history(df: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """Forward fill with a single window per device.

    Ordering by day and time is ordering by time; naming the day lets later windows over
    (device, day) use the same sort.
    """
    order = f"{quoted(cfg.day)} NULLS FIRST, {quoted(cfg.time)} NULLS FIRST"
    history = f"PARTITION BY {quoted(cfg.key)} ORDER BY {order} {SO_FAR}"
    made: dict[str, str] = {}
    for name in cfg.value_names:
        filled = f"last_value({quoted(name)}) IGNORE NULLS OVER ({history})"
        made[name] = filled
        made[f"{name}_was_imputed"] = f"({quoted(name)} IS NULL AND {filled} IS NOT NULL)"
    return replaced(with_day(df, cfg), made)


def busy_days(df: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """Device-days with more rows than `cfg.busy_day_rows`.

    May be computed on readings before dedupe: the choice of cells changes the work, not the result.
    At most (all rows / busy_day_rows) rows come out.
    """
    return (
        with_day(df, cfg)
        .groupBy(cfg.key, cfg.day)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > cfg.busy_day_rows)
        .select(cfg.key, cfg.day)
    )


def with_cells(df: DataFrame, busy: DataFrame, cfg: SensorConfig = DEFAULT) -> DataFrame:
    """Number the cell of each reading within its day: its second on busy days, else -1.

    After dedupe a second holds at most one row per microsecond, a million in all.
    """
    marks = busy.select(
        F.col(cfg.key).alias("_busy_key"), F.col(cfg.day).alias("_busy_day"), F.lit(True).alias("_busy")
    )
    time = F.col(cfg.time)
    if isinstance(df.schema[cfg.time].dataType, TimestampNTZType):
        second = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    else:
        second = F.unix_seconds(time)
    matched = F.col(cfg.key).eqNullSafe(F.col("_busy_key")) & (F.col(cfg.day) == F.col("_busy_day"))
    return (
        df.join(marks, matched, "left")
        .withColumn(CELL, F.when(F.col("_busy"), second.cast("long")).otherwise(F.lit(-1)))
        .drop("_busy_key", "_busy_day", "_busy")
    )


def _passed_names(cfg: SensorConfig, timed: bool) -> list[str]:
    return [*cfg.value_names, *([_AT + n for n in cfg.value_names] if timed else [])]


def cell_tails(
    df: DataFrame, cells: Sequence[str], cfg: SensorConfig = DEFAULT, timed: bool = False, counted: str = ""
) -> DataFrame:
    """Last valid value of every cell per value column, its time if `timed`, its rows in a column named by `counted`.

    Rows without a time form cells of their own and hold one row each after dedupe, so any constant
    serves as their position.
    """
    kind = df.schema[cfg.time].dataType.simpleString()
    position = f"coalesce({quoted(cfg.time)}, CAST('1970-01-01' AS {kind}))"
    found = [f"count(1) AS {quoted(counted)}"] if counted else []
    for name in cfg.value_names:
        valid = f"{quoted(name)} IS NOT NULL"
        found.append(f"max_by({quoted(name)}, {position}) FILTER (WHERE {valid}) AS {quoted(name)}")
        if timed:
            found.append(f"max({quoted(cfg.time)}) FILTER (WHERE {valid}) AS {quoted(_AT + name)}")
    return df.groupBy(*cells).agg(*[F.expr(e) for e in found])


def opening_values(
    tails: DataFrame,
    cfg: SensorConfig = DEFAULT,
    within: Sequence[str] | None = None,
    order: str | None = None,
    start: DataFrame | None = None,
    timed: bool = False,
) -> DataFrame:
    """Value in force before each cell: the last tail of the cells before it.

    `start` gives the values in force before the first cell of each group (rows shaped like `tails`).
    """
    rows = tails.selectExpr("*", "true AS _cell_row")
    if start is not None:
        rows = rows.unionByName(start.selectExpr("*", "false AS _cell_row"), allowMissingColumns=True)
    group = ", ".join(quoted(c) for c in within or [cfg.key])
    before = (
        f"PARTITION BY {group} ORDER BY _cell_row, {quoted(order or cfg.day)} NULLS FIRST "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    )
    names = _passed_names(cfg, timed)
    carried = replaced(rows, {n: f"last_value({quoted(n)}) IGNORE NULLS OVER ({before})" for n in names})
    return carried.filter("_cell_row").drop("_cell_row")


def fill_cells(
    df: DataFrame,
    openings: DataFrame,
    cells: Sequence[str],
    cfg: SensorConfig = DEFAULT,
    max_gap: timedelta | None = None,
) -> DataFrame:
    """Fill each cell from its opening values and the readings before, in one window.

    The opening values travel as one more row per cell, so the readings are shuffled once and need
    no join. With `max_gap`, a value older than that is not used.
    """
    timed = max_gap is not None
    made = {"_reading": "true"}
    if timed:
        for n in cfg.value_names:
            made[_AT + n] = f"CASE WHEN {quoted(n)} IS NOT NULL THEN {quoted(cfg.time)} END"
    rows = replaced(df, made).unionByName(
        openings.selectExpr("*", "false AS _reading"), allowMissingColumns=True
    )
    group = ", ".join(quoted(c) for c in cells)
    so_far = f"PARTITION BY {group} ORDER BY _reading, {quoted(cfg.time)} NULLS FIRST {SO_FAR}"
    rows = replaced(rows, {
        "_last_" + n: f"last_value({quoted(n)}) IGNORE NULLS OVER ({so_far})" for n in _passed_names(cfg, timed)
    }).filter("_reading")

    made = {}
    for name in cfg.value_names:
        value, filled = quoted(name), quoted("_last_" + name)
        if timed:
            age = f"{quoted(cfg.time)} - {quoted('_last_' + _AT + name)}"
            limit = f"make_dt_interval(0, 0, 0, {max_gap.total_seconds()})"
            filled = f"coalesce({value}, CASE WHEN {age} <= {limit} THEN {filled} END)"
        made[name] = filled
        made[f"{name}_was_imputed"] = f"({value} IS NULL AND {filled} IS NOT NULL)"
    kept = [f"{made.pop(c)} AS {quoted(c)}" if c in made else quoted(c) for c in df.columns if c != CELL]
    return rows.selectExpr(*kept, *[f"{e} AS {quoted(c)}" for c, e in made.items()])


def fill_from_openings(
    readings: DataFrame,
    openings: DataFrame,
    cfg: SensorConfig = DEFAULT,
    busy: DataFrame | None = None,
    max_gap: timedelta | None = None,
) -> DataFrame:
    """Fill whole days given the values in force at the start of each device-day.

    Days listed in `busy` are cut into seconds, whose opening values come from the seconds before and,
    for the first, from the day's opening.
    """
    day_cells = [cfg.key, cfg.day]
    if busy is None:
        return fill_cells(readings, openings, day_cells, cfg, max_gap)
    timed = max_gap is not None
    cells = [*day_cells, CELL]
    readings = with_cells(readings, busy, cfg)
    tails = cell_tails(readings, cells, cfg, timed)
    cell_openings = opening_values(tails, cfg, day_cells, CELL, start=openings, timed=timed)
    return fill_cells(readings, cell_openings, cells, cfg, max_gap)


def forward_fill(
    df: DataFrame,
    cfg: SensorConfig = DEFAULT,
    busy: DataFrame | None = None,
    max_gap: timedelta | None = None,
) -> DataFrame:
    """Forward fill in bounded tasks; `busy` lists device-days to cut into seconds.

    Without `busy` the cells are whole device-days, right where a day holds a known, moderate number
    of readings. The output carries the day column.
    """
    readings = with_day(df, cfg)
    timed = max_gap is not None
    tails = cell_tails(readings, [cfg.key, cfg.day], cfg, timed)
    return fill_from_openings(readings, opening_values(tails, cfg, timed=timed), cfg, busy, max_gap)
