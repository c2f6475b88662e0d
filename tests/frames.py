"""Small frames for the tests."""

from datetime import datetime

READING = (
    "turbine_id int, timestamp timestamp, power_output double, wind_speed double, wind_direction int"
)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def readings(spark, rows):
    """Rows of (turbine, time, power, speed, direction)."""
    return spark.createDataFrame(
        [(t, at(ts) if ts else None, p, s, d) for t, ts, p, s, d in rows], READING
    )


def targets(spark, rows):
    """Rows of (turbine, time, power, power was imputed), as the gold operators need them."""
    return spark.createDataFrame(
        [(t, at(ts) if ts else None, p, i) for t, ts, p, i in rows],
        "turbine_id int, timestamp timestamp, power_output double, power_output_was_imputed boolean",
    )


def hours(turbine, day, values, imputed=()):
    """One reading per hour of a day; hours in `imputed` are marked as filled."""
    return [(turbine, f"{day} {h:02d}:00:00", v, h in imputed) for h, v in enumerate(values)]
