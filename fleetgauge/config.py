"""Settings shared by every operator: column names, valid ranges and thresholds."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Measure:
    """A sensor value and the range in which it is physically possible."""

    name: str
    low: float | None = None
    high: float | None = None
    high_is_valid: bool = True


# The value columns and their physical limits.
#   power_output    >= 0
#   wind_speed      0 to 100 m/s, both ends valid
#   wind_direction  0 to 360 degrees, 360 itself not valid
MEASURES = (
    Measure("power_output", low=0),
    Measure("wind_speed", low=0, high=100),
    Measure("wind_direction", low=0, high=360, high_is_valid=False),
)


# The fields of a configuration that name a column.
COLUMN_FIELDS = ("key", "time", "day", "ingested", "source", "rescued", "target")


@dataclass(frozen=True)
class SensorConfig:
    key: str = "turbine_id"
    time: str = "timestamp"
    day: str = "date"
    ingested: str = "_ingested_at"
    source: str = "_source_file"
    rescued: str = "_rescued_data"
    target: str = "power_output"
    measures: tuple[Measure, ...] = MEASURES
    # A reading is anomalous beyond this many sample standard deviations.
    threshold: float = 2.0
    # A day whose deviation is below this share of its mean is rounding noise, not spread.
    flat_tolerance: float = 1e-9
    # Most readings a device can have per day after dedupe, where its time grid fixes that number.
    readings_per_day: int | None = None
    # A device-day with more rows than this is filled second by second (see operators/fill.py).
    busy_day_rows: int = 1_000_000

    @property
    def value_names(self) -> tuple[str, ...]:
        return tuple(m.name for m in self.measures)

    @classmethod
    def from_session(cls, spark: SparkSession) -> SensorConfig:
        """Defaults, overridden by `fleetgauge.*` settings of the session.

        `fleetgauge.column.<field>` names the key, time, day, ingested, source, rescued or target column. `fleetgauge.measures` is a JSON
        list of the value columns with their bounds: `[{"name": "power_output", "low": 0, "high": null, "high_is_valid": true}]`.
        """
        base = cls()
        names = {field: spark.conf.get(f"fleetgauge.column.{field}", getattr(base, field)) for field in COLUMN_FIELDS}
        given = spark.conf.get("fleetgauge.measures", "")
        measures = tuple(Measure(**measure) for measure in json.loads(given)) if given else base.measures
        if names["target"] not in {m.name for m in measures}:
            raise ValueError(f"the target column {names['target']} is not among the value columns")
        per_day = spark.conf.get("fleetgauge.readingsPerDay", "")
        return replace(
            base,
            **names,
            measures=measures,
            readings_per_day=int(per_day) if per_day else base.readings_per_day,
            threshold=float(spark.conf.get("fleetgauge.threshold", str(base.threshold))),
            flat_tolerance=float(spark.conf.get("fleetgauge.flatTolerance", str(base.flat_tolerance))),
            busy_day_rows=int(spark.conf.get("fleetgauge.busyDayRows", str(base.busy_day_rows))),
        )


DEFAULT = SensorConfig()

# Up to a ten-minute grid, thirty years of one device are 1.6 million rows: one window holds them.
WHOLE_HISTORY_PER_DAY = 144
