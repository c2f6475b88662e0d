"""Empty cells from a second source."""

import random
from datetime import timedelta

import pytest
from frames import at, readings

from fleetgauge.config import DEFAULT
from fleetgauge.operators.fallback import substitute

HOUR = timedelta(hours=1)
NAMES = DEFAULT.value_names


def rows(df):
    flags = [f"{n}_was_substituted" for n in NAMES]
    return sorted(((r.turbine_id, r.timestamp and str(r.timestamp)[11:], *(r[n] for n in NAMES), *(r[f] for f in flags)) for r in df.collect()), key=str)


def test_each_cell_takes_the_newest_usable_value(spark):
    own = readings(spark, [
        (1, "2024-01-01 10:00:00", None, 5.0, None), (1, "2024-01-01 10:30:00", 2.0, None, 7), (1, "2024-01-01 12:00:00", None, 1.0, 1),
        (2, "2024-01-01 10:00:00", None, 1.0, 1), (None, "2024-01-01 10:00:00", None, 1.0, 1), (1, None, None, 1.0, 1),
    ])
    other = readings(spark, [
        (1, "2024-01-01 09:00:00", 8.0, 9.0, 10), (1, "2024-01-01 09:40:00", -1.0, float("nan"), 11), (1, "2024-01-01 10:00:00", None, 3.0, 400),
        (1, "2024-01-01 10:31:00", 99.0, 99.0, 99), (None, "2024-01-01 10:00:00", 4.0, 4.0, 4), (1, "2024-01-01 10:59:59", 77.0, 1.0, 1),
    ])
    assert rows(substitute(own, other, HOUR)) == sorted([
        # 09:00 is one hour old and still usable; impossible and missing values are passed over, cell by cell
        (1, "10:00:00", 8.0, 5.0, 11, True, False, True), (1, "10:30:00", 2.0, 3.0, 7, False, True, False),
        # the last source row is a second too old
        (1, "12:00:00", None, 1.0, 1, False, False, False), (2, "10:00:00", None, 1.0, 1, False, False, False),
        (None, "10:00:00", None, 1.0, 1, False, False, False), (1, None, None, 1.0, 1, False, False, False),
    ], key=str)


@pytest.mark.parametrize("seed", range(4))
def test_random_sources_equal_the_definition(spark, seed):
    pick = random.Random(seed)
    within = timedelta(seconds=pick.choice([0, 1, 90, 3_600, 100_000]))

    def feed(n, holes):
        made = {}
        for _ in range(n):
            time = at("2024-02-28 23:00:00") + timedelta(seconds=pick.choice([1, 30, 3_600]) * pick.randint(0, 60))
            made[pick.randint(1, 3), time] = [None if pick.random() < holes else float(pick.randint(-1, 9)) for _ in range(3)]
        return [(d, t, p, s, None if w is None else int(w)) for (d, t), (p, s, w) in made.items()]

    own, other = feed(60, 0.5), feed(80, 0.3)
    kind = "turbine_id int, timestamp timestamp_ntz, power_output double, wind_speed double, wind_direction int"
    found = substitute(spark.createDataFrame(own, kind).repartition(3), spark.createDataFrame(other, kind), within)
    want = []
    for device, time, *values in own:
        out, flags = [], []
        for i, value in enumerate(values):
            usable = [(t, v[i]) for d, t, *v in other if d == device and t <= time and time - t <= within and v[i] is not None and v[i] >= 0]
            used = value is None and bool(usable)
            out.append(max(usable)[1] if used else value)
            flags.append(used)
        want.append((device, str(time)[11:], *out, *flags))
    assert rows(found) == sorted(want, key=str)


def test_source_versions_missing_columns_and_empty_tables(spark):
    own = readings(spark, [(1, "2024-01-01 10:00:00", None, None, None)])
    twice = readings(spark, [(1, "2024-01-01 10:00:00", 1.0, 2.0, 3), (1, "2024-01-01 10:00:00", 5.0, 2.0, 3)])
    assert rows(substitute(own, twice, HOUR))[0][2] == 5.0
    part = twice.select("wind_speed", "turbine_id", "timestamp")
    assert rows(substitute(own, part, HOUR)) == [(1, "10:00:00", None, 2.0, None, False, True, False)]
    assert rows(substitute(own, twice.limit(0), HOUR))[0][5:] == (False, False, False)
    assert substitute(own.limit(0), twice, HOUR).count() == 0
    found = substitute(own.selectExpr("*", "1 AS extra"), twice, HOUR)
    assert found.columns == [*own.columns, "extra", *[f"{n}_was_substituted" for n in NAMES]]
    with pytest.raises(ValueError):
        substitute(own, twice, -HOUR)


def test_full_rows_are_not_shuffled(spark):
    own = readings(spark, [(1, "2024-01-01 10:00:00", 1.0, 2.0, 3)])
    text = substitute(own, own, HOUR)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.index("Union") < text.index("Exchange") and "Python" not in text
