"""Forward fill: the literal window, the cell-wise form, and a brute-force check of both."""

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from frames import READING, readings

from fleetgauge.config import DEFAULT
from fleetgauge.functions.quality import with_day
from fleetgauge.operators.fill import busy_days, fill_whole_history, forward_fill


def whole(df):
    return fill_whole_history(with_day(df, DEFAULT))


def by_second(df):
    """Every day is cut into seconds."""
    return forward_fill(df, busy=busy_days(df, replace(DEFAULT, busy_day_rows=0)))


FORMS = pytest.mark.parametrize("fill", [whole, forward_fill, by_second])


def power(df):
    rows = df.orderBy("turbine_id", "timestamp").collect()
    return [(r.power_output, r.power_output_was_imputed) for r in rows]


@FORMS
def test_gap_takes_the_last_value_of_an_earlier_day(spark, fill):
    df = readings(spark, [
        (1, "2022-03-01 00:00:00", 1.6, 1.0, 1), (1, "2022-03-02 00:00:00", 4.7, 1.0, 1),
        (1, "2022-03-05 00:00:00", None, 1.0, 1),
    ])
    assert power(fill(df)) == [(1.6, False), (4.7, False), (4.7, True)]


@FORMS
def test_other_devices_do_not_fill(spark, fill):
    df = readings(spark, [(1, "2022-03-01 01:00:00", None, 1.0, 1), (2, "2022-03-01 00:00:00", 6.4, 1.0, 1)])
    assert power(fill(df)) == [(None, False), (6.4, False)]


@FORMS
def test_leading_null_stays_null_and_is_not_imputed(spark, fill):
    df = readings(spark, [(1, "2022-03-01 00:00:00", None, 1.0, 1), (1, "2022-03-01 01:00:00", 3.0, 1.0, 1)])
    assert power(fill(df)) == [(None, False), (3.0, False)]


@FORMS
def test_columns_fill_independently(spark, fill):
    df = readings(spark, [(1, "2022-03-01 00:00:00", 3.0, None, 7), (1, "2022-03-02 00:00:00", None, 5.0, None)])
    row = fill(df).orderBy("timestamp").collect()[-1]
    assert (row.power_output, row.wind_speed, row.wind_direction) == (3.0, 5.0, 7)
    assert (row.power_output_was_imputed, row.wind_speed_was_imputed, row.wind_direction_was_imputed) == (True, False, True)


@FORMS
def test_a_row_without_time_sorts_first_and_can_feed_the_fill(spark, fill):
    df = readings(spark, [(1, None, 4.0, 1.0, 1), (1, "2022-03-01 00:00:00", None, 1.0, 1)])
    assert power(fill(df)) == [(4.0, False), (4.0, True)]


@FORMS
def test_rows_without_device_are_one_device(spark, fill):
    df = readings(spark, [(None, "2022-03-01 00:00:00", 4.0, 1.0, 1), (None, "2022-03-02 00:00:00", None, 1.0, 1)])
    assert power(fill(df)) == [(4.0, False), (4.0, True)]


def random_rows(seed, days=40, devices=4):
    """Irregular times, long gaps, days without a valid value, rows without device or time."""
    dice = random.Random(seed)
    rows = {}
    for _ in range(600):
        device = dice.choice([None, *range(1, devices)])
        moment = datetime(2022, 1, 1) + timedelta(days=dice.randrange(days), seconds=dice.randrange(0, 86400, 1800))
        moment = None if dice.random() < 0.01 else moment + timedelta(microseconds=dice.choice([0, 1, 999_999]))
        draw = lambda made: None if dice.random() < 0.6 else made
        rows[(device, moment)] = (
            device, moment, draw(dice.random()), draw(float(dice.randrange(20))), draw(dice.randrange(360))
        )
    return list(rows.values())


def brute_force(rows, max_gap=None):
    out = []
    held = {}
    order = lambda r: (r[0] or 0, r[1] is not None, r[1] or datetime.min)
    for device, moment, *values in sorted(rows, key=order):
        filled, marks = [], []
        for i, value in enumerate(values):
            if value is not None:
                held[device, i] = (value, moment)
            last, seen = held.get((device, i), (None, None))
            fresh = max_gap is None or (moment and seen and moment - seen <= max_gap)
            result = value if value is not None else (last if fresh else None)
            filled.append(result)
            marks.append(value is None and result is not None)
        out.append((device, moment, *filled, *marks))
    return sorted(out, key=str)


COLUMNS = [
    "turbine_id", "timestamp", "power_output", "wind_speed", "wind_direction",
    "power_output_was_imputed", "wind_speed_was_imputed", "wind_direction_was_imputed",
]


@FORMS
@pytest.mark.parametrize("seed", [1, 2])
def test_all_forms_agree_with_brute_force(spark, fill, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, READING).repartition(5)
    assert sorted([tuple(r) for r in fill(df).select(COLUMNS).collect()], key=str) == brute_force(rows)


@pytest.mark.parametrize("cut", [False, True])
@pytest.mark.parametrize("gap", [timedelta(hours=1), timedelta(days=3)])
def test_gap_cap_agrees_with_brute_force(spark, gap, cut):
    rows = random_rows(3)
    df = spark.createDataFrame(rows, READING)
    busy = busy_days(df, replace(DEFAULT, busy_day_rows=2)) if cut else None
    out = forward_fill(df, busy=busy, max_gap=gap).select(COLUMNS)
    assert sorted([tuple(r) for r in out.collect()], key=str) == brute_force(rows, gap)


@pytest.mark.parametrize("limit", [0, 3, 10])
def test_result_does_not_depend_on_which_days_are_cut(spark, limit):
    rows = random_rows(4)
    df = spark.createDataFrame(rows, READING)
    out = forward_fill(df, busy=busy_days(df, replace(DEFAULT, busy_day_rows=limit)))
    assert sorted([tuple(r) for r in out.select(COLUMNS).collect()], key=str) == brute_force(rows)


def test_zoneless_times_can_be_cut_too(spark):
    rows = random_rows(5)
    df = spark.createDataFrame(rows, READING.replace("timestamp timestamp", "timestamp timestamp_ntz"))
    assert sorted([tuple(r) for r in by_second(df).select(COLUMNS).collect()], key=str) == brute_force(rows)


def test_both_forms_give_the_same_columns(spark):
    df = with_day(readings(spark, [(1, "2022-03-01 00:00:00", 3.0, 1.0, 1)]), DEFAULT)
    assert fill_whole_history(df).columns == forward_fill(df).columns == by_second(df).columns
