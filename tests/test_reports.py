"""Questions asked of the finished tables, and the extensions."""

import random

import pytest
from frames import at, hours, readings, targets
from pyspark.sql import functions as F

from fleetgauge.operators.anomalies import flag_anomalies
from fleetgauge.operators.gaps import absent_hours, with_absent_hours
from fleetgauge.operators.quarantine import split_quarantine
from fleetgauge.operators.rules import Rule, check_rules
from fleetgauge.operators.summary import daily_summary
from fleetgauge.plans import reports

DAY = "2022-03-01"


@pytest.fixture(scope="module")
def fleet(spark):
    rows = (
        hours(1, DAY, [3.0] * 5 + [9.0])
        + hours(1, "2022-03-02", [2.0, 4.0, 4.0], imputed=[2])
        + hours(2, DAY, [5.0, 5.0])
    )
    return targets(spark, rows)


def test_list_is_ordered_and_distinct(fleet):
    assert [r.turbine_id for r in reports.turbine_list(fleet).collect()] == [1, 2]


def test_one_device_or_all(fleet):
    summary = daily_summary(fleet)
    assert [str(r.date) for r in reports.turbine_daily(summary, 1).collect()] == [DAY, "2022-03-02"]
    assert reports.turbine_daily(summary).count() == 3
    assert reports.turbine_daily(summary, 99).count() == 0


def test_anomalies_of_one_device(fleet):
    found = flag_anomalies(fleet)
    assert [r.power_output for r in reports.turbine_anomalies(found, 1).collect()] == [9.0]
    assert reports.turbine_anomalies(found, 2).count() == 0
    assert reports.anomalous_rows(found).count() == 1


def test_key_figures(fleet):
    rows = reports.turbine_kpis(daily_summary(fleet), flag_anomalies(fleet)).orderBy("turbine_id").collect()
    assert tuple(rows[0]) == (1, 2, 1, 1, pytest.approx((4.0 + 10 / 3) / 2))
    assert tuple(rows[1]) == (2, 1, 0, 0, 5.0)


def test_anomaly_counts_leave_out_quiet_devices(fleet):
    assert [tuple(r) for r in reports.anomaly_counts(flag_anomalies(fleet)).collect()] == [(1, 1)]


def test_imputed_days(fleet):
    assert [str(r.date) for r in reports.imputed_days(daily_summary(fleet)).collect()] == ["2022-03-02"]


def test_chart_keeps_days_without_anomalies(fleet):
    feed = reports.chart_feed(daily_summary(fleet), flag_anomalies(fleet)).collect()
    assert sorted((r.turbine_id, str(r.date), r.anomaly_power) for r in feed if r.anomaly_power) == [(1, DAY, 9.0)]
    assert len(feed) == 3


NAMES = [f"{c}_was_{k}" for c in ("power_output", "wind_speed", "wind_direction") for k in ("missing", "invalid")]


def silver(spark, rows):
    """Rows of (turbine, names of the flags that are set)."""
    kinds = ", ".join(["turbine_id int", "power_output_was_imputed boolean", *[f"{n} boolean" for n in NAMES]])
    return spark.createDataFrame(
        [(t, "power_output_was_imputed" in f, *[n in f for n in NAMES]) for t, f in rows], kinds
    )


def test_a_row_counts_once_per_kind_of_issue(spark):
    df = silver(spark, [
        (1, {"power_output_was_missing", "wind_speed_was_missing", "wind_direction_was_invalid"}),
        (1, {"power_output_was_imputed"}), (1, set()), (2, set()),
    ])
    rows = {r.turbine_id: tuple(r)[1:] for r in reports.fleet_quality(df).collect()}
    assert rows == {1: (1, 1, 1, 3), 2: (0, 0, 0, 1)}


def test_flakiest_first_and_ties_by_id(spark):
    both = {"power_output_was_missing", "wind_speed_was_invalid"}
    df = silver(spark, [(t, both if t == 6 else {NAMES[0]} if t in (2, 5) else set()) for t in range(1, 8)])
    rows = reports.flakiest(reports.fleet_quality(df)).collect()
    assert [r.turbine_id for r in rows] == [6, 2, 5, 1, 3]
    assert rows[0].issue_rate == 2.0


def test_invalid_direction_rows(spark):
    df = silver(spark, [(1, {"wind_direction_was_invalid"}), (2, {"wind_direction_was_invalid"}), (1, set())])
    assert reports.invalid_direction_rows(df).count() == 2
    assert reports.invalid_direction_rows(df, 1).count() == 1


def test_absent_hours_lie_between_first_and_last(spark):
    df = readings(spark, [
        (1, "2022-03-01 22:00:00", 1.0, 1.0, 1), (1, "2022-03-02 01:00:00", 1.0, 1.0, 1),
        (2, "2022-03-01 05:00:00", 1.0, 1.0, 1), (2, None, 1.0, 1.0, 1),
    ])
    got = sorted((r.turbine_id, r.timestamp) for r in absent_hours(df).collect())
    assert got == [(1, at("2022-03-01 23:00:00")), (1, at("2022-03-02 00:00:00"))]
    full = with_absent_hours(df)
    assert full.count() == 6
    assert full.filter("_was_absent AND power_output IS NULL").count() == 2


def test_off_grid_readings_are_kept_and_cover_their_hour(spark):
    df = readings(spark, [
        (1, "2022-03-01 00:00:00", 1.0, 1.0, 1), (1, "2022-03-01 01:17:00", 1.0, 1.0, 1),
        (1, "2022-03-01 03:00:00", 1.0, 1.0, 1),
    ])
    assert [r.timestamp for r in absent_hours(df).collect()] == [at("2022-03-01 02:00:00")]
    assert with_absent_hours(df).count() == 4


def test_quarantine_splits_without_loss(spark):
    dice = random.Random(1)
    rows = [
        (dice.choice([None, 1]), dice.choice([None, at("2022-03-01 00:00:00")]), dice.choice([None, '{"a":"b"}']))
        for _ in range(50)
    ]
    df = spark.createDataFrame(rows, "turbine_id int, timestamp timestamp, _rescued_data string")
    good, bad = split_quarantine(df)
    assert good.count() + bad.count() == 50
    assert good.filter("turbine_id IS NULL OR timestamp IS NULL OR _rescued_data IS NOT NULL").count() == 0
    assert {r._reason for r in bad.collect()} == {"no device", "no time", "unparsed value"}
    assert good.columns == df.columns


def test_rules_count_null_as_failure_and_honour_the_allowance(spark):
    df = spark.createDataFrame([(1,), (5,), (None,), (2,)], "v int")
    rows = {r.rule: r for r in check_rules(df, [Rule("small", "v < 4", 0.5), Rule("present", "v IS NOT NULL")]).collect()}
    assert (rows["small"].checked_rows, rows["small"].failed_rows, rows["small"].passed) == (4, 2, True)
    assert (rows["present"].failed_rows, rows["present"].passed) == (1, False)


def test_an_unknown_device_has_a_row_of_zeros(spark):
    fleet = targets(spark, hours(1, "2022-03-01", [1.0, 2.0])).withColumn("date", F.to_date("timestamp"))
    want = (999, 0, 0, 0, None)
    assert tuple(reports.turbine_kpis(daily_summary(fleet), flag_anomalies(fleet), 999).first()) == want
    assert tuple(reports.turbine_kpis_in_one_pass(fleet, 999).first()) == want
    assert reports.turbine_kpis_in_one_pass(fleet, 1).collect() == reports.turbine_kpis_in_one_pass(fleet).collect()
