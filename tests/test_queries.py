"""Every registered query against its SQL twin, and the plans that must hold at scale."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from fleetgauge.config import DEFAULT
from fleetgauge.operators.clean import clean_readings
from fleetgauge.operators.fill import forward_fill
from fleetgauge.operators.anomalies import flag_anomalies
from fleetgauge.operators.dedupe import dedupe_readings
from fleetgauge.plans import reports
from fleetgauge.plans.oracle import ORACLE
from fleetgauge.plans.registry import HOURLY, QUERIES, _flagged, _silver, _summary
from fleetgauge.sources.events import event_readings

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    con = connect(FOLDER)
    assert differences(contract.queries()[name](spark, FOLDER), con, contract.oracle_sql()[name]) == []


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() == 60


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def tree(df):
    return plan(df).split("\n\n")[0]


def test_copies_are_cut_before_the_shuffle(spark):
    text = tree(dedupe_readings(event_readings(spark, FOLDER), HOURLY))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_daily_summary_needs_two_shuffles_and_four_columns(spark):
    df = _summary(spark, FOLDER)
    assert tree(df).count("Exchange") == 2
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan(df)


def test_no_python_in_any_plan(spark):
    for df in (_summary(spark, FOLDER), forward_fill(_flagged(spark, FOLDER)), flag_anomalies(_silver(spark, FOLDER))):
        text = plan(df)
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_stats_join_is_not_forced_to_broadcast(spark):
    df = flag_anomalies(_silver(spark, FOLDER))
    assert "strategy=broadcast" not in df._jdf.queryExecution().toString()


def test_one_device_filter_reaches_the_scan(spark):
    silver = clean_readings(event_readings(spark, FOLDER), DEFAULT)
    text = plan(reports.invalid_direction_rows(silver, 1))
    below = text.rindex("Filter", 0, text.rindex("Scan parquet", 0, text.index("\n\n")))
    assert below > 0
    filters = [line for line in text.splitlines() if line.startswith("Condition") and "user_id" in line]
    assert len(filters) >= 2
