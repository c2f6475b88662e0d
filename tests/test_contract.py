"""Contract rules over rows, keys, other tables, devices and time."""

import json

import pytest
from frames import at

from fleetgauge.operators.contract import (
    ContractError, Fresh, Reference, Share, Unique, Volume, breaking_rows, check_contract, read_contract, require,
)
from fleetgauge.operators.rules import Rule
from fleetgauge.plans.registry import CONTRACT

ROWS = [
    (1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 01:00:00", None), (1, "2024-01-01 01:00:00", 2.0), (2, "2024-01-01 05:00:00", -1.0),
    (2, None, 3.0), (3, None, 3.0), (None, "2024-01-01 06:00:00", 4.0), (None, "2024-01-01 06:00:00", 4.0),
]


@pytest.fixture(scope="module")
def data(spark):
    rows = [(d, t and at(t), p) for d, t, p in ROWS]
    return spark.createDataFrame(rows, "device int, `seen at` timestamp, power double").repartition(3)


@pytest.fixture(scope="module")
def devices(spark):
    return {"devices": spark.createDataFrame([(1,), (1,), (3,), (None,)], "id int")}


def outcome(data, rules, tables=None):
    return {r.rule: (r.kind, r.checked, r.failed, r.passed) for r in check_contract(data, rules, tables).collect()}


RULES = [
    Rule("possible", "power >= 0"), Rule("mostly", "power >= 0", 0.25),
    Unique("once", ("device", "seen at")), Unique("alone", ("device",), 0.5),
    Reference("known", ("device",), "devices", ("id",)),
    Fresh("late", "seen at", 3600, ("device",)), Fresh("fixed", "seen at", 3600, ("device",), "2024-01-01 02:00:00", 0.5),
    Share("half", "power >= 0", 0.5, ("device",)), Share("third", "power >= 0", 0.33, ("device",)),
    Share("by_time", "power >= 0", 0.0, ("seen at",)), Volume("many", 9), Volume("some", 8),
]


def test_every_kind(data, devices):
    assert outcome(data, RULES, devices) == {
        "possible": ("row", 8, 2, False), "mostly": ("row", 8, 2, True),
        # rows without the whole key are not compared
        "once": ("unique", 4, 1, False), "alone": ("unique", 6, 3, True),
        "known": ("reference", 6, 2, False),
        # the newest of all is 06:00, of a row without device; device 3 has none
        "late": ("fresh", 3, 2, False), "fixed": ("fresh", 3, 1, True),
        "half": ("share", 3, 0, True), "third": ("share", 3, 2, False), "by_time": ("share", 4, 2, False),
        "many": ("volume", 1, 1, False), "some": ("volume", 1, 0, True),
    }


def test_an_empty_table_breaks_volume_alone(data, devices):
    found = outcome(data.limit(0), RULES, devices)
    assert {name for name, r in found.items() if not r[3]} == {"many", "some"}
    assert found["once"][1:3] == found["late"][1:3] == (0, 0)
    assert outcome(data, [Reference("known", ("device",), "devices", ("id",))], {"devices": devices["devices"].limit(0)})["known"][2] == 6


def test_breaking_rows_name_their_rules(data, devices):
    found = breaking_rows(data, RULES, devices)
    assert found.columns == [*data.columns, "_broken"]
    got = sorted(((r.device, r[1] and str(r[1])[11:16], r.power, r._broken) for r in found.collect()), key=str)
    assert got == sorted([
        (1, "00:00", 1.0, ["alone"]), (1, "01:00", None, ["possible", "mostly", "once", "alone"]), (1, "01:00", 2.0, ["once", "alone"]),
        (2, "05:00", -1.0, ["possible", "mostly", "alone", "known"]), (2, None, 3.0, ["alone", "known"]),
    ], key=str)
    assert breaking_rows(data, [Volume("some", 8)]).count() == 0


def test_rules_over_rows_and_devices_are_one_aggregate(data):
    rules = [r for r in RULES if isinstance(r, (Rule, Share, Volume)) and r.name != "by_time"]
    plan = check_contract(data, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_a_hot_key_is_one_row_in_the_reference_join(spark, devices):
    many = spark.range(20_000).selectExpr("int(1) AS device")
    plan = check_contract(many, [Reference("known", ("device",), "devices", ("id",))], devices)
    assert plan.first().failed == 0
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Join") < text.rindex("partial_count(1)")


def test_require_names_what_is_broken(data, devices):
    require(check_contract(data, [Volume("some", 8)]))
    with pytest.raises(ContractError, match="many: 1 of 1 failed; once: 1 of 4 failed"):
        require(check_contract(data, [Volume("many", 9), Unique("once", ("device", "seen at")), Volume("some", 8)]))


def test_contracts_are_read_and_checked():
    assert len(read_contract(CONTRACT)) == 12
    assert read_contract('{"rules": [{"name": "a", "predicate": "true"}]}') == (Rule("a", "true"),)
    for bad in (
        {"kind": "odd", "name": "a"}, {"kind": "unique", "name": "a"}, {"kind": "volume", "name": "a", "least": 1, "more": 2},
        {"kind": "fresh", "name": "a", "column": "t", "seconds": 1, "by": ["d"], "as_of": "soon"},
    ):
        with pytest.raises(ValueError):
            read_contract(json.dumps({"rules": [bad]}))
    with pytest.raises(ContractError, match="one name"):
        read_contract(json.dumps({"rules": [{"kind": "volume", "name": "a", "least": 1}] * 2}))


def test_a_reference_needs_its_table(data):
    with pytest.raises(ContractError, match="devices"):
        check_contract(data, [Reference("known", ("device",), "devices", ("id",))])
    with pytest.raises(ContractError, match="without rules"):
        check_contract(data, [])
