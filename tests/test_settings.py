"""Settings, shuffle sizing, the load-test feed."""

import pytest

from fleetgauge.config import DEFAULT, SensorConfig
from fleetgauge.session import input_bytes, require_utc, shared_folder, size_shuffles
from fleetgauge.sources.generator import generate_readings
from fleetgauge.sources.layers import Layers

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_session_settings_override_defaults(spark):
    spark.conf.set("fleetgauge.threshold", "3.5")
    spark.conf.set("fleetgauge.basePath", "/lake")
    spark.conf.set("fleetgauge.env", "dev")
    try:
        assert SensorConfig.from_session(spark).threshold == 3.5
        assert Layers.from_session(spark).path("turbine_anomalies") == "/lake/gold_dev/turbine_data/turbine_anomalies"
    finally:
        for name in ("threshold", "basePath", "env"):
            spark.conf.unset(f"fleetgauge.{name}")
    assert SensorConfig.from_session(spark) == DEFAULT


def test_columns_and_bounds_can_be_set(spark):
    from frames import readings

    from fleetgauge.operators.clean import clean_readings

    set_ = {
        "column.key": "meter", "column.time": "at", "column.target": "load", "readingsPerDay": "24",
        "measures": '[{"name": "load", "low": 1, "high": 5, "high_is_valid": false}]',
    }
    for name, value in set_.items():
        spark.conf.set(f"fleetgauge.{name}", value)
    try:
        cfg = SensorConfig.from_session(spark)
        spark.conf.set("fleetgauge.column.target", "other")
        with pytest.raises(ValueError, match="other"):
            SensorConfig.from_session(spark)
    finally:
        for name in set_:
            spark.conf.unset(f"fleetgauge.{name}")
    assert (cfg.key, cfg.time, cfg.value_names, cfg.readings_per_day, cfg.day) == ("meter", "at", ("load",), 24, "date")
    rows = [(1, f"2024-01-01 0{h}:00:00", p, None, None) for h, p in enumerate((2.0, 5.0, 0.5, 4.9))]
    df = readings(spark, rows).selectExpr("turbine_id AS meter", "timestamp AS at", "power_output AS load")
    found = clean_readings(df, cfg).orderBy("at").collect()
    assert [(r.load, r.load_was_invalid, r.load_was_imputed) for r in found] == [
        (2.0, False, False), (2.0, True, True), (2.0, True, True), (4.9, False, False),
    ]


def test_generated_feed_can_be_zipf_and_late(spark):
    rows = generate_readings(spark, 40_000, 50, zipf=True, late_share=0.1).collect()
    counts = [sum(r.turbine_id == t for r in rows) for t in (1, 2, 4, 50)]
    assert counts[0] > 1.4 * counts[1] > 2.4 * counts[2] > 10 * counts[3] > 0 and max(r.turbine_id for r in rows) == 50
    assert 0.09 < sum(r._late for r in rows) / len(rows) < 0.11
    assert len({(r.turbine_id, r.timestamp) for r in rows}) > 0.97 * len(rows)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_jobs_refuse_another_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    require_utc(spark)


def test_shuffles_grow_with_the_input_and_never_shrink(spark):
    try:
        assert size_shuffles(spark, 1024) == 4
        assert spark.conf.get(INITIAL, None) is None
        assert size_shuffles(spark, 100 * 1024**4) == 1_638_400
        assert size_shuffles(spark, 1024) == 1_638_400
    finally:
        spark.conf.unset(INITIAL)
    assert input_bytes(spark.range(10)) > 0


def test_generated_feed_repeats_itself_exactly(spark):
    one = generate_readings(spark, 5000, 10, slices=3)
    two = generate_readings(spark, 5000, 10, slices=7)
    assert one.exceptAll(two).count() == 0
    keys = one.select("turbine_id", "timestamp")
    assert 0 < keys.count() - keys.distinct().count() <= 100


def test_generated_feed_can_have_a_hot_device(spark):
    rows = generate_readings(spark, 5000, 10, hot_share=0.4).groupBy("turbine_id").count().collect()
    shares = {r.turbine_id: r["count"] / 5000 for r in rows}
    assert 0.4 < shares[1] < 0.5
