"""Full build, refresh in pieces, streaming feed: all must end with the same tables."""

import logging

import pytest
from compare import connect
from landing_files import lines, write

from fleetgauge.plans.build import build_gold, build_silver, refresh
from fleetgauge.plans import reports
from fleetgauge.plans.ingest import ingest_files, read_bronze
from fleetgauge.sources.layers import ANOMALIES, BRONZE, SILVER, SUMMARY, Layers
from fleetgauge.streaming.feed import run_feed

TABLES = (SILVER, SUMMARY, ANOMALIES)


def rows(spark, layers, table):
    df = layers.read(spark, table)
    stamps = [c for c in ("_ingested_at", "_source_file") if c in df.columns]
    plain = df.drop(*stamps)
    return sorted(
        str([round(v, 9) if isinstance(v, float) else v for v in r])
        for r in plain.select(sorted(plain.columns)).collect()
    )


def full(spark, base, landing):
    layers = Layers(str(base))
    ingest_files(spark, layers, str(landing))
    build_silver(spark, layers)
    build_gold(spark, layers)
    return {t: rows(spark, layers, t) for t in TABLES}


def tables(spark, layers):
    return {t: rows(spark, layers, t) for t in TABLES}


def test_full_build_against_sql(spark, tmp_path):
    write(tmp_path / "landing", "data_group_9.csv", lines())
    full(spark, tmp_path / "lake", tmp_path / "landing")
    layers = Layers(str(tmp_path / "lake"))
    con = connect(str(tmp_path))
    con.execute(f"""CREATE VIEW raw AS SELECT * FROM read_csv('{tmp_path}/landing/*.csv', header=true, columns={{
        'timestamp': 'TIMESTAMP', 'turbine_id': 'INTEGER', 'wind_speed': 'DOUBLE', 'wind_direction': 'INTEGER',
        'power_output': 'DOUBLE'}})""")
    expected = con.execute("""
        WITH newest AS (
          SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY turbine_id, timestamp
            ORDER BY power_output DESC NULLS LAST, wind_speed DESC NULLS LAST, wind_direction DESC NULLS LAST) = 1),
        valid AS (
          SELECT turbine_id, timestamp, CASE WHEN NOT isnan(power_output) AND power_output >= 0 THEN power_output END AS p
          FROM newest),
        filled AS (
          SELECT *, last_value(p IGNORE NULLS) OVER (PARTITION BY turbine_id ORDER BY timestamp) AS f FROM valid)
        SELECT turbine_id, timestamp::DATE, min(f), max(f), round(avg(f), 9), count(*),
               count(*) FILTER (p IS NULL AND f IS NOT NULL)
        FROM filled GROUP BY ALL ORDER BY ALL""").fetchall()
    got = layers.read(spark, SUMMARY).selectExpr(
        "turbine_id", "date", "min_power_output", "max_power_output", "round(avg_power_output, 9)",
        "reading_count", "imputed_count",
    )
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_refresh_from_nothing_equals_full_build(spark, tmp_path):
    write(tmp_path / "landing", "a.csv", lines() + ["bad,41,1.0,1,1.0", "2022-03-02 00:30:00,,1.0,1,"])
    expected = full(spark, tmp_path / "one", tmp_path / "landing")
    layers = Layers(str(tmp_path / "two"))
    ingest_files(spark, layers, str(tmp_path / "landing"))
    assert len(refresh(spark, layers)) == 6
    assert tables(spark, layers) == expected
    assert refresh(spark, layers) == []


def deliveries():
    """The same readings in pieces: days out of order, a correction, a value that empties later fills."""
    by_day = {d: lines((41, 42), range(d, d + 1), seed=d) for d in range(1, 7)}
    # Turbine 43 reports rarely, so its fills reach over days; its first value comes late.
    rare = [f"2022-03-{d:02d} 10:00:00,43,,," for d in (2, 4, 6)]
    return [
        by_day[1] + by_day[2] + rare,
        by_day[4],
        by_day[3] + by_day[6] + by_day[5] + ["2022-03-03 09:00:00,44,1.0,1,1.0"],
        ["2022-03-01 12:00:00,43,5.5,5,5.5"],
        ["2022-03-01 12:00:00,43,,,", "bad,43,1.0,1,1.0", ",43,1.5,,1.5"],
    ]


def test_refresh_in_pieces_equals_full_build(spark, tmp_path):
    layers = Layers(str(tmp_path / "pieces"))
    rewritten = []
    for n, part in enumerate(deliveries()):
        write(tmp_path / "landing", f"part_{n}.csv", part)
        ingest_files(spark, layers, str(tmp_path / "landing"))
        rewritten.append({str(d) for d in refresh(spark, layers)})
    # All pieces at once differ in ingestion order, so the full build reads the same bronze.
    again = Layers(str(tmp_path / "full"))
    bronze = layers.path("bronze_turbine_readings")
    spark.read.parquet(bronze).write.partitionBy("feed", "ingest_batch", "date").parquet(
        again.path("bronze_turbine_readings")
    )
    build_silver(spark, again)
    build_gold(spark, again)
    assert tables(spark, layers) == tables(spark, again)
    # New days alone touch themselves; the late first value also reaches the fills after it.
    assert rewritten[1] == {"2022-03-04"}
    assert rewritten[3] >= {"2022-03-01", "2022-03-02", "2022-03-04"}


def test_a_day_whose_last_real_reading_is_corrected_away_loses_its_anomaly_rows(spark, tmp_path):
    layers = Layers(str(tmp_path / "lake"))
    landing = tmp_path / "landing"
    write(landing, "a.csv", ["2022-03-01 00:00:00,1,1.0,1,2.0", "2022-03-02 00:00:00,1,1.0,1,3.0"])
    ingest_files(spark, layers, str(landing))
    refresh(spark, layers)
    assert layers.read(spark, ANOMALIES).count() == 2
    write(landing, "b.csv", ["2022-03-02 00:00:00,1,1.0,1,-1"])
    ingest_files(spark, layers, str(landing))
    refresh(spark, layers)
    assert [str(r.date) for r in layers.read(spark, ANOMALIES).collect()] == ["2022-03-01"]
    assert [r.power_output for r in layers.read(spark, SILVER).orderBy("date").collect()] == [2.0, 2.0]


def test_a_refresh_that_stopped_before_its_mark_can_run_again(spark, tmp_path, monkeypatch):
    layers = Layers(str(tmp_path / "lake"))
    landing = tmp_path / "landing"
    expected = None
    for n, part in enumerate([deliveries()[0], deliveries()[3]]):
        write(landing, f"part_{n}.csv", part)
        ingest_files(spark, layers, str(landing))
        with monkeypatch.context() as patch:
            patch.setattr("fleetgauge.plans.build.mark_taken_in", _stop)
            with pytest.raises(KeyboardInterrupt):
                refresh(spark, layers)
        expected = tables(spark, layers)
        refresh(spark, layers)
        assert tables(spark, layers) == expected
    again = Layers(str(tmp_path / "lake"))
    build_silver(spark, again)
    build_gold(spark, again)
    assert tables(spark, again) == expected


def _stop(*_):
    raise KeyboardInterrupt


def test_busy_days_do_not_change_the_tables(spark, tmp_path):
    from dataclasses import replace

    from fleetgauge.config import DEFAULT

    write(tmp_path / "landing", "a.csv", lines())
    expected = full(spark, tmp_path / "one", tmp_path / "landing")
    cfg = replace(DEFAULT, busy_day_rows=10)
    layers = Layers(str(tmp_path / "two"))
    ingest_files(spark, layers, str(tmp_path / "landing"), cfg)
    refresh(spark, layers, cfg)
    assert tables(spark, layers) == expected
    build_silver(spark, layers, cfg)
    assert tables(spark, layers) == expected


def test_build_warns_about_remaining_nulls(spark, tmp_path, caplog):
    write(tmp_path / "landing", "a.csv", ["2022-03-01 00:00:00,1,1.0,1,"])
    layers = Layers(str(tmp_path / "lake"))
    ingest_files(spark, layers, str(tmp_path / "landing"))
    with caplog.at_level(logging.WARNING):
        assert build_silver(spark, layers)["power_output"] == 1
    assert "power_output" in caplog.text


def test_two_stream_runs_equal_one_full_build(spark, tmp_path):
    landing, layers = tmp_path / "landing", Layers(str(tmp_path / "lake"))
    write(landing, "data_group_1.csv", lines((1, 2), range(1, 4), seed=5))
    run_feed(spark, layers, str(landing), timeout_seconds=300)
    write(landing, "data_group_2.csv", lines((6, 7), range(2, 5), seed=6))
    run_feed(spark, layers, str(landing), timeout_seconds=300)
    assert tables(spark, layers) == full(spark, tmp_path / "full", landing)

    # A file changed in place is seen by the stream, and only it is read; nothing is left to the file job.
    write(landing, "data_group_1.csv", lines((1, 2), range(1, 5), seed=5))
    before = read_bronze(spark, layers).count()
    run_feed(spark, layers, str(landing), timeout_seconds=300)
    assert read_bronze(spark, layers).count() == before + len(lines((1, 2), range(1, 5), seed=5))
    assert ingest_files(spark, layers, str(landing)) == 0 and refresh(spark, layers) == []
    assert tables(spark, layers) == full(spark, tmp_path / "full2", landing)


def test_command_line_run_and_plain_sql(spark, tmp_path):
    from fleetgauge.__main__ import main

    write(tmp_path / "landing", "a.csv", lines())
    main([str(tmp_path / "landing"), str(tmp_path / "lake"), "--env", "dev", "--full"])
    layers = Layers(str(tmp_path / "lake"), env="dev")
    assert set(layers.expose(spark)) == {BRONZE, *TABLES}
    silver = layers.read(spark, SILVER)
    assert spark.sql(f"SELECT * FROM {SILVER} WHERE turbine_id = 42 AND wind_direction_was_invalid").count() == (
        reports.invalid_direction_rows(silver, 42).count()
    )
    assert spark.sql(f"SELECT * FROM {ANOMALIES} WHERE is_anomaly = true").count() == (
        reports.anomalous_rows(layers.read(spark, ANOMALIES)).count()
    )
    assert spark.sql(f"SELECT * FROM {SUMMARY} WHERE imputed_count > 0").count() == (
        reports.imputed_days(layers.read(spark, SUMMARY)).count()
    )
    report = layers.read(spark, "remaining_nulls")
    assert {r.column_name for r in report.collect()} == {"power_output", "wind_speed", "wind_direction"}


def test_device_filter_reaches_the_files(spark, tmp_path):
    write(tmp_path / "landing", "a.csv", lines())
    layers = Layers(str(tmp_path / "lake"))
    ingest_files(spark, layers, str(tmp_path / "landing"))
    refresh(spark, layers)
    df = reports.turbine_daily(layers.read(spark, SUMMARY).filter("date = DATE'2022-03-02'"), 42)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    assert "EqualTo(turbine_id,42)" in text and "PartitionFilters: [isnotnull(date" in text
    assert df.count() == 1


def day_files(layers, table):
    from pathlib import Path

    return {f.relative_to(layers.path(table)).parts[0]: f.name for f in Path(layers.path(table)).glob("*/*.parquet")}


def test_refresh_after_a_full_build_has_nothing_to_do(spark, tmp_path):
    from fleetgauge.plans.build import build_all

    layers, landing = Layers(str(tmp_path / "lake")), tmp_path / "landing"
    write(landing, "a.csv", lines(days=range(1, 6)))
    ingest_files(spark, layers, str(landing))
    build_all(spark, layers)
    assert refresh(spark, layers) == []
    # And the next delivery goes on from the build's values.
    write(landing, "b.csv", lines(days=range(6, 7), seed=8) + ["2022-03-06 10:00:00,77,,,"])
    ingest_files(spark, layers, str(landing))
    assert [str(d) for d in refresh(spark, layers)] == ["2022-03-06"]
    assert tables(spark, layers) == full(spark, tmp_path / "full", landing)


def test_only_days_that_change_are_written(spark, tmp_path):
    layers, landing = Layers(str(tmp_path / "lake")), tmp_path / "landing"
    # Device 9 reports on the first day only, device 8 has a value on every day.
    write(landing, "a.csv", lines(days=range(1, 9)) + ["2022-03-01 03:00:00,9,4.0,9,3.25"]
          + [f"2022-03-{d:02d} 01:00:00,8,2.0,{d},1.75" for d in range(1, 9)])
    ingest_files(spark, layers, str(landing))
    refresh(spark, layers)

    none = "__HIVE_DEFAULT_PARTITION__"

    def delivered(name, rows):
        before = {t: day_files(layers, t) for t in (SILVER, "day_values")}
        write(landing, name, rows)
        ingest_files(spark, layers, str(landing))
        days = {str(d or none) for d in refresh(spark, layers)}
        for table, files in before.items():
            now = day_files(layers, table)
            assert {d for d in now if files.get(d) != now[d]} == {f"date={d}" for d in days}, table
        return days

    # A time that cannot be read, from a device whose first day has a value early: its first day's opening alone changes.
    got = delivered("b.csv", ["bad,8,2.5,10,1.25", "2022-03-09 01:00:00,8,2.0,1,1.5"])
    assert got == {none, "2022-03-09", "2022-03-01"}
    # The silent device comes back without a value and takes the one it had nine days before.
    assert delivered("c.csv", ["2022-03-10 01:00:00,9,,,"]) == {"2022-03-10"}
    back = layers.read(spark, SILVER).filter("turbine_id = 9 AND date = DATE'2022-03-10'").first()
    assert (back.power_output, back.power_output_was_imputed) == (3.25, True)
    # A late old row reaches as far as the next value of its device.
    assert delivered("d.csv", ["2022-03-05 05:00:00,9,1.0,1,2.75"]) == {"2022-03-05", "2022-03-10"}
    assert delivered("e.csv", ["2022-03-03 05:00:00,8,1.0,1,2.75"]) == {"2022-03-03", "2022-03-04"}
    assert tables(spark, layers) == full(spark, tmp_path / "full", landing)


def test_a_hot_device_day_is_split_in_the_anomaly_join(spark, tmp_path):
    from fleetgauge.operators.anomalies import day_stats, flag_anomalies

    rows = spark.range(300_000, numPartitions=6).selectExpr(
        "int(if(id % 10 < 8, 0, id % 97)) AS turbine_id",
        "timestamp_seconds(1646092800 + int(if(id % 10 < 8, 0, id % 5)) * 86400 + id % 86400) AS timestamp",
        "double(id % 13) AS power_output", "false AS power_output_was_imputed", "uuid() AS note",
    )
    rows.write.parquet(str(tmp_path / "readings"))
    readings = spark.read.parquet(str(tmp_path / "readings"))
    day_stats(readings).write.parquet(str(tmp_path / "stats"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
    }
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        found = flag_anomalies(readings, stats=spark.read.parquet(str(tmp_path / "stats")))
        assert len(found.collect()) == 300_000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in conf:
            spark.conf.unset(name)


def test_a_refresh_of_one_day_opens_only_its_folders(spark, tmp_path, monkeypatch):
    layers, landing = Layers(str(tmp_path / "lake")), tmp_path / "landing"
    write(landing, "a.csv", lines(days=range(1, 9)))
    ingest_files(spark, layers, str(landing))
    refresh(spark, layers)
    write(landing, "b.csv", lines(days=range(8, 9), seed=4))
    ingest_files(spark, layers, str(landing))

    opened, whole = {}, []
    days, read = Layers.read_days, Layers.read

    def read_days(self, session, table, *rest):
        found = days(self, session, table, *rest)
        opened.setdefault(table, set()).update(f.split("date=")[1].split("/")[0] for f in found.inputFiles())
        return found

    monkeypatch.setattr(Layers, "read_days", read_days)
    monkeypatch.setattr(Layers, "read", lambda self, session, table, *rest: whole.append(table) or read(self, session, table, *rest))
    assert [str(d) for d in refresh(spark, layers)] == ["2022-03-08"]
    assert opened == {t: {"2022-03-08"} for t in (SILVER, ANOMALIES, "day_values")}
    assert not {SILVER, SUMMARY, ANOMALIES, "day_values", BRONZE} & set(whole)
