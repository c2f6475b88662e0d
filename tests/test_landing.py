"""Landing files, bronze, the ledger."""

import json
import os

import pytest
from landing_files import HEADER, lines, write

from fleetgauge.plans.compact import merge_batches
from fleetgauge.plans.ingest import FILES, bronze_by_day, ingest_files, mark_taken_in, new_batches, read_bronze, refused
from fleetgauge.sources.landing import read_landing
from fleetgauge.sources.layers import ANOMALIES, BRONZE, SILVER, Layers
from fleetgauge.streaming.feed import start_feed


@pytest.fixture
def layers(tmp_path):
    return Layers(str(tmp_path / "lake"), env="dev")


def load(spark, tmp_path, rows, header=HEADER):
    write(tmp_path / "landing", "data_group_1.csv", rows, header)
    return read_landing(spark, str(tmp_path / "landing"))


def test_types_metadata_and_line_ends(spark, tmp_path):
    df = load(spark, tmp_path, ["2022-03-01 00:00:00,42,11.1,180,2.5"])
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert kinds == {
        "timestamp": "timestamp", "turbine_id": "int", "wind_speed": "double", "wind_direction": "int",
        "power_output": "double", "_rescued_data": "string", "_ingested_at": "timestamp",
        "_source_file": "string", "_file_modified": "timestamp", "_file_size": "bigint",
    }
    row = df.first()
    assert (row.turbine_id, row.wind_direction, row.power_output, row._rescued_data) == (42, 180, 2.5, None)
    assert row._source_file.endswith("data_group_1.csv") and row._ingested_at is not None


def test_empty_is_null_and_nan_is_nan(spark, tmp_path):
    row = load(spark, tmp_path, ["2022-03-01 00:00:00,42,NaN,,"]).first()
    assert row.wind_speed != row.wind_speed
    assert (row.wind_direction, row.power_output, row._rescued_data) == (None, None, None)


@pytest.mark.parametrize(
    "line, rescued",
    [
        ("2022-03-01 00:00:00,42,1.0,180.5,2.5", {"wind_direction": "180.5"}),
        ("2022-03-01 00:00:00,42,1.0,abc,2.5", {"wind_direction": "abc"}),
        ("bad,42,1.0,1,n/a", {"timestamp": "bad", "power_output": "n/a"}),
        ("2022-03-01 00:00:00,42,1.0,1,2.5,extra", {"_line": "2022-03-01 00:00:00,42,1.0,1,2.5,extra"}),
        ("2022-03-01 00:00:00,42", {"_line": "2022-03-01 00:00:00,42"}),
    ],
)
def test_what_does_not_fit_is_kept(spark, tmp_path, line, rescued):
    row = load(spark, tmp_path, [line]).first()
    assert json.loads(row._rescued_data) == rescued
    assert all(row[name] is None for name in rescued if name != "_line")
    assert row.turbine_id == 42


def test_reordered_header_fails_instead_of_shifting(spark, tmp_path):
    df = load(spark, tmp_path, ["42,2022-03-01 00:00:00,1,1,1"], "turbine_id,timestamp,wind_speed,wind_direction,power_output")
    with pytest.raises(Exception, match="(?i)header"):
        df.collect()


def test_ingest_reads_each_version_once(spark, tmp_path, layers):
    landing = tmp_path / "landing"
    write(landing, "data_group_1.csv", lines((1,), range(1, 3)))
    write(landing, "data_group_2.csv", lines((6,), range(1, 3)))
    assert ingest_files(spark, layers, str(landing)) == 1
    assert ingest_files(spark, layers, str(landing)) == 0
    assert read_bronze(spark, layers).count() == 2 * 49

    grown = lines((1,), range(1, 4))
    write(landing, "data_group_1.csv", grown)
    assert ingest_files(spark, layers, str(landing)) == 1
    assert read_bronze(spark, layers).count() == 2 * 49 + len(grown)
    assert ingest_files(spark, layers, str(landing)) == 0


def test_same_size_overwrite_is_noticed_by_its_time(spark, tmp_path, layers):
    landing = tmp_path / "landing"
    write(landing, "a.csv", ["2022-03-01 00:00:00,1,1.0,1,2.5"])
    ingest_files(spark, layers, str(landing))
    write(landing, "a.csv", ["2022-03-01 00:00:00,1,1.0,1,3.5"])
    os.utime(landing / "a.csv", (2_000_000_000, 2_000_000_000))
    assert ingest_files(spark, layers, str(landing)) == 1
    assert sorted(r.power_output for r in read_bronze(spark, layers).collect()) == [2.5, 3.5]


def test_batches_hold_a_bounded_number_of_files(spark, tmp_path, layers):
    landing = tmp_path / "landing"
    for n in range(5):
        write(landing, f"f {n}.csv", [f"2022-03-01 00:00:00,{n},1.0,1,2.5"])
    write(landing, "empty.csv", [])
    assert ingest_files(spark, layers, str(landing), files_per_batch=2) == 3
    assert ingest_files(spark, layers, str(landing), files_per_batch=2) == 0
    assert {r.turbine_id for r in read_bronze(spark, layers).collect()} == set(range(5))


def test_day_filter_prunes_bronze_partitions(spark, tmp_path, layers):
    write(tmp_path / "landing", "a.csv", lines((1,), range(1, 6)))
    ingest_files(spark, layers, str(tmp_path / "landing"))
    plan = bronze_by_day(spark, layers).filter("date = DATE'2022-03-02'")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [isnotnull(date" in plan


def test_merge_keeps_the_readings(spark, tmp_path, layers):
    landing = tmp_path / "landing"
    for n in range(3):
        write(landing, f"{n}.csv", lines((n,), range(1, 3)))
    ingest_files(spark, layers, str(landing), files_per_batch=1)
    before = sorted(map(str, read_bronze(spark, layers).collect()))
    batches = new_batches(spark, layers)
    assert batches == [(FILES, 1), (FILES, 2), (FILES, 3)]
    mark_taken_in(spark, layers, batches)
    merge_batches(spark, layers, batches)
    assert sorted(map(str, read_bronze(spark, layers).collect())) == before
    assert new_batches(spark, layers) == []
    assert ingest_files(spark, layers, str(landing)) == 0


def test_layer_routing():
    dev, prod = Layers("/lake", env="dev"), Layers("/lake")
    assert dev.table_name(SILVER) == "silver_dev.turbine_data.silver_turbine_readings"
    assert prod.path(ANOMALIES) == "/lake/gold/turbine_data/turbine_anomalies"
    assert prod.table_name(BRONZE) == "bronze.turbine_data.bronze_turbine_readings"


def test_batch_and_stream_read_every_file_whatever_its_name(spark, tmp_path):
    import gzip

    from landing_files import HEADER

    folder = tmp_path / "any"
    for number, name in enumerate(("a.csv", "b.CSV", "c.txt", "sub/deep/d.csv", "e.csv.gz")):
        data = f"{HEADER}\n2022-03-01 0{number}:00:00,7,1.0,1,1.0\n".encode()
        file = folder / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(gzip.compress(data) if name.endswith("gz") else data)
    lake = Layers(str(tmp_path / "batch"))
    ingest_files(spark, lake, str(folder))
    hours = [str(r.timestamp) for r in read_bronze(spark, lake).orderBy("timestamp").collect()]
    assert hours == [f"2022-03-01 0{n}:00:00" for n in range(5)]
    other = Layers(str(tmp_path / "stream"))
    start_feed(spark, other, str(folder), clean=False).awaitTermination()
    assert [str(r.timestamp) for r in read_bronze(spark, other).orderBy("timestamp").collect()] == hours


def test_columns_are_found_by_name(spark, tmp_path):

    folder = tmp_path / "landing"
    write(folder, "good.csv", ["2022-03-01 00:00:00,7,1.0,1,1.0"])
    write(folder, "shifted.csv", ["7,2022-03-01 01:00:00,1.5,2,2.5", "x7,bad,1.5,2,2.5"], "turbine_id,timestamp,wind_speed,wind_direction,power_output")
    write(folder, "more.csv", ["80,2022-03-01 02:00:00,7,1.0,1,3.0,x", ",2022-03-01 02:30:00,7,1.0,1,3.0,", "1,2"], f"gear_temp,{HEADER},more")
    write(folder, "less.csv", ["2022-03-01 03:00:00,7", "2022-03-01 03:30:00,7,9"], "timestamp,turbine_id")
    write(folder, "spaced.csv", ["2022-03-01 04:00:00, 7,1.0, 1,1.0"], HEADER.replace(",", ", "))
    write(folder, "quoted.csv", ["2022-03-01 05:00:00,7,1.0,1,1.0"], HEADER.replace("timestamp", '"Timestamp"'))
    write(folder, "commas.csv", ['2022-03-01 06:00:00,7,"1,5"'], 'timestamp,turbine_id,"gear, left"')
    write(folder, "odd.csv", ["2022-03-01 07:00:00,7,a,b,c,d,e"], "timestamp,turbine_id,,t,t,_line,T")
    (folder / "bom.csv").write_bytes(f"\ufeff{HEADER}\n2022-03-01 08:00:00,7,1.0,1,1.0\n".encode())
    (folder / "nothing.csv").write_bytes(b"")
    (folder / "blank.csv").write_bytes(b"\n \r\n")
    (folder / "late.csv").write_bytes(f"\n{HEADER}\n2022-03-01 09:00:00,7,1.0,1,1.0\n".encode())
    write(folder, "twice.csv", ["2022-03-01 00:00:00,7,8"], "timestamp,turbine_id,Turbine_ID")
    write(folder, "bare.csv", ["2022-03-01 00:00:00,7,1.0,1,1.0"], "2022-03-01 00:00:00,7,1.0,1,1.0")
    (folder / "broken.csv.gz").write_bytes(b"not packed")
    batch, stream = Layers(str(tmp_path / "batch")), Layers(str(tmp_path / "stream"))
    assert ingest_files(spark, batch, str(folder)) == 1
    start_feed(spark, stream, str(folder), clean=False).awaitTermination()
    found = {}
    for lake in (batch, stream):
        rows = read_bronze(spark, lake).orderBy("_source_file", "timestamp", "turbine_id", "_rescued_data").collect()
        found[lake] = [(r._source_file.rsplit("/", 1)[1], r.timestamp and str(r.timestamp)[11:16], r.turbine_id, r.power_output,
                        r._rescued_data and json.loads(r._rescued_data)) for r in rows]
        assert {r._source_file.rsplit("/", 1)[1]: r.reason for r in refused(spark, lake).collect()} == {
            "twice.csv": "column turbine_id occurs twice", "bare.csv": "no column of the schema in the first line", "broken.csv.gz": "cannot be read",
        }
    assert found[batch] == found[stream] == [
        ("bom.csv", "08:00", 7, 1.0, None),
        ("commas.csv", "06:00", 7, None, {"gear, left": "1,5"}),
        ("good.csv", "00:00", 7, 1.0, None),
        ("late.csv", "09:00", 7, 1.0, None),
        ("less.csv", "03:00", 7, None, None),
        ("less.csv", "03:30", 7, None, {"_line": "2022-03-01 03:30:00,7,9"}),
        ("more.csv", None, None, None, {"timestamp": "2", "gear_temp": "1", "_line": "1,2"}),
        ("more.csv", "02:00", 7, 3.0, {"gear_temp": "80", "more": "x"}),
        ("more.csv", "02:30", 7, 3.0, None),
        ("odd.csv", "07:00", 7, None, {"_c2": "a", "t": "b", "t_4": "c", "_line_5": "d", "T": "e"}),
        ("quoted.csv", "05:00", 7, 1.0, None),
        ("shifted.csv", None, None, 2.5, {"timestamp": "bad", "turbine_id": "x7"}),
        ("shifted.csv", "01:00", 7, 2.5, None),
        ("spaced.csv", "04:00", 7, 1.0, None),
    ]
    assert ingest_files(spark, batch, str(folder)) == 0

    # A corrected file is a new version and is read.
    write(folder, "twice.csv", ["2022-03-01 01:00:00,7,1.0,1,1.0", "2022-03-01 03:00:00,7,1.0,1,1.0"])
    assert ingest_files(spark, batch, str(folder)) == 1
    assert read_bronze(spark, batch).count() == 16


def test_the_text_is_parsed_once_and_not_shuffled(spark, tmp_path):
    from fleetgauge.sources.headers import file_layouts
    from fleetgauge.sources.landing import BAD_LINE, NAMES, landing_versions, read_by_name

    folder = tmp_path / "landing"
    for n in range(6):
        write(folder, f"{n}.csv", [",".join(str(n) for _ in range(5 + n % 3))], ",".join([HEADER, *"xy"][: 1 + n % 3]))
    paths = {r._source_file: r.path for r in landing_versions(spark, str(folder)).collect()}
    layouts, refused = file_layouts(spark, paths, NAMES, [BAD_LINE])
    assert len(layouts) == 6 and refused == []
    plan = read_by_name(spark, paths, layouts)._jdf.queryExecution().executedPlan().toString()
    # one scan for the schema's own header, one for each other number of columns; the places come by broadcast
    assert plan.count("FileScan csv") == 3 and plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_what_arrow_cannot_open_is_read_by_spark(spark, tmp_path, monkeypatch):
    from fleetgauge.sources import headers

    write(tmp_path / "landing", "a.csv", ["2022-03-01 00:00:00,7"], "timestamp,turbine_id")
    real = headers.file_heads
    monkeypatch.setattr(headers, "file_heads", lambda files: real(files).selectExpr(
        "_source_file", "string(NULL) AS header", "string(NULL) AS problem", "false AS opened"))
    lake = Layers(str(tmp_path / "lake"))
    ingest_files(spark, lake, str(tmp_path / "landing"))
    assert [r.turbine_id for r in read_bronze(spark, lake).collect()] == [7]


def test_a_first_line_without_end_is_refused(spark, tmp_path):
    from fleetgauge.sources.headers import file_heads

    (tmp_path / "long.csv").write_bytes(b"x" * 300_000 + b"\n")
    files = spark.createDataFrame([(f"file://{tmp_path}/long.csv",)], "_source_file string")
    row = file_heads(files, 100_000).first()
    assert row.problem == "first line longer than 100000 bytes" and row.opened and len(row.header) == 200
    assert len(file_heads(files).first().header) == 300_000


def test_only_refused_files_leave_an_empty_batch(spark, tmp_path, layers):
    write(tmp_path / "landing", "x.csv", ["1,2"], "a,b")
    assert ingest_files(spark, layers, str(tmp_path / "landing")) == 1
    assert read_bronze(spark, layers).count() == 0
    assert ingest_files(spark, layers, str(tmp_path / "landing")) == 0


def test_a_file_that_was_cut_off_does_not_stop_its_batch(spark, tmp_path, layers):
    import gzip

    landing = tmp_path / "landing"
    write(landing, "good.csv", lines([7]))
    write(landing, "shifted.csv", ["3,2022-03-01 00:00:00"], "turbine_id,timestamp")
    packed = gzip.compress("\n".join([HEADER, *lines([8], days=range(1, 31))]).encode())
    (landing / "cut.csv.gz").write_bytes(packed[: len(packed) // 2])
    (landing / "whole.csv.gz").write_bytes(gzip.compress("\n".join([HEADER, *lines([9])]).encode()))

    def counts():
        return {r.turbine_id: r["count"] for r in read_bronze(spark, layers).groupBy("turbine_id").count().collect()}

    assert ingest_files(spark, layers, str(landing)) == 1
    assert counts() == {7: 121, 3: 1, 9: 121}
    row = refused(spark, layers).first()
    assert row["_source_file"].endswith("/cut.csv.gz") and row.header == HEADER and row.reason.startswith("cannot be read to its end: ")
    assert ingest_files(spark, layers, str(landing)) == 0
    (landing / "cut.csv.gz").write_bytes(packed)
    assert ingest_files(spark, layers, str(landing)) == 1
    assert counts() == {7: 121, 3: 1, 9: 121, 8: 721}


def test_a_failure_without_a_damaged_file_is_raised(spark, tmp_path, layers, monkeypatch):
    from fleetgauge.plans import ingest

    def fail(*_):
        raise OSError("no space left; FAILED_READ_FILE")

    write(tmp_path / "landing", "good.csv", lines([7]))
    monkeypatch.setattr(ingest, "write_batch", fail)
    with pytest.raises(OSError, match="no space"):
        ingest_files(spark, layers, str(tmp_path / "landing"))
    monkeypatch.undo()
    assert ingest_files(spark, layers, str(tmp_path / "landing")) == 1


def test_the_landing_folder_is_listed_once_a_run(spark, tmp_path, layers, monkeypatch):
    from fleetgauge.plans import ingest

    for n in range(5):
        write(tmp_path / "landing", f"{n}.csv", [f"2022-03-01 00:00:00,{n},1.0,1,2.5"])
    listings = []
    real = ingest.landing_versions
    monkeypatch.setattr(ingest, "landing_versions", lambda *a: listings.append(a) or real(*a))
    assert ingest_files(spark, layers, str(tmp_path / "landing"), files_per_batch=1) >= 3
    assert len(listings) == 1
    assert {r.turbine_id for r in read_bronze(spark, layers).collect()} == set(range(5))


def test_a_stream_with_a_new_checkpoint_keeps_the_old_batches(spark, tmp_path, layers):
    import shutil

    landing = tmp_path / "landing"
    write(landing, "a.csv", ["2022-03-01 00:00:00,1,1.0,1,2.5"])
    start_feed(spark, layers, str(landing), clean=False).awaitTermination()
    shutil.move(f"{layers.base}/state/turbine_data/changes_checkpoint", str(tmp_path / "old_checkpoint"))
    write(landing, "b.csv", ["2022-03-01 00:00:00,2,1.0,1,2.5"])
    start_feed(spark, layers, str(landing), clean=False).awaitTermination()
    assert sorted(r.turbine_id for r in read_bronze(spark, layers).collect()) == [1, 2]


def streamed(spark, lake, folder):
    start_feed(spark, lake, str(folder), clean=False).awaitTermination()
    return sorted(r.power_output for r in read_bronze(spark, lake).collect())


def test_the_stream_takes_a_file_that_was_replaced(spark, tmp_path, layers):
    landing = tmp_path / "landing"
    write(landing, "a.csv", ["2022-03-01 00:00:00,1,1.0,1,2.5"])
    write(landing, "b.csv", ["2022-03-01 00:00:00,2,1.0,1,7.5"])
    assert streamed(spark, layers, landing) == [2.5, 7.5]
    assert streamed(spark, layers, landing) == [2.5, 7.5]
    # same name and size, another time
    write(landing, "a.csv", ["2022-03-01 00:00:00,1,1.0,1,3.5"])
    os.utime(landing / "a.csv", (2_000_000_000, 2_000_000_000))
    assert streamed(spark, layers, landing) == [2.5, 3.5, 7.5]
    # an older time than all others, and more rows
    write(landing, "a.csv", ["2022-03-01 00:00:00,1,1.0,1,4.5", "2022-03-01 01:00:00,1,1.0,1,5.5"])
    os.utime(landing / "a.csv", (1_000_000_000, 1_000_000_000))
    assert streamed(spark, layers, landing) == [2.5, 3.5, 4.5, 5.5, 7.5]
    # both entries write one ledger
    assert ingest_files(spark, layers, str(landing)) == 0
    write(landing, "c.csv", ["2022-03-01 00:00:00,3,1.0,1,9.5"])
    assert ingest_files(spark, layers, str(landing)) == 1
    assert streamed(spark, layers, landing) == [2.5, 3.5, 4.5, 5.5, 7.5, 9.5]
    (landing / "b.csv").rename(landing / "_b.csv")
    assert streamed(spark, layers, landing) == [2.5, 3.5, 4.5, 5.5, 7.5, 9.5]


def test_a_batch_that_failed_is_taken_by_the_next_run(spark, tmp_path, layers, monkeypatch):
    from fleetgauge.plans import ingest

    landing = tmp_path / "landing"
    write(landing, "a.csv", ["2022-03-01 00:00:00,1,1.0,1,2.5"])
    real = ingest.record_versions
    monkeypatch.setattr(ingest, "record_versions", lambda *a: 1 / 0)
    with pytest.raises(Exception, match="division by zero"):
        streamed(spark, layers, landing)
    monkeypatch.setattr(ingest, "record_versions", real)
    assert streamed(spark, layers, landing) == [2.5]


def test_a_running_stream_looks_again(spark, tmp_path, layers):
    import time

    landing = tmp_path / "landing"
    write(landing, "a.csv", ["2022-03-01 00:00:00,1,1.0,1,2.5"])
    query = start_feed(spark, layers, str(landing), clean=False, every="1 second")
    try:
        def seen(n):
            for _ in range(240):
                if layers.exists(spark, BRONZE) and read_bronze(spark, layers).count() == n:
                    return True
                time.sleep(0.25)

        assert seen(1)
        write(landing, "a.csv", ["2022-03-01 00:00:00,1,1.0,1,2.5", "2022-03-01 01:00:00,1,1.0,1,3.5"])
        assert seen(3)
    finally:
        query.stop()


def test_a_store_that_arrow_cannot_list_is_streamed_by_spark(spark, tmp_path, layers, monkeypatch):
    from fleetgauge.streaming import feed

    monkeypatch.setattr(feed, "arrow_opens", lambda uri: False)
    write(tmp_path / "landing", "a.csv", ["2022-03-01 00:00:00,1,1.0,1,2.5"])
    assert streamed(spark, layers, tmp_path / "landing") == [2.5]
    write(tmp_path / "landing", "b.csv", ["2022-03-01 00:00:00,1,1.0,1,3.5"])
    assert streamed(spark, layers, tmp_path / "landing") == [2.5, 3.5]


def test_the_state_of_a_folder(tmp_path):
    from fleetgauge.streaming.changes import arrow_opens, folder_state

    def state():
        return folder_state(f"file://{tmp_path}/in")

    assert state() == {"files": 0, "digest": "0" * 32} and not arrow_opens("nowhere://x/y")
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "a.csv").write_text("x")
    (tmp_path / "in" / "b 100%.csv").write_text("y")
    first = state()
    assert first["files"] == 2
    for name in ("_c.csv", ".d.csv", "e.csv._COPYING_"):
        (tmp_path / "in" / name).write_text("z")
    assert state() == first
    os.utime(tmp_path / "in" / "b 100%.csv", (5, 5))
    assert state()["files"] == 2 and state() != first
