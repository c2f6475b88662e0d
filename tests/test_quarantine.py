"""Bad lines set aside with their file version, and released by a corrected file."""

import os

import pytest
from landing_files import HEADER, write

from fleetgauge.plans.compact import merge_batches
from fleetgauge.plans.ingest import FILES, ingest_files, mark_taken_in, new_batches, read_bronze
from fleetgauge.plans.quarantine import open_quarantine, quarantine_report, quarantined, set_aside
from fleetgauge.sources.layers import Layers
from fleetgauge.streaming.feed import start_feed

GOOD, BAD, WORSE = "2022-03-01 00:00:00,1,1.0,1,2.5", "2022-03-01 01:00:00,x,1.0,1,2.5", "soon,1,1.0,1,2.5"


@pytest.fixture
def layers(tmp_path):
    return Layers(str(tmp_path / "lake"))


def deliver(folder, name, lines, time, header=HEADER):
    write(folder, name, lines, header)
    os.utime(folder / name, (time, time))


def opened(spark, layers):
    return sorted((r._source_file.rsplit("/", 1)[1], r._reason, r.copies, r.since.timestamp()) for r in open_quarantine(spark, layers).collect())


def test_a_corrected_file_empties_its_quarantine(spark, tmp_path, layers):
    folder = tmp_path / "landing"
    deliver(folder, "a.csv", [GOOD, BAD, WORSE, BAD], 1_000)
    deliver(folder, "b.csv", [GOOD, BAD], 1_000)
    ingest_files(spark, layers, str(folder))
    assert set_aside(spark, layers) == [(FILES, 1)] and set_aside(spark, layers) == []
    first = [("a.csv", "no device", 2, 1_000.0), ("a.csv", "no time", 1, 1_000.0), ("b.csv", "no device", 1, 1_000.0)]
    assert opened(spark, layers) == first

    # partly corrected: the old line stands under the new version, with its age
    deliver(folder, "a.csv", [GOOD, BAD, GOOD], 2_000)
    ingest_files(spark, layers, str(folder))
    # until the new batch is looked at, the file has none
    assert opened(spark, layers) == first[2:]
    set_aside(spark, layers)
    assert opened(spark, layers) == [("a.csv", "no device", 1, 1_000.0), first[2]]

    # corrected, with an older time than the version before
    deliver(folder, "a.csv", [GOOD, GOOD], 500)
    ingest_files(spark, layers, str(folder))
    set_aside(spark, layers)
    assert opened(spark, layers) == first[2:]
    report = {(r._source_file.rsplit("/", 1)[1], r._reason): (r.open_lines, r.released_lines, r.oldest and r.oldest.timestamp()) for r in quarantine_report(spark, layers).collect()}
    assert report == {("a.csv", "no device"): (0, 3, None), ("a.csv", "no time"): (0, 1, None), ("b.csv", "no device"): (1, 0, 1_000.0)}
    assert quarantined(spark, layers).where("released_by IS NOT NULL").select("released_by").distinct().count() == 1
    assert read_bronze(spark, layers).count() == 4 + 2 + 3 + 2


def test_a_refused_version_releases_nothing(spark, tmp_path, layers):
    folder = tmp_path / "landing"
    deliver(folder, "a.csv", [BAD], 1_000)
    ingest_files(spark, layers, str(folder))
    set_aside(spark, layers)
    deliver(folder, "a.csv", [GOOD], 2_000, "a,b,c,d,e")
    ingest_files(spark, layers, str(folder))
    set_aside(spark, layers)
    assert opened(spark, layers) == [("a.csv", "no device", 1, 1_000.0)]
    deliver(folder, "a.csv", [GOOD], 3_000)
    start_feed(spark, layers, str(folder), clean=False).awaitTermination()
    assert len(set_aside(spark, layers)) == 1
    assert opened(spark, layers) == []


def test_a_batch_set_aside_again_and_merged_batches_add_nothing(spark, tmp_path, layers):
    folder = tmp_path / "landing"
    deliver(folder, "a.csv", [GOOD, BAD], 1_000)
    deliver(folder, "b.csv", [GOOD, WORSE], 1_000)
    ingest_files(spark, layers, str(folder), files_per_batch=1)
    set_aside(spark, layers)
    before = opened(spark, layers)
    batches = new_batches(spark, layers)
    set_aside(spark, layers, batches)
    assert opened(spark, layers) == before and len(before) == 2
    mark_taken_in(spark, layers, batches)
    merge_batches(spark, layers, batches)
    set_aside(spark, layers)
    assert opened(spark, layers) == before
    # a version after the merge still counts as the newer one
    deliver(folder, "a.csv", [GOOD], 900)
    ingest_files(spark, layers, str(folder))
    assert opened(spark, layers) == before[1:]


def test_extra_columns_are_no_fault_and_an_empty_lake_has_none(spark, tmp_path, layers):
    assert set_aside(spark, layers) == [] and open_quarantine(spark, layers).count() == 0
    deliver(tmp_path / "landing", "a.csv", [GOOD + ",80"], 1_000, HEADER + ",gear_temp")
    ingest_files(spark, layers, str(tmp_path / "landing"))
    set_aside(spark, layers)
    assert opened(spark, layers) == [] and read_bronze(spark, layers).first()._rescued_data == '{"gear_temp":"80"}'
