"""The ledger's snapshots, and the compaction that is planned from it."""

import os
from pathlib import Path

import pytest
from landing_files import lines, write

from fleetgauge.plans import compact as compaction, ingest, ledger as book
from fleetgauge.plans.compact import compact, finish_merges, live_batches, plan_merges
from fleetgauge.plans.ingest import FILES, ingest_files, mark_taken_in, new_batches, next_batch, pending_versions, read_bronze
from fleetgauge.plans.ledger import LEDGER, SNAPSHOT, batches, fold_if_many, fold_ledger, ledger
from fleetgauge.sources.layers import BRONZE, Layers


@pytest.fixture
def layers(tmp_path):
    return Layers(str(tmp_path / "lake"))


@pytest.fixture
def landing(tmp_path):
    return tmp_path / "landing"


def deltas(layers):
    return len(list(Path(layers.path(LEDGER)).glob("*.parquet")))


def state(spark, layers):
    """What jobs derive from the ledger."""
    found = sorted((r.feed, r.ingest_batch, r.files, r.bytes) for r in batches(spark, layers).collect())
    return found, new_batches(spark, layers), next_batch(spark, layers), ingest.batch_bytes(spark, layers)


def fill(spark, layers, landing, files=3):
    for n in range(files):
        write(landing, f"{n}.csv", lines((n,), range(1, 2)))
        ingest_files(spark, layers, str(landing))
    write(landing, "0.csv", lines((0,), range(1, 3)))
    write(landing, "odd.csv", ["1,2"], "a,b")
    ingest_files(spark, layers, str(landing))


def test_a_fold_changes_nothing_but_the_files(spark, layers, landing):
    fill(spark, layers, landing)
    before = state(spark, layers)
    assert deltas(layers) == 4 and fold_ledger(spark, layers) == 4
    assert state(spark, layers) == before and deltas(layers) == 0
    assert pending_versions(spark, layers, str(landing)).count() == 0
    # the first version of 0.csv is forgotten, the refused file is not
    assert ledger(spark, layers).count() == 4 and ledger(spark, layers).where("refused").count() == 1
    assert fold_ledger(spark, layers) == 0
    write(landing, "9.csv", lines((9,), range(1, 2)))
    assert ingest_files(spark, layers, str(landing)) == 1
    assert state(spark, layers)[0][:4] == before[0] and state(spark, layers)[2] == 6
    assert fold_ledger(spark, layers) == 1
    assert [p.name for p in Path(layers.path(SNAPSHOT)).iterdir() if p.is_dir()] == ["v=2"]


def test_ingest_reads_the_snapshot_and_open_deltas_only(spark, layers, landing, monkeypatch):
    monkeypatch.setattr(ingest, "fold_if_many", lambda s, l: fold_if_many(s, l, 2))
    for n in range(8):
        write(landing, f"{n}.csv", lines((n,), range(1, 2)))
        assert ingest_files(spark, layers, str(landing)) == 1
        assert deltas(layers) <= 2
    read = ledger(spark, layers).inputFiles()
    assert len([f for f in read if f"/{LEDGER}/" in f]) == deltas(layers) == 2
    assert ledger(spark, layers).select("_source_file").distinct().count() == 8


@pytest.mark.parametrize("stop", ["remove_file", "batches"])
def test_a_fold_that_stops_half_way_does_no_harm(spark, layers, landing, monkeypatch, stop):
    fill(spark, layers, landing)
    fold_ledger(spark, layers)
    write(landing, "9.csv", lines((9,), range(1, 2)))
    ingest_files(spark, layers, str(landing))
    before = state(spark, layers)
    with monkeypatch.context() as patch:
        # either the snapshot is written and no delta removed, or only its first part is written
        patch.setattr(book, stop, lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fold_ledger(spark, layers)
    assert state(spark, layers) == before and deltas(layers) == 1
    assert ingest_files(spark, layers, str(landing)) == 0
    assert fold_ledger(spark, layers) == 1 and state(spark, layers) == before
    assert len([p for p in Path(layers.path(SNAPSHOT)).iterdir() if p.is_dir()]) == 1


def test_an_older_file_put_back_is_read_and_is_the_newest(spark, layers, landing):
    for power, time in ((1.0, 2_000), (2.0, 1_000)):
        write(landing, "a.csv", [f"2022-03-01 00:00:00,1,1.0,1,{power}"])
        os.utime(landing / "a.csv", (time, time))
        assert ingest_files(spark, layers, str(landing)) == 1
        fold_ledger(spark, layers)
    entry = ledger(spark, layers).collect()
    assert len(entry) == 1 and entry[0]._file_modified.timestamp() == 1_000


def test_many_tiny_batches_are_packed_to_the_target(spark, layers, landing, monkeypatch):
    for n in range(9):
        write(landing, f"{n}.csv", lines((n,), range(1, 2)) * (9 if n == 4 else 1))
    ingest_files(spark, layers, str(landing), files_per_batch=1)
    known = sorted(new_batches(spark, layers))
    sizes = {(r.feed, r.ingest_batch): r.bytes for r in batches(spark, layers).collect()}
    large = max(sizes, key=sizes.get)
    small = max(v for k, v in sizes.items() if k != large)
    target = 3 * small
    assert plan_merges(spark, layers, target) == []
    mark_taken_in(spark, layers, known[:-1])
    plan = plan_merges(spark, layers, target)
    # oldest first, each about the target; the large one and the one not taken in stay, as may a last one without a partner
    packed, wanted = [b for group in plan for b in group], [b for b in known[:-1] if b != large]
    alone = set(wanted) - set(packed)
    assert packed == wanted[: len(packed)] and len(alone) <= 1 and len(plan) > 1
    assert all(target / 2 <= sum(sizes[b] for b in group) < 1.5 * target for group in plan[:-1])

    before = sorted(map(str, read_bronze(spark, layers).collect()))
    whole, read = [], Layers.read
    with monkeypatch.context() as patch:
        patch.setattr(Layers, "read", lambda self, s, table, *r: whole.append(table) or read(self, s, table, *r))
        new = compact(spark, layers, target)
    assert BRONZE not in whole
    assert len(new) == len(plan) and sorted(map(str, read_bronze(spark, layers).collect())) == before
    assert {(r.feed, r.ingest_batch) for r in live_batches(spark, layers).collect()} == {large, *alone, *((FILES, n) for n in new)}
    assert new_batches(spark, layers) == [known[-1]] and compact(spark, layers, target) == []
    assert pending_versions(spark, layers, str(landing)).count() == 0
    # the new batches are of the right size, so a larger target merges them further
    assert len(compact(spark, layers, 100 * target)) == 1
    assert sorted(map(str, read_bronze(spark, layers).collect())) == before


def test_a_merge_that_stops_is_finished_by_the_next_run(spark, layers, landing, monkeypatch):
    for n in range(4):
        write(landing, f"{n}.csv", lines((n,), range(1, 2)))
    ingest_files(spark, layers, str(landing), files_per_batch=1)
    mark_taken_in(spark, layers, new_batches(spark, layers))
    before = sorted(map(str, read_bronze(spark, layers).collect()))
    real, done = compaction._empty, []

    def once(*a):
        done.append(a) or real(*a) if not done else 1 / 0

    monkeypatch.setattr(compaction, "_empty", once)
    with pytest.raises(ZeroDivisionError):
        compact(spark, layers)
    monkeypatch.setattr(compaction, "_empty", real)
    assert read_bronze(spark, layers).count() > len(before)
    assert len(finish_merges(spark, layers)) == 3 and finish_merges(spark, layers) == []
    assert sorted(map(str, read_bronze(spark, layers).collect())) == before and compact(spark, layers) == []
