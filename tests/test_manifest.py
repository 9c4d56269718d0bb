"""Manifests and all-or-nothing appends."""

import glob
import json
import os

import pytest

from airlens.plans.batch import run_batch
from airlens.sinks import files as sinks
from airlens.sinks.files import write_readings
from airlens.sources import appends
from airlens.sources.files import (
    load_batch_summary,
    load_batch_views,
    quarantine_readings,
    read_hourly_view,
    read_quarantine,
    read_readings,
)
from airlens.sources.manifest import Draft, current
from airlens.schemas import READING_COLUMNS
from airlens.streaming import speed
from fixtures import reading, readings_df

T = "2026-07-02T10:00:00Z"


def rows(*cities):
    return [reading(c, "pm25", 20.0 + i, "ug/m3", T) for i, c in enumerate(cities)]


def test_a_reader_sees_the_views_of_one_commit(spark, scratch, monkeypatch):
    run_batch(spark, scratch, readings=readings_df(spark, rows("A")))

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr("airlens.plans.batch.write_summary_view", dies)      # the hourly view is written by then
    with pytest.raises(RuntimeError, match="lost"):
        run_batch(spark, scratch, readings=readings_df(spark, rows("A", "B")))
    hourly, summary = load_batch_views(spark, scratch)
    assert [r.city for r in hourly.collect()] == [r.city for r in summary.collect()] == ["A"]
    assert [r.city for r in read_hourly_view(spark, scratch).collect()] == ["A"]
    monkeypatch.undo()
    run_batch(spark, scratch, readings=readings_df(spark, rows("A", "B")))
    assert sorted(r.city for r in load_batch_summary(spark, scratch).collect()) == ["A", "B"]
    assert len(os.listdir(os.path.join(scratch, "hourly_city_aqi"))) == 2        # what the lost run left is gone


def test_old_commits_and_their_folders_go(spark, scratch):
    for i in range(5):
        run_batch(spark, scratch, readings=readings_df(spark, rows(f"C{i}")))
    assert len(glob.glob(os.path.join(scratch, "_manifests", "m-*.json"))) == 2
    assert len(os.listdir(os.path.join(scratch, "hourly_city_aqi"))) == 2
    assert [r.city for r in load_batch_summary(spark, scratch).collect()] == ["C4"]


def test_reading_costs_the_same_after_many_commits(spark, scratch, monkeypatch):
    from airlens.sources import manifest

    calls = []
    real = manifest.file_system
    monkeypatch.setattr(manifest, "file_system", lambda s, p: (calls.append(p), real(s, p))[1])

    def cost():
        calls.clear()
        current(spark, scratch)
        return len(calls)

    Draft(spark, scratch).commit()
    first = cost()
    for _ in range(7):
        Draft(spark, scratch).commit()
    assert cost() == first == 2


def test_a_second_writer_of_the_same_commit_fails(spark, scratch):
    one, two = Draft(spark, scratch), Draft(spark, scratch)
    one.details["by"] = "one"
    one.commit()
    with pytest.raises(RuntimeError, match="another job"):
        two.commit()
    assert current(spark, scratch).details == {"by": "one"}


def test_no_commit_yet(spark, scratch):
    assert current(spark, scratch) is None and load_batch_views(spark, scratch) is None
    assert load_batch_summary(spark, scratch).count() == 0


# --- appends ------------------------------------------------------------------

def cut_off(monkeypatch, after):
    """Moves fail once ``after`` of them are done."""
    real, done = appends.move, []

    def move(spark, source, target):
        if len(done) == after:
            raise RuntimeError("lost")
        done.append(source)
        real(spark, source, target)

    monkeypatch.setattr(appends, "move", move)


@pytest.mark.parametrize("after", [0, 1, 2])
def test_readers_see_all_of_an_append_that_was_cut_off(spark, scratch, monkeypatch, after):
    raw = os.path.join(scratch, "raw")
    write_readings(readings_df(spark, rows("A")), "local", directory=raw)
    cut_off(monkeypatch, after)
    with pytest.raises(RuntimeError, match="lost"):
        write_readings(readings_df(spark, rows("B", "C", "D")).repartition(3), "local", directory=raw)
    monkeypatch.undo()
    assert sorted(r.city for r in read_readings(spark, raw).collect()) == ["A", "B", "C", "D"]
    assert os.listdir(scratch) == ["raw"]
    stream = speed.read_stream(spark, raw)
    assert stream.isStreaming


def test_readers_see_nothing_before_the_commit(spark, scratch, monkeypatch):
    raw = os.path.join(scratch, "raw")
    write_readings(readings_df(spark, rows("A")), "local", directory=raw)

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "commit_append", dies)
    with pytest.raises(RuntimeError, match="lost"):
        write_readings(readings_df(spark, rows("B", "C")), "local", directory=raw)
    monkeypatch.undo()
    assert [r.city for r in read_readings(spark, raw).collect()] == ["A"]


def test_the_next_writer_finishes_an_append(spark, scratch, monkeypatch):
    raw = os.path.join(scratch, "raw")
    cut_off(monkeypatch, 1)
    with pytest.raises(RuntimeError, match="lost"):
        write_readings(readings_df(spark, rows("A", "B")).repartition(2), "local", directory=raw)
    monkeypatch.undo()
    write_readings(readings_df(spark, rows("C")), "local", directory=raw)
    cities = [json.loads(line)["city"] for f in glob.glob(os.path.join(raw, "*.json")) for line in open(f)]
    assert sorted(cities) == ["A", "B", "C"]


# --- malformed lines ----------------------------------------------------------

def test_malformed_lines_are_put_aside(spark, scratch):
    raw, aside = os.path.join(scratch, "raw"), os.path.join(scratch, "aside")
    os.makedirs(os.path.join(raw, "deeper"))
    good = [json.dumps(dict(zip(READING_COLUMNS, r))) for r in rows("A", "B")]
    with open(os.path.join(raw, "one.json"), "w") as f:
        f.write("\n".join([good[0], "{oops", "", '"text"']) + "\n")
    with open(os.path.join(raw, "deeper", "two.json"), "w") as f:
        f.write("\n".join(['{"city": "X", "value": "abc"}', good[1]]) + "\n")
    readings, counts = quarantine_readings(spark, raw, aside)
    assert counts == {"lines": 5, "malformed": 3}
    assert readings.columns == READING_COLUMNS and sorted(r.city for r in readings.collect()) == ["A", "B"]
    lines = read_quarantine(spark, aside).collect()
    assert sorted(r.line for r in lines) == sorted(["{oops", '"text"', '{"city": "X", "value": "abc"}'])
    assert sorted(os.path.basename(r.file) for r in lines) == ["one.json", "one.json", "two.json"]
    assert all(r.quarantined_at is not None for r in lines)


def test_clean_files_leave_no_quarantine(spark, scratch):
    raw, aside = os.path.join(scratch, "raw"), os.path.join(scratch, "aside")
    write_readings(readings_df(spark, rows("A")), "local", directory=raw)
    readings, counts = quarantine_readings(spark, raw, aside)
    assert counts == {"lines": 1, "malformed": 0} and readings.count() == 1
    assert sorted(os.listdir(scratch)) == ["raw"]
