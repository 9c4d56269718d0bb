"""Speed layer on Structured Streaming: one file per trigger."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from airlens.operators.batch import prepare
from airlens.operators.windows import windowed_aqi
from airlens.schemas import READING, READING_COLUMNS
from airlens.streaming import speed
from fixtures import reading, readings_df

COLS = ["window_start", "window_end", "city", "country", "aqi", "dominant_pollutant",
        "reading_count", "dangerous", "latitude", "longitude"]


def land(directory, batches):
    """One JSON-lines file per batch, modification times in batch order."""
    os.makedirs(directory, exist_ok=True)
    base = time.time() - 10_000
    for i, rows in enumerate(batches):
        path = os.path.join(directory, f"part-{i:03d}.jsonl")
        with open(path, "w") as f:
            for r in rows:
                f.write(json.dumps(dict(zip(READING_COLUMNS, r))) + "\n")
        os.utime(path, (base + i * 10, base + i * 10))


def run_stream(spark, root, batches, snapshot_mode="batch"):
    raw = os.path.join(root, "raw")
    land(raw, batches)
    stream = speed.read_stream(spark, raw, max_files_per_trigger=1)
    q = speed.start(speed.windowed_stream(stream), os.path.join(root, "out"),
                    os.path.join(root, "ckpt"), available_now=True, snapshot_mode=snapshot_mode)
    q.awaitTermination()
    assert q.exception() is None
    return os.path.join(root, "out")


def at(t):
    return f"2026-07-02T{t}:00Z"


def test_stream_equals_batch_when_nothing_is_late(spark, scratch):
    batches = [[reading("A", "pm25", 100.0, "ug/m3", at("10:07")),
                reading("B", "o3", 0.09, "ppm", at("10:01"))],
               [reading("A", "pm25", 40.0, "ug/m3", at("10:58"))],
               [reading("A", "no2", 700.0, "ppb", at("12:30"))]]
    out = run_stream(spark, scratch, batches)
    got = speed.read_history(spark, out).select(*COLS)
    flat = [r for b in batches for r in b]
    want = windowed_aqi(prepare(readings_df(spark, flat))).select(*COLS)
    assert got.count() == want.count() == 46            # A: 12+10+12 windows, B: 12
    assert got.exceptAll(want).count() == 0


def test_late_reading_is_dropped_by_window(spark, scratch):
    batches = [[reading("A", "pm25", 100.0, "ug/m3", at("10:07"))],
               [reading("A", "pm25", 100.0, "ug/m3", at("12:30"))],
               [reading("A", "pm25", 100.0, "ug/m3", at("13:00"))],
               [reading("A", "pm25", 100.0, "ug/m3", at("09:10"))],
               [reading("A", "pm25", 100.0, "ug/m3", None)]]
    out = run_stream(spark, scratch, batches)
    hist = speed.read_history(spark, out)
    starts = {r.window_start.strftime("%H:%M"): r.reading_count for r in hist.collect()}
    assert min(starts) == "09:10"                     # nothing from the 09:10 reading alone
    assert starts["09:10"] == 1                       # the shared window did not take it
    assert len(starts) == 30                          # 12 + 12 + 6 new


def test_snapshot_modes(spark, scratch):
    batches = [[reading("A", "pm25", 100.0, "ug/m3", at("10:07"))],
               [reading("B", "pm25", 10.0, "ug/m3", at("10:09"))]]
    out = run_stream(spark, os.path.join(scratch, "batch"), batches)
    assert [r.city for r in speed.read_snapshot(spark, out).collect()] == ["B"]
    out = run_stream(spark, os.path.join(scratch, "merge"), batches, snapshot_mode="merge")
    snap = speed.read_snapshot(spark, out).collect()
    assert sorted(r.city for r in snap) == ["A", "B"]
    assert all(r.computed_at is not None for r in snap)


def test_merged_snapshot_takes_the_newest_emission(spark, scratch):
    batches = [[reading("A", "pm25", 10.0, "ug/m3", at("10:07")), reading("B", "pm25", 10.0, "ug/m3", at("10:07"))],
               [reading("A", "pm25", 100.0, "ug/m3", at("10:08"))]]       # same newest window again
    out = run_stream(spark, scratch, batches, snapshot_mode="merge")
    snap = {r.city: r for r in speed.read_snapshot(spark, out).collect()}
    assert sorted(snap) == ["A", "B"]
    assert snap["A"].reading_count == 2 and snap["A"].aqi > snap["B"].aqi


def test_another_checkpoint_over_the_same_history_is_refused(spark, scratch):
    out = run_stream(spark, scratch, [[reading("A", "pm25", 10.0, "ug/m3", at("10:07"))]])
    stream = speed.read_stream(spark, os.path.join(scratch, "raw"))
    q = speed.start(speed.windowed_stream(stream), out, os.path.join(scratch, "other"), available_now=True)
    with pytest.raises(Exception, match="another stream"):
        q.awaitTermination()


def test_stream_settings_stay_with_the_stream(spark, scratch):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"]
    before = [spark.conf.get(k) for k in keys]
    raw, out = os.path.join(scratch, "raw"), os.path.join(scratch, "out")
    land(raw, [[reading("A", "pm25", 10.0, "ug/m3", at("10:07"))]])
    q = speed.start(speed.windowed_stream(speed.read_stream(spark, raw)), out, os.path.join(scratch, "ckpt"),
                    available_now=True, rocksdb_state=True, state_partitions=3)
    q.awaitTermination()
    assert [spark.conf.get(k) for k in keys] == before
    assert len([d for d in os.listdir(os.path.join(scratch, "ckpt", "state", "0")) if d.isdigit()]) == 3


def test_replayed_batch_leaves_history_unchanged(spark, scratch):
    rows = [reading("A", "pm25", 100.0, "ug/m3", at("10:07"))]
    windows = windowed_aqi(prepare(readings_df(spark, rows)))
    write = speed.make_batch_writer(scratch)
    write(windows, 3)
    write(windows, 3)
    write(windows.limit(0), 4)                         # empty batch: nothing written
    hist = spark.read.parquet(os.path.join(scratch, "history"))
    assert hist.count() == 12
    assert {r.batch_id for r in hist.select("batch_id").distinct().collect()} == {3}


def test_stream_schema_is_declared(spark, scratch):
    raw = os.path.join(scratch, "raw")
    land(raw, [[reading("A", "pm25", 1.0, "ug/m3", at("10:00"))]])
    s = speed.read_stream(spark, raw)
    assert s.isStreaming and s.schema == READING
    assert F is not None


def test_restart_resumes_from_checkpoint(spark, scratch):
    raw = os.path.join(scratch, "raw")
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    land(raw, [[reading("A", "pm25", 100.0, "ug/m3", at("10:07"))]])

    def once():
        q = speed.start(speed.windowed_stream(speed.read_stream(spark, raw)), out, ckpt,
                        available_now=True)
        q.awaitTermination()
        assert q.exception() is None

    once()
    first = spark.read.parquet(os.path.join(out, "history")).select("batch_id").distinct().count()
    path = os.path.join(raw, "late-arrival.jsonl")
    with open(path, "w") as f:
        f.write(json.dumps(dict(zip(READING_COLUMNS, reading("A", "pm25", 10.0, "ug/m3", at("10:20"))))) + "\n")
    once()                                            # the old file is not read again
    hist = spark.read.parquet(os.path.join(out, "history"))
    assert hist.select("batch_id").distinct().count() > first
    newest = speed.read_history(spark, out)
    w = {r.window_start.strftime("%H:%M"): r.reading_count for r in newest.collect()}
    assert w["10:05"] == 2 and w["09:10"] == 1 and w["10:20"] == 1


def test_processing_time_trigger_and_bounded_run(spark, scratch):
    raw = os.path.join(scratch, "raw")
    land(raw, [[reading("A", "pm25", 100.0, "ug/m3", at("10:07"))]])
    q = speed.start(speed.windowed_stream(speed.read_stream(spark, raw)),
                    os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"), trigger_seconds=1)
    speed.run_for(q, 8)
    assert not q.isActive
    assert speed.read_history(spark, os.path.join(scratch, "out")).count() == 12


def test_keyed_records_parse_back_to_readings(spark):
    from airlens.sinks.files import keyed_records

    rows = [reading("A", "pm25", 100.0, "ug/m3", at("10:07")), reading("", "o3", 0.05, "ppm", at("10:08"))]
    df = readings_df(spark, rows)
    keyed = keyed_records(df)
    assert [r.key for r in keyed.collect()] == ["A", "1"]
    back = speed.parse_keyed_readings(keyed)
    assert back.schema == READING
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    junk = spark.createDataFrame([("k", "{oops")], "key string, value string")
    assert speed.parse_keyed_readings(junk).first().city is None


def test_rocksdb_state_store(spark, scratch):
    raw = os.path.join(scratch, "raw")
    land(raw, [[reading("A", "pm25", 100.0, "ug/m3", at("10:07"))]])
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    try:
        q = speed.start(speed.windowed_stream(speed.read_stream(spark, raw)), os.path.join(scratch, "out"),
                        os.path.join(scratch, "ckpt"), available_now=True, rocksdb_state=True)
        q.awaitTermination()
        assert q.exception() is None
    finally:
        spark.conf.set(key, before)
    assert speed.read_history(spark, os.path.join(scratch, "out")).count() == 12


def test_fixture_f7_late_data_follows_the_lagged_watermark(spark, scratch):
    """one file per trigger. Spark's late-row filter uses the watermark
    of one batch earlier than eviction does, so a late reading still feeds
    its youngest windows that end after that older watermark."""
    batches = [[reading("A", "pm25", 100.0, "ug/m3", at("10:07")),
                reading("A", "pm25", 50.0, "ug/m3", at("10:01"))],
               [reading("A", "pm25", 40.0, "ug/m3", at("10:58"))],
               [reading("A", "pm25", 30.0, "ug/m3", at("10:02")),       # late
                reading("A", "pm25", 20.0, "ug/m3", at("09:10"))],      # late
               [reading("A", "pm25", 10.0, "ug/m3", at("12:30"))],
               [reading("A", "pm25", 300.0, "ug/m3", at("10:40"))],     # late
               [reading("A", "pm25", 300.0, "ug/m3", None)]]
    out = run_stream(spark, scratch, batches)
    hist = spark.read.parquet(os.path.join(out, "history")).collect()
    by_batch = {}
    for r in hist:
        by_batch.setdefault(r.batch_id, {})[r.window_start.strftime("%H:%M")] = r.reading_count
    assert len(by_batch[0]) == 13 and len(by_batch[1]) == 12 and len(by_batch[3]) == 12
    # batch 2, lateness watermark 10:05: windows ending after it take both late readings
    late = by_batch[2]
    assert min(late) == "09:10" and late["09:10"] == 4 and len(late) == 11
    # batch 4, lateness watermark 10:56: only windows ending after 10:56 take 10:40
    assert sorted(by_batch[4]) == [f"10:{m:02d}" for m in range(0, 45, 5)]
    assert by_batch[4]["10:00"] == 5
    assert 5 not in by_batch                             # the NULL-time reading emits nothing
