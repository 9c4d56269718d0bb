"""Chained final windows, keyed latest windows, settled history, batch metrics."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from airlens.operators.batch import prepare
from airlens.operators.scoring import score
from airlens.operators.windows import final_windows, latest_windows, windowed_aqi
from airlens.schemas import WINDOW_COLUMNS
from airlens.streaming import latest, speed
from airlens.streaming.metrics import BatchMetrics, read_metrics
from fixtures import reading, readings_df
from test_streaming import land


def at(t, day="2026-07-02"):
    return f"{day}T{t}:00Z"


def pm(city, value, t, **k):
    return reading(city, "pm25", value, "ug/m3", t, **k)


def done(q):
    q.awaitTermination()
    assert q.exception() is None
    return q


def same(a, b):
    a, b = a.select(*WINDOW_COLUMNS), b.select(*WINDOW_COLUMNS)
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


BATCHES = [
    [pm("A", 100.0, at("10:07")), reading("B", "o3", 0.09, "ppm", at("10:01")), pm("A", 30.0, at("10:09"))],
    [pm("A", 40.0, at("10:58")), reading("A", "mystery", 1.0, "x", at("10:59"))],
    [reading("A", "no2", 700.0, "ppb", at("12:30")), pm("C", 5.0, None)],
    [pm("B", 9.0, at("14:00"))],
]


# --- final windows --------------------------------------------------------------

def run_final(spark, root, batches, per_trigger=1):
    raw, out = os.path.join(root, "raw"), os.path.join(root, "out")
    land(raw, batches)
    stream = speed.read_stream(spark, raw, max_files_per_trigger=per_trigger)
    q = speed.start_final(final_windows(prepare(stream)), out, os.path.join(root, "ckpt"), available_now=True)
    return out, done(q)


def ended(spark, batches):
    """The batch windows behind the watermark of scored readings."""
    flat = readings_df(spark, [r for b in batches for r in b])
    p = prepare(flat).where("aqi_sub_index is not null")
    mark = p.agg(F.max("event_time")).first()[0] - datetime.timedelta(minutes=2)
    return windowed_aqi(prepare(flat)).where(F.col("window_end") <= F.lit(mark))


def test_final_windows_equal_batch_windows_behind_the_watermark(spark, scratch):
    out, _ = run_final(spark, scratch, BATCHES)
    got = speed.read_final(spark, out)
    assert same(got, ended(spark, BATCHES))
    assert got.count() > 20


def test_each_final_window_is_given_once_over_restarts(spark, scratch):
    raw, out = os.path.join(scratch, "raw"), os.path.join(scratch, "out")
    for i in range(len(BATCHES)):
        land(os.path.join(raw, f"cycle{i}"), BATCHES[i:i + 1])
        done(speed.start_final(final_windows(prepare(speed.read_stream(spark, raw))), out, os.path.join(scratch, "ckpt"),
                               available_now=True))
    got = speed.read_final(spark, out)
    assert got.groupBy("window_start", "city", "country").count().where("count > 1").count() == 0
    assert same(got, ended(spark, BATCHES))


def test_state_holds_buckets_not_readings(spark, scratch):
    """60 readings in one bucket: the first step keeps one row for them, where the
    expanded form updates 12 rows with 60 readings each."""
    rows = [pm("A", 10.0 + i, f"2026-07-02T10:0{i % 5}:{i % 60:02d}Z") for i in range(60)]
    out, q = run_final(spark, scratch, [rows, [pm("A", 1.0, at("20:00"))]])
    updated = [sum(o["numRowsUpdated"] for o in p["stateOperators"]) for p in map(json.loads, (p.json for p in q.recentProgress))]
    assert updated[0] == 1                                # the bucket; its windows follow once it has ended
    assert sum(updated) == 1 + 1 + 12
    assert {r.reading_count for r in speed.read_final(spark, out).collect()} == {60}


def test_a_reading_after_its_bucket_has_ended_is_left_out(spark, scratch):
    batches = [[pm("A", 100.0, at("10:07"))], [pm("A", 50.0, at("13:00"))], [pm("A", 50.0, at("13:10"))], [pm("A", 300.0, at("10:08"))],
               [pm("A", 50.0, at("16:00"))]]
    out, _ = run_final(spark, scratch, batches)
    first = {r.window_start.strftime("%H:%M"): r.reading_count for r in speed.read_final(spark, out).collect()}
    assert first["10:05"] == 1 and first["09:10"] == 1


def test_a_day_of_final_windows_reads_its_folder(spark, scratch):
    batches = [[pm("A", 100.0, at("10:07"))], [pm("A", 10.0, at("10:07", "2026-07-03"))], [pm("A", 10.0, at("10:07", "2026-07-05"))]]
    out, _ = run_final(spark, scratch, batches)
    one = speed.read_final(spark, out, datetime.date(2026, 7, 2))
    assert one.count() == 12 and speed.read_final(spark, out).count() == 24
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_other_pollutants_of_final_windows(spark, scratch):
    raw, out = os.path.join(scratch, "raw"), os.path.join(scratch, "out")
    rows = [reading("A", n, 1.0, "x", at(t), score=90.0) for n, t in (("radon", "10:01"), ("bc", "10:02"))]
    land(raw, [rows, [reading("A", "pm25", 1.0, "ug/m3", at("20:00"), score=1.0)]])
    final = final_windows(prepare(speed.read_stream(spark, raw), rescore=False), other_pollutants=True)
    done(speed.start_final(final, out, os.path.join(scratch, "ckpt"), available_now=True))
    assert {r.dominant_pollutant for r in speed.read_final(spark, out).collect()} == {"bc"}     # a tie: the smaller name


# --- the latest window per city ---------------------------------------------------

def run_latest(spark, root, batches, ttl_ms=latest.TTL_MS, fan_in=8):
    raw, out = os.path.join(root, "raw"), os.path.join(root, "out")
    land(raw, batches)
    stream = latest.latest_stream(score(speed.read_stream(spark, raw, max_files_per_trigger=1)), ttl_ms)
    return out, done(latest.start_latest(stream, out, os.path.join(root, "ckpt"), available_now=True, state_partitions=2))


def batch_latest(spark, batches):
    return latest_windows(windowed_aqi(prepare(readings_df(spark, [r for b in batches for r in b]))))


LATEST = [
    [pm("A", 100.0, at("10:07")), pm("B", 9.0, at("10:01")), reading("A", "o3", 0.09, "ppm", at("10:08"), location_id=7),
     reading("", "no2", 60.0, "ppb", at("10:00"), country="")],
    [pm("A", 140.0, at("10:09")), pm("A", 300.0, at("10:03")), pm(None, 5.0, at("10:04"))],       # same mark; an older one
    [pm("C", 5.0, at("11:00")), reading("C", "mystery", 5.0, "x", at("11:30")), pm("D", 5.0, None)],
    [pm("B", 50.0, at("10:02")), pm("B", 20.0, at("10:30"))],
]


def test_latest_state_equals_batch(spark, scratch):
    out, _ = run_latest(spark, scratch, LATEST)
    got = latest.read_latest_windows(spark, out)
    assert same(got, batch_latest(spark, LATEST))
    assert sorted(r.city for r in got.collect()) == ["", "A", "B", "C"]            # quiet cities stay


def test_a_trigger_touches_its_cities_only(spark, scratch):
    out, _ = run_latest(spark, scratch, LATEST)
    folder = os.path.join(out, "latest")
    rows = spark.read.parquet(os.path.join(folder, os.listdir(folder)[0]))
    touched = {}
    for r in rows.select("batch_id", "city").collect():
        touched.setdefault(r.batch_id, set()).add(r.city)
    assert touched == {0: {"", "A", "B"}, 1: {"A"}, 2: {"C"}, 3: {"B"}}


def test_a_restart_keeps_the_state(spark, scratch):
    for i in range(len(LATEST)):
        raw = os.path.join(scratch, "raw")
        land(os.path.join(raw, f"c{i}"), LATEST[i:i + 1])
        stream = latest.latest_stream(score(speed.read_stream(spark, raw)))
        done(latest.start_latest(stream, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"), available_now=True))
    assert same(latest.read_latest_windows(spark, os.path.join(scratch, "out")), batch_latest(spark, LATEST))


def test_runs_of_cities_are_merged(spark, scratch):
    write = latest.make_latest_writer(scratch, fan_in=2)
    fields = {f: None for f in latest.FIELDS} | {"b_count": 1, "b_aqi": 3.0}
    for i in range(5):
        row = fields | {"bucket": i * 300_000_000, "city": f"C{i % 2}", "country": "X"}
        df = spark.createDataFrame([tuple(row[c] for c in ["city", "country", *latest.FIELDS])], latest.OUTPUT)
        write(df, i)
        write(df, i)                                    # replayed
    names = os.listdir(os.path.join(scratch, "latest", "stream=direct"))
    assert "run=2-0-3" in names
    got = {r.city: r.window_start.minute for r in latest.read_latest_windows(spark, scratch).collect()}
    assert got == {"C0": 20, "C1": 15}


def test_another_stream_over_the_latest_windows_is_refused(spark, scratch):
    out, _ = run_latest(spark, scratch, LATEST[:1])
    stream = latest.latest_stream(score(speed.read_stream(spark, os.path.join(scratch, "raw"))))
    q = latest.start_latest(stream, out, os.path.join(scratch, "other"), available_now=True)
    with pytest.raises(Exception, match="another stream"):
        q.awaitTermination()


def test_no_latest_windows_yet(spark, scratch):
    assert latest.read_latest_windows(spark, scratch).count() == 0


# --- settled history --------------------------------------------------------------

DAYS = [
    [pm("A", 100.0, at("22:50")), pm("B", 9.0, at("23:30"))],
    [pm("A", 40.0, at("22:57")), pm("A", 80.0, at("23:59"))],          # windows of the first batch again
    [pm("A", 20.0, at("00:20", "2026-07-03"))],
    [pm("B", 20.0, at("10:00", "2026-07-03"))],
    [pm("A", 30.0, at("12:00", "2026-07-04")), pm("A", 5.0, at("09:30", "2026-07-03"))],
    [pm("A", 30.0, at("12:10", "2026-07-04"))],
    [pm("A", 30.0, at("12:20", "2026-07-04"))],
    [pm("A", 30.0, at("12:30", "2026-07-04"))],
]


def run_settled(spark, root, batches):
    raw, out = os.path.join(root, "raw"), os.path.join(root, "out")
    land(raw, batches)
    stream = speed.windowed_stream(speed.read_stream(spark, raw, max_files_per_trigger=1))
    done(speed.start(stream, out, os.path.join(root, "ckpt"), available_now=True, settle_after="2 minutes"))
    return out


def test_settled_history_equals_the_ranked_one(spark, scratch):
    out = run_settled(spark, scratch, DAYS)
    raw = os.path.join(scratch, "raw")
    stream = speed.windowed_stream(speed.read_stream(spark, raw, max_files_per_trigger=1))
    plain = os.path.join(scratch, "plain")
    done(speed.start(stream, plain, os.path.join(scratch, "ckpt2"), available_now=True))
    assert same(speed.read_history(spark, out), speed.read_history(spark, plain))
    from airlens.sources.manifest import current
    d = current(spark, out).details
    assert d["settled_until"] == int(datetime.datetime(2026, 7, 4, tzinfo=datetime.timezone.utc).timestamp()) * 1_000_000
    assert {b["batch_id"] for b in d["open"]} <= {4, 5, 6, 7}
    left = {n for n in os.listdir(os.path.join(out, "history", "stream=" + d["stream"])) if n.startswith("batch_id=")}
    assert "batch_id=0" not in left                     # its windows have moved


def test_a_settled_day_is_read_alone(spark, scratch):
    out = run_settled(spark, scratch, DAYS)
    whole = speed.read_history(spark, out)
    for day in (datetime.date(2026, 7, 2), datetime.date(2026, 7, 3), datetime.date(2026, 7, 4)):
        mine = F.to_date(F.col("window_end") - F.expr("INTERVAL 1 MICROSECOND")) == F.lit(day)
        assert same(speed.read_history(spark, out, day=day), whole.where(mine))
    plan = speed.read_history(spark, out, day=datetime.date(2026, 7, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_late_emission_after_the_day_is_over_is_kept(spark, scratch):
    """Batch 4 brings a reading of the day before, whose windows end behind the newest
    watermark but not behind the one that drops late rows."""
    out = run_settled(spark, scratch, DAYS)
    got = {(r.city, r.window_start.isoformat()): r.reading_count for r in speed.read_history(spark, out).collect()}
    assert got[("A", "2026-07-03T09:00:00")] == 1


# --- metrics ----------------------------------------------------------------------

def test_metrics_count_late_groups(spark, scratch):
    raw, out = os.path.join(scratch, "raw"), os.path.join(scratch, "out")
    metrics = BatchMetrics(os.path.join(scratch, "metrics"), every=2)
    for i, rows in enumerate([[pm("A", 100.0, at("10:07")), pm("B", 300.0, at("13:00"))],
                              [pm("A", 100.0, at("10:07")), pm("A", 50.0, at("12:10"))], [pm("C", None, at("10:07"))]]):
        land(os.path.join(raw, f"c{i}"), [rows])
        q = speed.start(speed.windowed_stream(speed.read_stream(spark, raw)), out, os.path.join(scratch, "ckpt"),
                        available_now=True, metrics=metrics)
        done(q)
        metrics.wait()
    got = [r for r in read_metrics(spark, os.path.join(scratch, "metrics")).orderBy("batch_id").collect() if r.input_rows]
    # Watermark 12:58: all 12 windows of 10:07 have ended, and 9 of those of 12:10.
    assert [(r.input_rows, r.dropped_rows) for r in got] == [(2, 0), (2, 21), (1, 0)]
    assert [(r.windows, r.cities, r.dangerous_cities) for r in got] == [(24, 2, 2), (3, 1, 0), (None, None, None)]
    assert got[1].watermark is not None and dict(read_metrics(spark, os.path.join(scratch, "metrics")).dtypes)["dropped_rows"] == "bigint"
