"""Incremental batch layer: merging new files equals recomputing history."""

import os

import pytest
from pyspark.sql import functions as F

from airlens.operators.batch import HOURLY_COLUMNS, city_summary, hourly_aqi, prepare
from airlens.plans.batch import run_batch
from airlens.plans.incremental import (
    hourly_of_partials,
    hourly_partials,
    make_merge_writer,
    read_hourly_version,
    read_summary_version,
    run_batch_incremental,
)
from airlens.sources.files import read_readings
from fixtures import reading, readings_df
from test_streaming import land


def at(t):
    return f"2026-07-02T{t}:00Z"


BATCHES = [
    [reading("A", "pm25", 100.0, "ug/m3", at("10:07")), reading("B", "o3", 0.09, "ppm", at("10:01"))],
    [reading("A", "o3", 0.054, "ppm", at("10:30")), reading("A", "pm25", 9.0, "ug/m3", at("11:00"))],
    [reading("A", "pm25", 100.0, "ug/m3", at("10:50")), reading("C", "pm25", 5.0, "ug/m3", "garbage")],
    [reading("", "no2", 700.0, "ppb", at("12:30"), country=""),
     reading("B", "pm25", 9.0, "ug/m3", at("11:10")), reading("B", "o3", 0.054, "ppm", at("11:20"))],
]


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merge_equals_recompute_on_union(spark):
    flat = [r for b in BATCHES for r in b]
    whole = hourly_aqi(prepare(readings_df(spark, flat)))
    parts = None
    for b in BATCHES:
        part = hourly_partials(prepare(readings_df(spark, b)))
        parts = part if parts is None else parts.unionByName(part)
    merged = hourly_of_partials(parts)
    assert same(merged.select(*HOURLY_COLUMNS), whole.select(*HOURLY_COLUMNS))
    tie = [r for r in merged.collect() if r.city == "B" and r.hour and r.hour.hour == 11]
    assert tie[0].dominant_pollutant == "pm25"         # equal aqi on both sides: fixed order


def test_incremental_runs_equal_full_recompute(spark, scratch):
    raw, out, ckpt = (os.path.join(scratch, d) for d in ("raw", "out", "ckpt"))
    land(raw, BATCHES[:2])
    q = run_batch_incremental(spark, raw, out, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    land(os.path.join(raw, "later"), BATCHES[2:])      # a later cycle sees only the new files
    q = run_batch_incremental(spark, raw, out, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    full_hourly, full_summary = run_batch(spark, os.path.join(scratch, "full"), raw_path=raw)
    assert same(read_hourly_version(spark, out), full_hourly)
    assert same(read_summary_version(spark, out), full_summary)
    assert read_hourly_version(spark, out).filter(F.col("country") == "").count() == 1


def test_replayed_micro_batch_counts_once(spark, scratch):
    out = os.path.join(scratch, "out")
    write = make_merge_writer(out)
    first = readings_df(spark, BATCHES[0])
    second = readings_df(spark, BATCHES[1])
    write(first, 0)
    write(second, 1)
    write(second, 1)                                  # retry of the same micro-batch
    got = read_hourly_version(spark, out)
    want = hourly_aqi(prepare(readings_df(spark, BATCHES[0] + BATCHES[1])))
    assert same(got, want.select(*HOURLY_COLUMNS))
    assert same(read_summary_version(spark, out), city_summary(want))


def test_runs_are_merged_by_levels(spark, scratch):
    write = make_merge_writer(scratch, fan_in=2)
    for i in range(6):
        write(readings_df(spark, BATCHES[i % 4]), i)
    write(readings_df(spark, BATCHES[1]), 5)          # retry after merges
    names = os.listdir(os.path.join(scratch, "hourly", "stream=direct"))
    assert {"run=1-0-1", "run=1-2-3", "run=2-0-3"} <= set(names)
    want = hourly_aqi(prepare(readings_df(spark, [r for i in range(6) for r in BATCHES[i % 4]])))
    assert same(read_hourly_version(spark, scratch), want.select(*HOURLY_COLUMNS))


def test_stored_score_of_an_unknown_pollutant(spark):
    rows = [reading("A", "bc", 1.0, "ug/m3", at("10:01"), score=210.0),
            reading("A", "pm25", 1.0, "ug/m3", at("10:02"), score=20.0)]
    df = prepare(readings_df(spark, rows), rescore=False)
    got = hourly_of_partials(hourly_partials(df, other_pollutants=True)).first()
    assert (got.dominant_pollutant, got.aqi, got.reading_count) == ("bc", 210.0, 2)


def test_another_checkpoint_over_the_same_output_is_refused(spark, scratch):
    raw, out = os.path.join(scratch, "raw"), os.path.join(scratch, "out")
    land(raw, BATCHES[:1])
    run_batch_incremental(spark, raw, out, os.path.join(scratch, "c1")).awaitTermination()
    before = read_hourly_version(spark, out).collect()
    with pytest.raises(Exception, match="another stream"):
        run_batch_incremental(spark, raw, out, os.path.join(scratch, "c2")).awaitTermination()
    assert read_hourly_version(spark, out).collect() == before


def test_daily_partials_are_made_for_changed_days_only(spark, scratch):
    def on(day):
        return f"2026-07-{day:02d}T10:07:00Z"

    write = make_merge_writer(scratch, fan_in=3)
    cycles = [[reading("A", "pm25", 10.0, "ug/m3", on(1)), reading("A", "pm25", 90.0, "ug/m3", on(2))],
              [reading("A", "pm25", 70.0, "ug/m3", on(2)), reading("B", "o3", 0.09, "ppm", on(2)), reading("B", "pm25", 1.0, "ug/m3", "never")],
              [reading("A", "pm25", 90.0, "ug/m3", on(3))], [reading("A", "pm25", 95.0, "ug/m3", on(1)), reading("B", "pm25", 2.0, "ug/m3", None)]]
    for i, rows in enumerate(cycles):
        write(readings_df(spark, rows), i)
    write(readings_df(spark, cycles[3]), 3)           # replayed
    folder = os.path.join(scratch, "daily", "stream=direct")
    days = {n: {d for d in os.listdir(os.path.join(folder, n)) if d.startswith("day=")} for n in os.listdir(folder)}
    assert days["run=0-2-2"] == {"day=2026-07-03"}
    assert days["run=1-0-2"] == {"day=2026-07-01", "day=2026-07-02", "day=2026-07-03", "day=__HIVE_DEFAULT_PARTITION__"}
    want = city_summary(hourly_aqi(prepare(readings_df(spark, [r for c in cycles for r in c]))))
    assert same(read_summary_version(spark, scratch), want)


def test_summary_of_days_equals_the_sorted_form(spark):
    rows = [reading(c, p, v, u, f"2026-07-0{d}T{h:02d}:00:00Z", country=k) for c, k in (("A", "X"), ("A", "Y"), ("", ""), (None, "Z"))
            for d in (1, 2, 3) for h, p, v, u in ((3, "pm25", 9.0, "ug/m3"), (5, "o3", 0.054, "ppm"), (7, "pm25", 5.0 + d, "ug/m3"))]
    rows += [reading("A", "pm25", 9.0, "ug/m3", "?", country="X"), reading("N", "o3", 0.06, "ppm", None)]
    hourly = hourly_aqi(prepare(readings_df(spark, rows)))
    assert same(city_summary(hourly), city_summary(hourly, other_pollutants=True))
    got = {(r.city, r.country): r for r in city_summary(hourly).collect()}
    assert got[("A", "X")].max_aqi_at.isoformat() == "2026-07-01T03:00:00" and got[("A", "X")].worst_pollutant == "pm25"
    assert got[("N", "IN")].max_aqi_at is None and got[("N", "IN")].worst_pollutant == "o3"


def test_stored_scores_keep_other_names_in_the_summary(spark, scratch):
    rows = [reading("A", "bc", 1.0, "ug/m3", at("10:01"), score=210.0)]
    write = make_merge_writer(scratch, rescore=False)
    write(readings_df(spark, rows), 0)
    assert read_summary_version(spark, scratch, other_pollutants=True).first().worst_pollutant == "bc"
