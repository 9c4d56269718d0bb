"""Sliding windows, latest window per city, trailing hour."""

from pyspark.sql import functions as F

from airlens.operators.batch import prepare
from airlens.operators.windows import latest_windows, trailing_hour, windowed_aqi, windowed_aqi_bucketed
from airlens.sources.testdata import readings_from_events
from conftest import SF_SMALL
from fixtures import reading, readings_df


def test_twelve_windows_per_reading(spark):
    rows = [reading("A", "pm25", 40.0, "ug/m3", "2026-07-02T10:07:00Z")]
    w = windowed_aqi(prepare(readings_df(spark, rows))).collect()
    assert len(w) == 12
    starts = sorted(r.window_start.strftime("%H:%M") for r in w)
    assert starts[0] == "09:10" and starts[-1] == "10:05"
    assert all(r.reading_count == 1 for r in w)


def test_bucketed_equals_expanded(spark):
    p = prepare(readings_from_events(spark, SF_SMALL))
    cols = ["window_start", "window_end", "city", "country", "aqi", "dominant_pollutant",
            "reading_count", "dangerous", "latitude", "longitude"]
    a = windowed_aqi(p).select(*cols)
    b = windowed_aqi_bucketed(p).select(*cols)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_coordinates_come_from_smallest_station_with_both(spark):
    rows = [reading("A", "pm25", 40.0, "ug/m3", "2026-07-02T10:07:00Z", location_id=5, lat=1.0, lon=2.0),
            reading("A", "pm25", 40.0, "ug/m3", "2026-07-02T10:07:00Z", location_id=3, lat=None, lon=9.0),
            reading("A", "pm25", 40.0, "ug/m3", "2026-07-02T10:07:00Z", location_id=4, lat=7.0, lon=8.0)]
    w = windowed_aqi(prepare(readings_df(spark, rows))).collect()
    assert {(r.latitude, r.longitude) for r in w} == {(7.0, 8.0)}


def test_latest_window_is_the_newest_five_minute_mark(spark):
    rows = [reading("A", "pm25", 300.0, "ug/m3", "2026-07-02T10:07:00Z"),
            reading("A", "pm25", 20.0, "ug/m3", "2026-07-02T10:58:00Z"),
            reading(None, "pm25", 20.0, "ug/m3", "2026-07-02T10:58:00Z")]
    w = windowed_aqi(prepare(readings_df(spark, rows)))
    latest = latest_windows(w).collect()
    assert len(latest) == 1                                   # NULL city left out
    r = latest[0]
    assert (r.window_start.strftime("%H:%M"), r.window_end.strftime("%H:%M")) == ("10:55", "11:55")
    trail = trailing_hour(w, F.to_timestamp(F.lit("2026-07-02 11:00:00"))).collect()[0]
    assert trail.window_end.strftime("%H:%M") == "11:00"
    assert trail.reading_count == 2 and trail.aqi > r.aqi


def test_latest_uses_partial_group_limit(spark):
    p = prepare(readings_from_events(spark, SF_SMALL))
    plan = latest_windows(windowed_aqi_bucketed(p))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def _same(a, b):
    cols = ["window_start", "window_end", "city", "country", "aqi", "dominant_pollutant",
            "reading_count", "dangerous", "latitude", "longitude"]
    a, b = a.select(*cols), b.select(*cols)
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_direct_latest_equals_latest_of_all_windows(spark):
    from airlens.operators.windows import latest_windows_direct

    p = prepare(readings_from_events(spark, SF_SMALL))
    assert _same(latest_windows_direct(p), latest_windows(windowed_aqi(p)))


def test_direct_trailing_hour_equals_filtered_windows(spark):
    from airlens.operators.windows import trailing_hour_direct

    p = prepare(readings_from_events(spark, SF_SMALL))
    w = windowed_aqi(p)
    for as_of in ["2024-01-03 07:12:30", "2024-01-15 00:00:00", "2024-01-31 00:00:00",
                  "2023-12-31 00:00:00"]:
        t = F.to_timestamp(F.lit(as_of))
        assert _same(trailing_hour_direct(p, t), trailing_hour(w, t)), as_of
