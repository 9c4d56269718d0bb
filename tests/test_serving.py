"""Serving merge and its projections."""

import datetime as dt

from pyspark.sql import functions as F

from airlens.operators.serving import (
    dangerous_now,
    dashboard_table,
    map_points,
    merge_views,
    serving_counts,
)
from airlens.plans.serving import build_and_write_serving_view
from airlens.schemas import SERVING_COLUMNS, SNAPSHOT, SUMMARY

T0 = dt.datetime(2026, 7, 2, 10, 0)
T1 = dt.datetime(2026, 7, 2, 11, 0)


def snapshot(spark, rows):
    full = [(c, k, a, "pm25", 3, a >= 151, lat, lon, T0, T1, T1) for c, k, a, lat, lon in rows]
    return spark.createDataFrame(full, SNAPSHOT)


def summary(spark, rows):
    return spark.createDataFrame(
        [(c, k, 10, avg, mx, T0, "o3", 0.1) for c, k, avg, mx in rows], SUMMARY)


def test_merge_left_join_and_difference(spark):
    snap = snapshot(spark, [("A", "IN", 200.0, 1.0, 2.0), ("B", "GB", 20.0, None, None)])
    summ = summary(spark, [("A", "IN", 150.0, 300.0), ("Z", "US", 1.0, 1.0)])
    out = merge_views(summ, snap)
    assert out.columns == SERVING_COLUMNS
    rows = out.collect()
    assert [r.city for r in rows] == ["A", "B"]
    assert rows[0].vs_historical_avg == 50.0 and rows[0].historical_worst_pollutant == "o3"
    assert rows[1].historical_avg_aqi is None and rows[1].vs_historical_avg is None


def test_merge_with_empty_inputs(spark):
    empty_snap = spark.createDataFrame([], SNAPSHOT)
    out = merge_views(summary(spark, [("A", "IN", 1.0, 1.0)]), empty_snap)
    assert out.columns == SERVING_COLUMNS and out.count() == 0
    out2 = merge_views(spark.createDataFrame([], SUMMARY), snapshot(spark, [("A", "IN", 5.0, 1.0, 1.0)]))
    assert out2.count() == 1 and out2.first().historical_avg_aqi is None


def test_merge_keeps_only_history_columns_present(spark):
    summ = summary(spark, [("A", "IN", 150.0, 300.0)]).drop("worst_pollutant")
    out = merge_views(summ, snapshot(spark, [("A", "IN", 200.0, 1.0, 2.0)])).first()
    assert out.historical_worst_pollutant is None and out.historical_avg_aqi == 150.0


def test_dangerous_projection_map_and_counts(spark):
    snap = snapshot(spark, [("A", "IN", 200.0, 1.0, 2.0), ("B", "GB", 160.0, None, None),
                            ("C", "US", 20.0, 3.0, 4.0)])
    serving = merge_views(summary(spark, []), snap)
    d = dangerous_now(serving)
    assert [r.city for r in d.collect()] == ["A", "B"]
    assert dashboard_table(d).columns == ["city", "country", "aqi", "dominant_pollutant",
                                          "reading_count", "window_end", "historical_avg_aqi"]
    assert [(r.lat, r.lon) for r in map_points(d).collect()] == [(1.0, 2.0)]
    c = serving_counts(serving).first()
    assert (c.cities, c.dangerous_cities) == (3, 2)
    assert dangerous_now(serving.drop("dangerous")).count() == 3


def test_serving_job_without_views(spark, scratch):
    out = build_and_write_serving_view(spark, f"{scratch}/none-batch", f"{scratch}/none-speed",
                                       f"{scratch}/serving")
    assert out.count() == 0
    assert set(out.columns) == set(SERVING_COLUMNS)


def test_no_dangerous_city(spark):
    serving = merge_views(summary(spark, []), snapshot(spark, [("A", "IN", 20.0, 1.0, 2.0)]))
    assert dangerous_now(serving).count() == 0
    assert serving.filter(F.col("dangerous")).count() == 0
