"""Hourly view, city summary, top-k, view writes (batch layer)."""

import json
import os

from pyspark.sql import functions as F

from airlens.operators.batch import city_summary, hourly_aqi, prepare, worst_cities
from airlens.plans.batch import run_batch
from airlens.sources.manifest import current
from airlens.sources.files import read_readings
from fixtures import reading, readings_df


def hourly_rows(spark, rows):
    return {(r.city, r.country, r.hour and r.hour.strftime("%H:%M")): r
            for r in hourly_aqi(prepare(readings_df(spark, rows))).collect()}


def test_hourly_worst_pollutant_and_count(spark):
    rows = [
        reading("Delhi", "pm25", 120.0, "ug/m3", "2026-07-02T10:05:00Z"),
        reading("Delhi", "o3", 0.03, "ppm", "2026-07-02T10:10:00Z"),
        reading("Delhi", "bc", 3.0, "ug/m3", "2026-07-02T10:15:00Z"),     # unscorable: ignored
        reading("Delhi", "no2", 20.0, "ppb", "2026-07-02T11:00:00Z"),
    ]
    h = hourly_rows(spark, rows)
    r10 = h[("Delhi", "IN", "10:00")]
    assert r10.dominant_pollutant == "pm25" and r10.reading_count == 2 and r10.dangerous
    assert h[("Delhi", "IN", "11:00")].dominant_pollutant == "no2"
    assert len(h) == 2


def test_hourly_tie_takes_fixed_order(spark):
    rows = [reading("A", "o3", 0.054, "ppm", "2026-07-02T10:05:00Z"),
            reading("A", "pm25", 9.0, "ug/m3", "2026-07-02T10:06:00Z")]
    assert hourly_rows(spark, rows)[("A", "IN", "10:00")].dominant_pollutant == "pm25"


def test_garbage_time_forms_null_hour_group_and_offsets_parse(spark):
    rows = [reading("A", "pm25", 20.0, "ug/m3", "garbage"),
            reading("A", "pm25", 30.0, "ug/m3", "2026-07-02T15:30:00+05:30")]
    h = hourly_rows(spark, rows)
    assert ("A", "IN", None) in h
    assert ("A", "IN", "10:00") in h                    # 15:30 +05:30 is 10:00 UTC


def test_summary_earliest_hour_at_max_and_fraction(spark):
    rows = [reading("A", "pm25", 300.0, "ug/m3", "2026-07-02T12:00:00Z"),
            reading("A", "pm25", 300.0, "ug/m3", "2026-07-02T09:00:00Z"),
            reading("A", "pm25", 5.0, "ug/m3", "2026-07-02T10:00:00Z"),
            reading("A", "pm25", 5.0, "ug/m3", "garbage")]
    s = city_summary(hourly_aqi(prepare(readings_df(spark, rows)))).collect()
    assert len(s) == 1
    r = s[0]
    assert r.hours_observed == 4                        # the NULL hour counts
    assert r.max_aqi_at.strftime("%H:%M") == "09:00"
    assert r.worst_pollutant == "pm25"
    assert r.pct_hours_dangerous == 0.5


def test_summary_order_and_top_k(spark):
    rows = [reading(c, "pm25", v, "ug/m3", "2026-07-02T10:00:00Z")
            for c, v in [("A", 10.0), ("B", 300.0), ("C", 300.0), ("D", 50.0)]]
    s = city_summary(hourly_aqi(prepare(readings_df(spark, rows))))
    assert [r.city for r in s.collect()] == ["B", "C", "D", "A"]
    assert [r.city for r in worst_cities(s, 2).collect()] == ["B", "C"]


def test_permissive_json_scan(spark, scratch):
    raw = os.path.join(scratch, "raw", "sub")
    os.makedirs(raw)
    good = dict(zip(["location_id", "location_name", "city", "country", "latitude", "longitude",
                     "pollutant", "value", "unit", "datetime_utc", "ingested_at", "aqi_sub_index"],
                    reading("A", "pm25", 20.0, "ug/m3", "2026-07-02T10:00:00Z")))
    bad_field = dict(good, location_id="oops")
    with open(os.path.join(raw, "part.jsonl"), "w") as f:
        f.write(json.dumps(good) + "\n{not json\n" + json.dumps(bad_field) + "\n")
    rows = read_readings(spark, os.path.join(scratch, "raw")).collect()
    assert len(rows) == 3
    assert sum(r.city == "A" for r in rows) == 2
    assert any(r.city == "A" and r.location_id is None for r in rows)


def test_run_batch_roundtrip_keeps_empty_country(spark, scratch):
    rows = [reading("A", "pm25", 20.0, "ug/m3", "2026-07-02T10:00:00Z", country=""),
            reading("B", "pm25", 80.0, "ug/m3", "2026-07-02T10:00:00Z", country="IN")]
    hourly, summary = run_batch(spark, scratch, readings=readings_df(spark, rows))
    assert sorted((r.city, r.country) for r in hourly.collect()) == [("A", ""), ("B", "IN")]
    assert sorted((r.city, r.country) for r in summary.collect()) == [("A", ""), ("B", "IN")]
    assert os.path.isdir(os.path.join(current(spark, scratch).path("hourly_city_aqi"), "country=IN"))


def test_trusted_scores_are_kept(spark):
    rows = [reading("A", "radon", 1.0, "x", "2026-07-02T10:00:00Z", score=None),
            reading("A", "pm25", 1.0, "ug/m3", "2026-07-02T10:00:00Z", score=77.0)]
    p = prepare(readings_df(spark, rows), rescore=False)
    assert p.agg(F.max("aqi_sub_index")).first()[0] == 77.0


def test_trusted_score_of_other_pollutant_can_dominate(spark):
    rows = [reading("A", "radon", 1.0, "x", "2026-07-02T10:00:00Z", score=90.0),
            reading("A", "pm25", 1.0, "ug/m3", "2026-07-02T10:10:00Z", score=40.0),
            reading("B", "radon", 1.0, "x", "2026-07-02T10:00:00Z", score=40.0),
            reading("B", "o3", 1.0, "ppm", "2026-07-02T10:10:00Z", score=40.0)]
    p = prepare(readings_df(spark, rows), rescore=False)
    got = {r.city: r.dominant_pollutant for r in hourly_aqi(p, other_pollutants=True).collect()}
    assert got == {"A": "radon", "B": "o3"}                 # a known pollutant wins a tie
    plain = {r.city: r.dominant_pollutant for r in hourly_aqi(p).collect()}
    assert plain == {"A": None, "B": "o3"}


def test_country_filter_prunes_view_partitions(spark, scratch):
    from airlens.sources.files import read_hourly_view

    rows = [reading("A", "pm25", 20.0, "ug/m3", "2026-07-02T10:00:00Z", country=""),
            reading("B", "pm25", 80.0, "ug/m3", "2026-07-02T10:00:00Z", country="IN")]
    run_batch(spark, scratch, readings=readings_df(spark, rows))
    view = read_hourly_view(spark, scratch)
    for value, city in [("IN", "B"), ("", "A")]:
        df = view.filter(F.col("country") == value)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "country" in plan.split("PartitionFilters: [", 1)[1][:200]
        assert [r.city for r in df.collect()] == [city]


def test_hot_city_results_match_a_plain_computation(spark):
    """One city with most of the rows: the same answers as pandas on the
    collected input (small fixture, brute force)."""
    import pandas as pd

    from airlens.sources.testdata import readings_from_events
    from conftest import SF_SMALL

    r = readings_from_events(spark, SF_SMALL)
    is_hot = F.col("location_id") % 3 != 0
    hot = (r.withColumn("city", F.when(is_hot, F.lit("HOT")).otherwise(F.col("city")))
           .withColumn("country", F.when(is_hot, F.lit("HOTLAND")).otherwise(F.col("country"))))
    got = {(x.city, x.country, x.hour): (x.aqi, x.reading_count)
           for x in hourly_aqi(prepare(hot)).collect()}
    pdf = (prepare(hot).select("city", "country", "hour", "aqi_sub_index").toPandas()
           .dropna(subset=["aqi_sub_index"]))
    want = pdf.groupby(["city", "country", "hour"], dropna=False)["aqi_sub_index"].agg(["max", "count"])
    assert len(got) == len(want)
    for (city, country, hour), row in want.iterrows():
        key = (city, country, pd.Timestamp(hour).to_pydatetime())
        assert got[key] == (row["max"], row["count"])
    assert sum(c for (city, _, _), (_, c) in got.items() if city == "HOT") > 0.6 * sum(c for _, c in got.values())


def test_numeric_looking_country_stays_text(spark, scratch):
    rows = [reading("A", "pm25", 20.0, "ug/m3", "2026-07-02T10:00:00Z", country="001")]
    hourly, summary = run_batch(spark, scratch, readings=readings_df(spark, rows))
    assert [r.country for r in hourly.collect()] == ["001"]
    assert dict(hourly.dtypes)["country"] == "string"


def test_hourly_from_buckets_equals_hourly(spark):
    from airlens.operators.batch import hourly_from_buckets
    from airlens.operators.windows import bucket_aggregates
    from airlens.sources.testdata import readings_from_events
    from conftest import SF_SMALL

    extra = readings_df(spark, [reading("A", "pm25", 20.0, "ug/m3", "garbage"),
                                reading("A", "pm25", 30.0, "ug/m3", "2026-07-02T10:59:59.999999Z")])
    base = readings_from_events(spark, SF_SMALL).drop("event_time").unionByName(extra)
    p = prepare(base)
    a = hourly_aqi(p)
    b = hourly_from_buckets(bucket_aggregates(p, keep_null_time=True))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert b.filter(F.col("hour").isNull()).count() == 1
