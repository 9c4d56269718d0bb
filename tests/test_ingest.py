"""Station documents and latest entries -> readings; quotas; catalogue."""

import random

import pytest
from pyspark.sql import functions as F

from airlens.operators.ingest import parameters, readings_from_latest, select_stations, sensor_lookup
from airlens.schemas import LATEST, LOCATION, READING_COLUMNS
from airlens.sources.files import DEFAULT_MAX_LOCATIONS, DEFAULT_QUOTAS, country_quotas
from fixtures import LOCATION_DOC



def poll():
    return F.to_timestamp(F.lit("2026-07-02 10:30:00"))


def locations(spark, docs):
    return spark.createDataFrame(docs, LOCATION)


def latest(spark, rows):
    return spark.createDataFrame(
        [(loc, sid, v, None if t is False else {"utc": t}) for loc, sid, v, t in rows], LATEST)


def test_sensor_lookup(spark):
    got = {(r.sensor_id, r.pollutant, r.units) for r in sensor_lookup(locations(spark, [LOCATION_DOC])).collect()}
    assert got == {(71, "pm25", "µg/m³"), (72, "o3", "ppm")}


def test_readings_normalised_scored_and_dropped(spark):
    t = "2026-07-02T10:00:00Z"
    lat = latest(spark, [(4242, 71, 120.0, t), (4242, 72, 0.03, t), (4242, 99, 5.0, False), (4242, 71, None, t)])
    out = readings_from_latest(locations(spark, [LOCATION_DOC]), lat, polled_at=poll())
    assert out.columns == READING_COLUMNS
    rows = {r.pollutant: r for r in out.collect()}
    assert set(rows) == {"pm25", "o3"}
    pm = rows["pm25"]
    assert (pm.city, pm.country, pm.latitude, pm.datetime_utc) == ("Porto Vale", "PV", -12.5, t)
    assert pm.aqi_sub_index >= 151
    assert rows["o3"].aqi_sub_index < 51
    assert all(r.ingested_at == "2026-07-02T10:30:00.000000Z" for r in rows.values())


def test_station_without_entries_contributes_nothing(spark):
    docs = [dict(LOCATION_DOC, id=1), dict(LOCATION_DOC, id=2)]
    lat = latest(spark, [(1, 71, 10.0, "2026-07-02T10:00:00Z")])
    rows = readings_from_latest(locations(spark, docs), lat, polled_at=poll()).collect()
    assert [r.location_id for r in rows] == [1]


def test_missing_time_zero_value_and_document_gaps(spark):
    doc = dict(LOCATION_DOC, locality="", country=None, coordinates=None,
               sensors=[{"id": 1, "parameter": {"name": "PM25", "units": "µg/m³"}},
                        {"id": 1, "parameter": {"name": "pm10", "units": "µg/m³"}}])
    lat = latest(spark, [(4242, 1, 0.0, False)])
    r = readings_from_latest(locations(spark, [doc]), lat, polled_at=poll()).collect()
    assert len(r) == 1
    r = r[0]
    assert r.value == 0.0 and r.aqi_sub_index == 0.0
    assert r.pollutant == "pm10"                               # last duplicate id wins
    assert r.city == "Harbour Road 7" and r.country == ""
    assert r.latitude is None and r.datetime_utc == r.ingested_at


def test_parameter_catalogue(spark):
    got = {(r.pollutant, r.units) for r in parameters(locations(spark, [LOCATION_DOC, dict(LOCATION_DOC, id=9)])).collect()}
    assert got == {("pm25", "µg/m³"), ("o3", "ppm")}


def _loop_selection(stations, quotas, cap):
    """The discovery rule written as the plain loop it describes."""
    chosen = []
    for ord_, iso, _label, limit in sorted(quotas):
        if len(chosen) >= cap:
            break
        take = min(limit, cap - len(chosen))
        found = sorted(s for s, c in stations if c == iso)[:take]
        chosen += [(iso, s) for s in found]
    return sorted(chosen)


@pytest.mark.parametrize("seed", range(6))
def test_select_stations_matches_the_loop(spark, seed):
    rnd = random.Random(seed)
    isos = [q[1] for q in DEFAULT_QUOTAS]
    stations = [(i, rnd.choice(isos + ["XX"])) for i in range(rnd.randint(0, 300))]
    cap = rnd.choice([20, 60, DEFAULT_MAX_LOCATIONS])
    sdf = spark.createDataFrame(stations, "location_id long, iso string")
    got = select_stations(sdf, country_quotas(spark), max_locations=cap)
    assert sorted((r.iso, r.location_id) for r in got.collect()) == _loop_selection(stations, DEFAULT_QUOTAS, cap)


def test_default_quotas_sum_to_cap():
    assert sum(q[3] for q in DEFAULT_QUOTAS) == DEFAULT_MAX_LOCATIONS == 150


def test_empty_country_object_gives_an_empty_country(spark):
    docs = [dict(LOCATION_DOC, id=1, country={"code": None, "name": "x"}), dict(LOCATION_DOC, id=2, country=None)]
    lat = latest(spark, [(1, 71, 10.0, "2026-07-02T10:00:00Z"), (2, 71, 10.0, "2026-07-02T10:00:00Z")])
    rows = readings_from_latest(locations(spark, docs), lat, polled_at=poll()).collect()
    assert [r.country for r in rows] == ["", ""]


def test_missing_quota_is_the_default_limit(spark):
    stations = spark.createDataFrame([(k, "A") for k in range(40)] + [(100 + k, "B") for k in range(40)],
                                     "location_id int, iso string")
    quotas = spark.createDataFrame([(1, "A", "A", None), (2, "B", "B", 15)],
                                   "ord int, iso string, label string, quota int")
    got = select_stations(stations, quotas, max_locations=30).groupBy("iso").count().collect()
    assert {r["iso"]: r["count"] for r in got} == {"A": 10, "B": 15}


def landed_config(spark, scratch, doc):
    import json
    import os

    from airlens.sources.files import read_quotas

    os.makedirs(scratch, exist_ok=True)
    with open(os.path.join(scratch, "quotas.json"), "w") as f:
        json.dump(doc, f, indent=1)
    return read_quotas(spark, scratch)


def test_quotas_of_a_landed_config(spark, scratch):
    doc = {"max_locations": 25, "countries": [{"iso": "B", "label": "Bee", "limit": 15}, {"iso": "A", "label": "Ay"},
                                              {"iso": "C", "label": "Cee", "limit": 9}]}
    quotas, cap = landed_config(spark, scratch, doc)
    assert [tuple(r) for r in quotas.orderBy("ord").collect()] == [(1, "B", "Bee", 15), (2, "A", "Ay", 10), (3, "C", "Cee", 9)]
    stations = spark.createDataFrame([(k, "ABC"[k % 3]) for k in range(90)], "location_id long, iso string")
    got = select_stations(stations, quotas, max_locations=cap)
    assert sorted((r.iso, r.location_id) for r in got.collect()) == _loop_selection(
        [(r[0], r[1]) for r in stations.collect()], [(1, "B", "Bee", 15), (2, "A", "Ay", 10), (3, "C", "Cee", 9)], 25)


def test_a_config_without_a_cap_has_the_default_one(spark, scratch):
    quotas, cap = landed_config(spark, scratch, {"countries": [{"iso": "A", "label": "Ay", "limit": 400}]})
    stations = spark.createDataFrame([(k, "A") for k in range(200)], "location_id long, iso string")
    assert select_stations(stations, quotas, max_locations=cap).count() == DEFAULT_MAX_LOCATIONS


def test_ranks_go_on_over_spans_of_ids(spark, monkeypatch):
    from airlens.operators import ingest

    monkeypatch.setattr(ingest, "RANK_SPAN", 7)
    stations = [(k * 3, "A" if k % 4 else "B") for k in range(60)] + [(None, "A"), (-5, "A")]
    sdf = spark.createDataFrame(stations, "location_id long, iso string")
    quotas = [(1, "A", "A", 23), (2, "B", "B", 40)]
    got = select_stations(sdf, country_quotas(spark, quotas), max_locations=35).collect()
    a = sorted((r.station_rank, r.location_id) for r in got if r.iso == "A")
    assert [r for r, _ in a] == list(range(1, 24)) and a[0] == (1, None) and a[1] == (2, -5)
    assert [i for _, i in a[2:]] == sorted(i for i, c in stations if c == "A" and i is not None)[1:22]
    assert sum(r.iso == "B" for r in got) == 12
