"""Shape of the physical plans that matter at scale."""

import re

import pytest

from airlens.plans import catalog
from conftest import SF_SMALL


def final_plan(spark, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    df.collect()                                  # AQE final plan of this very plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["hourly_city_aqi", "windowed_aqi", "windowed_aqi_bucketed",
                                  "latest_windows_direct", "overall_aqi_city_day"])
def test_hash_aggregates_with_partial_step(spark, name):
    plan = final_plan(spark, name)
    assert "SortAggregate" not in plan
    assert "partial_max" in plan                  # map-side combine before the exchange
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_events_scan_reads_only_needed_columns(spark):
    plan = final_plan(spark, "hourly_city_aqi")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    events = [s for s in schemas if "event_id" in s]
    assert events and all(set(f.split(":")[0] for f in s.split(",")) == {"event_id", "ts", "user_id", "value"}
                          for s in events)


def test_only_fixed_size_tables_are_hinted_for_broadcast(spark):
    from airlens.operators.ingest import readings_from_latest
    from airlens.sources import testdata as td

    df = readings_from_latest(td.locations_from_events(spark, SF_SMALL), td.latest_from_events(spark, SF_SMALL))
    logical = df._jdf.queryExecution().analyzed().toString()
    # the 25-row nation/region dimension is the only broadcast hint
    assert logical.count("broadcast") <= 2


def test_latest_and_quota_ranks_use_partial_group_limit(spark):
    for name in ["latest_windows_direct", "select_stations"]:
        plan = final_plan(spark, name)
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_trailing_hour_aggregates_its_buckets_once(spark):
    plan = final_plan(spark, "trailing_hour_direct").split("Initial Plan")[0]
    assert "Window" not in plan and "Union" not in plan and "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 2             # buckets, then cities


@pytest.mark.parametrize("name", ["city_summary", "city_summary_incremental", "worst_cities_top10"])
def test_summaries_are_hash_aggregates(spark, name):
    assert "SortAggregate" not in final_plan(spark, name)


def test_the_band_join_broadcasts_nothing(spark):
    from airlens.operators.scoring import band_table, score_with_table
    from airlens.schemas import READING

    readings = spark.createDataFrame([(1, "S", "A", "IN", 1.0, 2.0, "pm25", 20.0, "ug/m3", None, None, None)], READING)
    df = score_with_table(readings, band_table(spark))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "NestedLoop" not in plan


def test_no_job_runs_while_stations_are_planned(spark):
    from airlens.operators.ingest import select_stations

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(1)
            yield b

    quotas = spark.createDataFrame([(1, "A", "A", 2)], "ord int, iso string, label string, quota int").mapInArrow(
        count, "ord int, iso string, label string, quota int")
    df = select_stations(spark.createDataFrame([(k, "A") for k in range(5)], "location_id long, iso string"), quotas)
    assert seen.value == 0
    assert sorted(r.location_id for r in df.collect()) == [0, 1] and seen.value > 0


def test_no_round_robin_exchange(spark):
    from airlens.plans import catalog

    for name in ("hourly_city_aqi", "score_readings", "serving_view", "readings_from_latest"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobin" not in plan, name


def test_truncate_has_no_cap(spark):
    from pyspark.sql import functions as F

    from airlens.functions.aqi import truncate

    df = spark.createDataFrame([(5e12,), (-7.25e15,), (1.29,), (-1.29,), (1e300,), (float("inf"),), (float("nan"),), (None,)],
                               "x double")
    got = [r[0] for r in df.select(truncate(F.col("x"), 1)).collect()]
    assert got == [5e12, -7.25e15, 1.2, -1.2, 1e300, None, None, None]
