"""Registered queries over the driver tables, and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame computed over
the whole tables. Output conventions shared with the oracle SQL: every
timestamp is returned as TIMESTAMP_NTZ on the UTC clock, and averages
(whose last bits depend on summation order) are rounded to 6 places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airlens.functions import aqi
from airlens.operators import batch as B
from airlens.operators import ingest as I
from airlens.operators import scoring as S
from airlens.operators import serving as V
from airlens.operators import windows as W
from airlens.plans import oracle as O
from airlens.plans.batch import run_batch
from airlens.plans.incremental import read_hourly_version, read_summary_version, run_batch_incremental
from airlens.plans.serving import build_and_write_serving_view
from airlens.schemas import READING, READING_COLUMNS, SERVING_COLUMNS, SNAPSHOT_COLUMNS, WINDOW_COLUMNS
from airlens.session import ensure_utc, scratch_dir
from airlens.sinks.files import keyed_records, write_readings
from airlens.sources import testdata as td
from airlens.sources.files import (
    DEFAULT_COUNTRY_LIMIT,
    load_batch_views,
    quarantine_readings,
    read_latest,
    read_locations,
    read_quarantine,
    read_quotas,
    read_readings,
)
from airlens.sources.testdata import readings_from_events
from airlens.streaming import latest as LS
from airlens.streaming import speed as SP
from airlens.streaming.metrics import BatchMetrics, read_metrics

Query = Callable[[SparkSession, str], DataFrame]

READING_OUT = ["location_id", "city", "country", "pollutant", "value", "unit",
               "datetime_utc", "aqi_sub_index"]
SUMMARY_OUT = B.SUMMARY_COLUMNS


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def round6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


# --- building blocks ------------------------------------------------------

def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return B.prepare(readings_from_events(spark, sf))


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    return B.hourly_aqi(prepared(spark, sf))


def summary(spark: SparkSession, sf: str, ordered: bool = True) -> DataFrame:
    return B.city_summary(hourly(spark, sf), ordered=ordered)


def windowed(spark: SparkSession, sf: str, bucketed: bool = False) -> DataFrame:
    p = prepared(spark, sf)
    return W.windowed_aqi_bucketed(p) if bucketed else W.windowed_aqi(p)


def newest_reading_time(spark: SparkSession, sf: str):
    """Scalar subquery: time of the newest reading (reads only ``ts``)."""
    return readings_from_events(spark, sf).select(F.max("event_time")).scalar()


def serving(spark: SparkSession, sf: str, both_sides: bool = False) -> DataFrame:
    """History and latest windows, both from 5-minute bucket aggregates of
    the same readings (the hourly view merged from buckets, the snapshot
    from each city's newest bucket); no window is expanded. With ``both_sides``
    read, the buckets are written once, so scoring and aggregation run once;
    the two sides need different bucket columns, which Catalyst would compute
    apart. A query that reads only the snapshot side prunes the other."""
    buckets = W.bucket_aggregates(prepared(spark, sf), keep_null_time=True)
    if both_sides:
        path = scratch_dir(spark, "buckets")
        buckets.write.parquet(path)
        buckets = spark.read.schema(buckets.schema).parquet(path)
    history = B.city_summary(B.hourly_from_buckets(buckets), ordered=False)
    latest = W.latest_windows_from_buckets(buckets, ordered=False)
    snap = V.snapshot_from_latest(latest, computed_at=newest_reading_time(spark, sf))
    return V.merge_views(history, snap)


def _summary_out(df: DataFrame) -> DataFrame:
    return ntz(round6(df, "avg_aqi"), "max_aqi_at").select(*SUMMARY_OUT)


def _serving_out(df: DataFrame) -> DataFrame:
    df = round6(df, "historical_avg_aqi", "vs_historical_avg")
    return ntz(df, "window_start", "window_end", "computed_at").select(*SERVING_COLUMNS)


# --- queries ----------------------------------------------------------------

def q_score_readings(spark, sf):
    return S.score(readings_from_events(spark, sf)).select(*READING_OUT)


def q_score_with_table(spark, sf):
    return S.score_with_table(readings_from_events(spark, sf)).select(*READING_OUT)


def q_hourly_city_aqi(spark, sf):
    return ntz(hourly(spark, sf), "hour").select(*B.HOURLY_COLUMNS)


def q_hourly_from_buckets(spark, sf):
    buckets = W.bucket_aggregates(prepared(spark, sf), keep_null_time=True)
    return ntz(B.hourly_from_buckets(buckets), "hour").select(*B.HOURLY_COLUMNS)


def q_city_summary(spark, sf):
    return _summary_out(summary(spark, sf))


def q_worst_cities_top10(spark, sf):
    return _summary_out(B.worst_cities(summary(spark, sf, ordered=False), 10))


def q_worst_cities_top15(spark, sf):
    return _summary_out(B.worst_cities(summary(spark, sf, ordered=False), 15))


def q_category_counts(spark, sf):
    h = hourly(spark, sf)
    cat = aqi.category(aqi.round_half_even("aqi"))
    return h.groupBy(cat.alias("category")).agg(F.count(F.lit(1)).alias("city_hours"))


def q_overall_aqi_city_day(spark, sf):
    p = prepared(spark, sf).withColumn("day", F.date_trunc("day", F.col("event_time")))
    out = S.overall_aqi(p, ["city", "country", "day"])
    parts = {f"sub_{n}": F.col("sub_indices")[n] for n in aqi.POLLUTANTS}
    return ntz(out.withColumns(parts).drop("sub_indices"), "day")


def q_windowed_aqi(spark, sf):
    return ntz(windowed(spark, sf), "window_start", "window_end").select(*WINDOW_COLUMNS)


def q_windowed_aqi_bucketed(spark, sf):
    return ntz(windowed(spark, sf, bucketed=True), "window_start", "window_end").select(*WINDOW_COLUMNS)


def q_latest_windows(spark, sf):
    out = W.latest_windows(windowed(spark, sf, bucketed=True))
    return ntz(out, "window_start", "window_end").select(*WINDOW_COLUMNS)


def q_trailing_hour(spark, sf):
    out = W.trailing_hour(windowed(spark, sf, bucketed=True), newest_reading_time(spark, sf))
    return ntz(out, "window_start", "window_end").select(*WINDOW_COLUMNS)


def q_latest_windows_direct(spark, sf):
    out = W.latest_windows_direct(prepared(spark, sf))
    return ntz(out, "window_start", "window_end").select(*WINDOW_COLUMNS)


def q_trailing_hour_direct(spark, sf):
    out = W.trailing_hour_direct(prepared(spark, sf), newest_reading_time(spark, sf))
    return ntz(out, "window_start", "window_end").select(*WINDOW_COLUMNS)


def q_serving_view(spark, sf):
    return _serving_out(serving(spark, sf, both_sides=True))


def q_dangerous_now(spark, sf):
    out = V.dashboard_table(V.dangerous_now(serving(spark, sf, both_sides=True)))
    return ntz(round6(out, "historical_avg_aqi"), "window_end")


def q_console_dangerous(spark, sf):
    return V.console_rows(V.dangerous_now(serving(spark, sf)))


def q_map_points(spark, sf):
    return V.map_points(V.dangerous_now(serving(spark, sf)))


def q_serving_counts(spark, sf):
    return V.serving_counts(serving(spark, sf))


def q_dangerous_reading_count(spark, sf):
    return B.dangerous_reading_counts(S.score(readings_from_events(spark, sf)))


def _ingested(spark, sf):
    polled = td.table(spark, sf, "events").select(F.max(F.col("ts").cast("timestamp"))).scalar()
    return I.readings_from_latest(td.locations_from_events(spark, sf),
                                  td.latest_from_events(spark, sf), polled_at=polled)


def q_readings_from_latest(spark, sf):
    return _ingested(spark, sf)


def q_sensor_lookup(spark, sf):
    return I.sensor_lookup(td.locations_from_events(spark, sf))


def q_parameter_catalog(spark, sf):
    return I.parameters(td.locations_from_events(spark, sf))


def q_select_stations(spark, sf):
    docs = td.locations_from_events(spark, sf)
    stations = docs.select(F.col("id").alias("location_id"), F.col("country.code").alias("iso"))
    return I.select_stations(stations, td.region_quotas(spark, sf), max_locations=td.REGION_CAP)


def q_keyed_records(spark, sf):
    """The records are written as JSON and read back from their values."""
    back = keyed_records(_ingested(spark, sf)).select("key", F.from_json("value", READING).alias("r"))
    return back.select("key", *[F.col(f"r.{c}").alias(c) for c in READING_COLUMNS])


def q_view_roundtrip(spark, sf):
    out = scratch_dir(spark, "batch-views")
    hourly_back, _summary = run_batch(spark, out, readings=readings_from_events(spark, sf))
    return ntz(hourly_back, "hour").select(*B.HOURLY_COLUMNS)


def _run_speed(spark, sf, raw_json: str | None = None) -> str:
    """Run the speed layer once over everything available (availableNow)
    and return its output folder: over the events file itself (a
    stream-static join with nation/region), or over landed raw JSON
    readings. State lives under the shared checkpoint folder."""
    ensure_utc(spark)
    out = scratch_dir(spark, "speed")
    if raw_json is None:
        schema = td.table(spark, sf, "events").schema
        # A one-file glob: the file source needs a directory or a pattern.
        stream = spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/[e]vents.parquet")
        readings = readings_from_events(spark, sf, events=stream)
    else:
        readings = SP.read_stream(spark, raw_json)
    windowed = SP.windowed_stream(readings)
    _finished(SP.start(windowed, out, f"{out}/_checkpoint", available_now=True))
    return out


def q_windowed_aqi_stream(spark, sf):
    hist = SP.read_history(spark, _run_speed(spark, sf))
    return ntz(hist, "window_start", "window_end").select(*WINDOW_COLUMNS)


def q_windowed_aqi_stream_restarted(spark, sf):
    """The stream stops after the first half of the time span and resumes from
    its checkpoint: windows open at the stop are emitted again, and no file
    counts twice."""
    ensure_utc(spark)
    raw, out = scratch_dir(spark, "raw"), scratch_dir(spark, "speed")
    for half in _halves(spark, sf):
        write_readings(half, "local", directory=raw)
        windowed_ = SP.windowed_stream(SP.read_stream(spark, raw))
        _finished(SP.start(windowed_, out, f"{out}/_checkpoint", available_now=True))
    return ntz(SP.read_history(spark, out), "window_start", "window_end").select(*WINDOW_COLUMNS)


def q_snapshot_roundtrip(spark, sf):
    snap = SP.read_snapshot(spark, _run_speed(spark, sf))
    cols = [c for c in SNAPSHOT_COLUMNS if c != "computed_at"]
    return ntz(snap, "window_start", "window_end").select(*cols)


def _landed_readings(spark, sf) -> str:
    """Write the adapter's readings as raw JSON lines (the ingest sink) and
    return the folder; later steps read them like the reference's raw data."""
    raw = scratch_dir(spark, "raw")
    write_readings(readings_from_events(spark, sf).select(*READING_COLUMNS), "local", directory=raw)
    return raw


def q_readings_json_roundtrip(spark, sf):
    raw = _landed_readings(spark, sf)
    return S.score(read_readings(spark, raw)).select(*READING_OUT)


def q_batch_job_from_json(spark, sf):
    raw = _landed_readings(spark, sf)
    _hourly, summary_back = run_batch(spark, scratch_dir(spark, "batch-views"), raw_path=raw)
    return _summary_out(summary_back)


def _halves(spark, sf) -> list[DataFrame]:
    """The readings up to the middle of their time span, and all others."""
    us = F.unix_micros("event_time")
    r = readings_from_events(spark, sf)
    middle = r.select(F.timestamp_micros(F.floor((F.min(us) + F.max(us)) / 2))).scalar()
    early = F.coalesce(F.col("event_time") < middle, F.lit(False))
    return [r.where(early).select(*READING_COLUMNS), r.where(~early).select(*READING_COLUMNS)]


def _finished(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def q_batch_incremental(spark, sf):
    """The hourly view built in two cycles, each over newly landed files only
    (the second resumes the first one's checkpoint)."""
    raw, out = scratch_dir(spark, "raw"), scratch_dir(spark, "incremental")
    for half in _halves(spark, sf):
        write_readings(half, "local", directory=raw)
        _finished(run_batch_incremental(spark, raw, out, f"{out}/_checkpoint"))
    return ntz(read_hourly_version(spark, out), "hour").select(*B.HOURLY_COLUMNS)


def q_batch_job_stored_scores(spark, sf):
    """Scored readings are landed; the batch job trusts their stored scores."""
    raw = scratch_dir(spark, "raw")
    write_readings(S.score(readings_from_events(spark, sf)).select(*READING_COLUMNS), "local", directory=raw)
    _hourly, summary_back = run_batch(spark, scratch_dir(spark, "batch-views"), raw_path=raw, rescore=False)
    return _summary_out(summary_back)


def q_serving_job(spark, sf):
    """Batch views and the speed snapshot go through files; the serving job
    merges what it loads. ``computed_at`` is the wall clock of the stream."""
    views = scratch_dir(spark, "batch-views")
    raw = _landed_readings(spark, sf)
    run_batch(spark, views, raw_path=raw)
    speed_out = _run_speed(spark, sf, raw_json=raw)
    served = build_and_write_serving_view(spark, views, speed_out, scratch_dir(spark, "serving"))
    cols = [c for c in SERVING_COLUMNS if c != "computed_at"]
    return ntz(round6(served, "historical_avg_aqi", "vs_historical_avg"),
               "window_start", "window_end").select(*cols)


def q_ingest_from_json(spark, sf):
    """Station documents and latest entries landed as JSON, read back with
    their declared schemas, turned into readings."""
    docs, entries = scratch_dir(spark, "locations"), scratch_dir(spark, "latest")
    td.locations_from_events(spark, sf).write.mode("overwrite").json(docs)
    td.latest_from_events(spark, sf).write.mode("overwrite").json(entries)
    polled = td.table(spark, sf, "events").select(F.max(F.col("ts").cast("timestamp"))).scalar()
    return I.readings_from_latest(read_locations(spark, docs), read_latest(spark, entries),
                                  polled_at=polled)


def q_score_with_bands(spark, sf):
    """The breakpoint table as a caller's band table: a binned interval join."""
    return S.score_with_table(readings_from_events(spark, sf), S.band_table(spark)).select(*READING_OUT)


def q_final_windows_stream(spark, sf):
    """Ended windows, each once, from a stream that stops and resumes halfway."""
    ensure_utc(spark)
    raw, out = scratch_dir(spark, "raw"), scratch_dir(spark, "final")
    for half in _halves(spark, sf):
        write_readings(half, "local", directory=raw)
        final = W.final_windows(B.prepare(SP.read_stream(spark, raw)))
        _finished(SP.start_final(final, out, f"{out}/_checkpoint", available_now=True))
    return ntz(SP.read_final(spark, out), "window_start", "window_end").select(*WINDOW_COLUMNS)


def q_latest_state_stream(spark, sf):
    """The latest window of every city as keyed state (RocksDB): the first half of the
    readings at once, the second by a processing-time trigger, a file each time, in a
    run of bounded length."""
    ensure_utc(spark)
    raw, out = scratch_dir(spark, "raw"), scratch_dir(spark, "latest")
    first, second = _halves(spark, sf)
    write_readings(first, "local", directory=raw)
    _finished(LS.start_latest(LS.latest_stream(S.score(SP.read_stream(spark, raw))), out, f"{out}/_checkpoint", available_now=True))
    write_readings(second, "local", directory=raw)
    latest = LS.latest_stream(S.score(SP.read_stream(spark, raw, max_files_per_trigger=1)))
    q = LS.start_latest(latest, out, f"{out}/_checkpoint", trigger_seconds=1)
    q.processAllAvailable()
    SP.run_for(q, 1)
    return ntz(LS.read_latest_windows(spark, out), "window_start", "window_end").select(*WINDOW_COLUMNS)


def _thirds(spark, sf) -> list[DataFrame]:
    """The readings by thirds of their time span (without a time: the last)."""
    us = F.unix_micros("event_time")
    r = readings_from_events(spark, sf)
    cut = [r.select(F.timestamp_micros(F.floor((F.min(us) * (3 - k) + F.max(us) * k) / 3))).scalar() for k in (1, 2)]
    part = F.when(F.col("event_time") < cut[0], 0).when(F.col("event_time") < cut[1], 1).otherwise(2)
    return [r.where(part == k).select(*READING_COLUMNS) for k in range(3)]


def q_settled_history_stream(spark, sf):
    """The windows of a stream over three runs (RocksDB state); days behind the
    watermark have moved to the final table, the others are ranked."""
    ensure_utc(spark)
    raw, out = scratch_dir(spark, "raw"), scratch_dir(spark, "speed")
    for third in _thirds(spark, sf):
        write_readings(third, "local", directory=raw)
        windowed_ = SP.windowed_stream(SP.read_stream(spark, raw))
        _finished(SP.start(windowed_, out, f"{out}/_checkpoint", available_now=True, settle_after=W.WATERMARK, rocksdb_state=True))
    return ntz(SP.read_history(spark, out), "window_start", "window_end").select(*WINDOW_COLUMNS)


def q_stream_late_rows(spark, sf):
    """Per run of a stream, what came in and what the watermark dropped: the first
    third of the time span arrives after the second, and again after the last."""
    ensure_utc(spark)
    first, second, last = _thirds(spark, sf)
    raw, out = scratch_dir(spark, "raw"), scratch_dir(spark, "speed")
    metrics = BatchMetrics(f"{out}/metrics")
    for part in (second, first, last, first):
        write_readings(part, "local", directory=raw)
        windowed_ = SP.windowed_stream(SP.read_stream(spark, raw))
        _finished(SP.start(windowed_, out, f"{out}/_checkpoint", available_now=True, metrics=metrics))
        metrics.wait()
    rows = read_metrics(spark, f"{out}/metrics").where("input_rows > 0")
    return rows.select(F.row_number().over(Window.orderBy("batch_id")).alias("run"), "input_rows", "dropped_rows",
                       F.coalesce("windows", F.lit(0).cast("long")).alias("windows"),
                       F.coalesce("cities", F.lit(0).cast("long")).alias("cities"),
                       F.coalesce("dangerous_cities", F.lit(0).cast("long")).alias("dangerous_cities"))


def q_batch_views_committed(spark, sf):
    """Two runs of the batch job over the same folder; hourly view and summary are
    those of one commit."""
    out = scratch_dir(spark, "batch-views")
    first, _ = _halves(spark, sf)
    run_batch(spark, out, readings=first)
    run_batch(spark, out, readings=readings_from_events(spark, sf))
    hourly_back, summary_back = load_batch_views(spark, out)
    hours = hourly_back.groupBy("city", "country").agg(F.count(F.lit(1)).alias("hours_in_view"), F.max("aqi").alias("max_in_view"))
    both = summary_back.join(hours, ["city", "country"])
    return ntz(round6(both, "avg_aqi"), "max_aqi_at").select(*SUMMARY_OUT, "hours_in_view", "max_in_view")


def q_city_summary_incremental(spark, sf):
    """The summary merged from the daily partials of three incremental runs."""
    raw, out = scratch_dir(spark, "raw"), scratch_dir(spark, "incremental")
    for third in _thirds(spark, sf):
        write_readings(third, "local", directory=raw)
        _finished(run_batch_incremental(spark, raw, out, f"{out}/_checkpoint"))
    return _summary_out(read_summary_version(spark, out))


def q_quarantined_lines(spark, sf):
    """Raw files with broken lines among the readings: the lines put aside, and the
    readings per city that are left."""
    raw, aside = _landed_readings(spark, sf), scratch_dir(spark, "quarantine")
    bad = td.table(spark, sf, "events").where("event_id % 97 = 0")
    bad.select(F.concat(F.lit('{"city": "broken '), F.col("event_id").cast("string"))).write.text(f"{raw}/broken")
    good, counts = quarantine_readings(spark, raw, aside)
    lines = read_quarantine(spark, aside).select(F.lit("line").alias("kind"), F.col("line").alias("what"), F.lit(1).cast("long").alias("n"))
    cities = good.groupBy("city").agg(F.count(F.lit(1)).alias("n")).select(F.lit("city").alias("kind"), F.col("city").alias("what"), "n")
    total = spark.createDataFrame([("count", k, n) for k, n in counts.items()], "kind string, what string, n long")
    return lines.unionByName(cities).unionByName(total)


def q_select_stations_from_config(spark, sf):
    """Quotas and cap come from a landed config document; a country without a limit
    gets the default one."""
    config = scratch_dir(spark, "config")
    limit = F.when(F.col("ord") != td.REGION_WITHOUT_LIMIT, F.col("quota"))
    listed = F.sort_array(F.collect_list(F.struct("ord", "iso", "label", limit.alias("limit"))))
    td.region_quotas(spark, sf).agg(listed.alias("l")).select(
        F.lit(td.REGION_CAP).alias("max_locations"),
        F.transform("l", lambda c: F.struct(c["iso"].alias("iso"), c["label"].alias("label"), c["limit"].alias("limit"))).alias("countries")
    ).write.json(config)
    docs = td.locations_from_events(spark, sf)
    stations = docs.select(F.col("id").alias("location_id"), F.col("country.code").alias("iso"))
    quotas, cap = read_quotas(spark, config)
    return I.select_stations(stations, quotas, max_locations=cap)


def q_readings_polled(spark, sf):
    """Entries without a time of their own get the time of the poll, here the newest
    event's, as an injected clock."""
    undated = F.when(F.col("sensorsId") % td.UNDATED_EVERY != 0, F.col("datetime"))
    polled = td.table(spark, sf, "events").select(F.max(F.col("ts").cast("timestamp"))).scalar()
    return I.readings_from_latest(td.locations_from_events(spark, sf),
                                  td.latest_from_events(spark, sf).withColumn("datetime", undated), polled_at=polled)


QUERIES: dict[str, Query] = {
    "score_readings": q_score_readings,
    "score_with_table": q_score_with_table,
    "hourly_city_aqi": q_hourly_city_aqi,
    "hourly_from_buckets": q_hourly_from_buckets,
    "city_summary": q_city_summary,
    "worst_cities_top10": q_worst_cities_top10,
    "worst_cities_top15": q_worst_cities_top15,
    "category_counts": q_category_counts,
    "overall_aqi_city_day": q_overall_aqi_city_day,
    "windowed_aqi": q_windowed_aqi,
    "windowed_aqi_bucketed": q_windowed_aqi_bucketed,
    "latest_windows": q_latest_windows,
    "trailing_hour": q_trailing_hour,
    "latest_windows_direct": q_latest_windows_direct,
    "trailing_hour_direct": q_trailing_hour_direct,
    "serving_view": q_serving_view,
    "dangerous_now": q_dangerous_now,
    "map_points": q_map_points,
    "console_dangerous": q_console_dangerous,
    "serving_counts": q_serving_counts,
    "dangerous_reading_count": q_dangerous_reading_count,
    "readings_from_latest": q_readings_from_latest,
    "sensor_lookup": q_sensor_lookup,
    "parameter_catalog": q_parameter_catalog,
    "select_stations": q_select_stations,
    "keyed_records": q_keyed_records,
    "view_roundtrip": q_view_roundtrip,
    "windowed_aqi_stream": q_windowed_aqi_stream,
    "snapshot_roundtrip": q_snapshot_roundtrip,
    "readings_json_roundtrip": q_readings_json_roundtrip,
    "batch_job_from_json": q_batch_job_from_json,
    "batch_incremental": q_batch_incremental,
    "batch_job_stored_scores": q_batch_job_stored_scores,
    "windowed_aqi_stream_restarted": q_windowed_aqi_stream_restarted,
    "serving_job": q_serving_job,
    "ingest_from_json": q_ingest_from_json,
    "score_with_bands": q_score_with_bands,
    "final_windows_stream": q_final_windows_stream,
    "latest_state_stream": q_latest_state_stream,
    "settled_history_stream": q_settled_history_stream,
    "stream_late_rows": q_stream_late_rows,
    "batch_views_committed": q_batch_views_committed,
    "city_summary_incremental": q_city_summary_incremental,
    "quarantined_lines": q_quarantined_lines,
    "select_stations_from_config": q_select_stations_from_config,
    "readings_polled": q_readings_polled,
}


# --- oracle SQL -------------------------------------------------------------

_READING_SQL = ", ".join(READING_OUT)
_SUMMARY_SQL = ("city, country, hours_observed, round(avg_aqi, 6) AS avg_aqi, max_aqi, "
                "max_aqi_at, worst_pollutant, pct_hours_dangerous")
_WINDOW_SQL = ", ".join(WINDOW_COLUMNS)
_LATEST = ("SELECT * FROM windowed WHERE city IS NOT NULL AND country IS NOT NULL "
           "QUALIFY row_number() OVER (PARTITION BY city, country ORDER BY window_end DESC) = 1")


def _serving_ctes() -> str:
    # summary and windows share the scored CTEs; build them once.
    win = O.windowed_ctes()
    summ = O.summary_ctes()
    extra = summ[len(O.scored_ctes()):]
    return win + extra + f""",
    latest AS ({_LATEST}),
    snapshot AS (SELECT city, country, aqi, dominant_pollutant, reading_count, dangerous,
                        latitude, longitude, window_start, window_end,
                        (SELECT max(event_time) FROM readings) AS computed_at FROM latest),
    serving AS (
      SELECT s.*, h.avg_aqi AS historical_avg_aqi, h.max_aqi AS historical_max_aqi,
             h.worst_pollutant AS historical_worst_pollutant, h.pct_hours_dangerous,
             s.aqi - h.avg_aqi AS vs_historical_avg
      FROM snapshot s LEFT JOIN summary h ON s.city = h.city AND s.country = h.country)
    """


_SERVING_SQL = (
    "city, country, aqi, dominant_pollutant, reading_count, dangerous, latitude, longitude, "
    "window_start, window_end, computed_at, round(historical_avg_aqi, 6) AS historical_avg_aqi, "
    "historical_max_aqi, historical_worst_pollutant, pct_hours_dangerous, "
    "round(vs_historical_avg, 6) AS vs_historical_avg")


def _sensor_values() -> str:
    rows = [f"({k}, {O.s(p)}, {O.s(td.SENSOR_UNITS[p])})"
            for k, p in enumerate(td.POLLUTANT_CYCLE) if p in td.SENSOR_UNITS]
    return ", ".join(rows)


def _late_rows_sql() -> str:
    """A micro-batch drops the (window, city) groups that ended by the watermark
    of all batches before it. Windows shown are those of the rows that are left."""
    return f"""
    WITH {O.scored_ctes()},
    span AS (SELECT epoch_us(min(event_time)) AS lo, epoch_us(max(event_time)) AS hi FROM readings),
    parted AS (SELECT s.*, CASE WHEN epoch_us(event_time) < floor((lo * 2 + hi) / 3) THEN 0
                                WHEN epoch_us(event_time) < floor((lo + hi * 2) / 3) THEN 1 ELSE 2 END AS part FROM scored s, span),
    runs AS (SELECT * FROM (VALUES (1, 1), (2, 0), (3, 2), (4, 0)) r(run, part)),
    mark AS (SELECT run, max(max(event_time)) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 MINUTE AS mark
             FROM runs JOIN parted USING (part) WHERE aqi_sub_index IS NOT NULL GROUP BY run),
    came AS (SELECT run, CAST(count(*) AS BIGINT) AS input_rows FROM runs JOIN parted USING (part) GROUP BY run),
    grouped AS (SELECT run, city, country, make_timestamp((epoch_us(event_time) // 300000000 - k) * 300000000) AS ws, max(aqi_sub_index) AS aqi
                FROM runs JOIN parted USING (part), range(12) t(k) WHERE aqi_sub_index IS NOT NULL GROUP BY ALL),
    judged AS (SELECT grouped.*, coalesce(ws + INTERVAL 60 MINUTE <= mark, false) AS late FROM grouped JOIN mark USING (run)),
    -- A window shows all of its readings so far, so the worst of this and earlier runs.
    shown AS (SELECT j.run, j.city, j.country, j.ws, max(e.aqi) AS aqi FROM judged j
              JOIN judged e ON e.ws = j.ws AND e.city = j.city AND e.country = j.country AND e.run <= j.run AND NOT e.late
              WHERE NOT j.late GROUP BY ALL),
    newest AS (SELECT * FROM shown QUALIFY row_number() OVER (PARTITION BY run, city, country ORDER BY ws DESC) = 1),
    tracked AS (SELECT run, count(*) AS cities, count(*) FILTER (WHERE aqi >= {aqi.DANGEROUS_AQI}) AS dangerous_cities FROM newest GROUP BY run)
    SELECT CAST(run AS INTEGER) AS run, input_rows,
           CAST(coalesce((SELECT count(*) FROM judged j WHERE j.run = came.run AND late), 0) AS BIGINT) AS dropped_rows,
           CAST(coalesce((SELECT count(*) FROM shown s WHERE s.run = came.run), 0) AS BIGINT) AS windows,
           CAST(coalesce(cities, 0) AS BIGINT) AS cities, CAST(coalesce(dangerous_cities, 0) AS BIGINT) AS dangerous_cities
    FROM came LEFT JOIN tracked USING (run)"""


def _select_stations_sql(without_limit: int | None = None) -> str:
    quotas = " ".join(f"WHEN {i} THEN {DEFAULT_COUNTRY_LIMIT if i == without_limit else q}" for i, q in enumerate(td.REGION_QUOTAS))
    cap = td.REGION_CAP
    return f"""
    WITH st AS (
      SELECT DISTINCT e.user_id AS location_id, r.r_name AS iso
      FROM events e JOIN nation n ON e.user_id % {td.NATIONS} = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey),
    q AS (SELECT r_regionkey AS ord, r_name AS iso, r_name AS label,
                 CASE r_regionkey {quotas} END AS quota FROM region),
    found AS (SELECT iso, count(*) AS found FROM st GROUP BY iso),
    a AS (SELECT q.*, least(q.quota, coalesce(found.found, 0)) AS a
          FROM q LEFT JOIN found ON q.iso = found.iso),
    cum AS (SELECT *, sum(a) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c
            FROM a),
    takes AS (SELECT ord, iso, label, least({cap}, c) - least({cap}, c - a) AS taken FROM cum),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY iso ORDER BY location_id) AS station_rank
               FROM st)
    SELECT {'t.ord' if without_limit is None else 'CAST(t.ord + 1 AS INTEGER) AS ord'}, t.iso, t.label, r.location_id, CAST(r.station_rank AS INTEGER) AS station_rank
    FROM ranked r JOIN takes t ON r.iso = t.iso WHERE r.station_rank <= t.taken
    """


def oracle_sql() -> dict[str, str]:
    top = "ORDER BY max_aqi DESC, city ASC NULLS FIRST, country ASC NULLS FIRST"
    serving = _serving_ctes()
    return {
        "score_readings": f"WITH {O.scored_ctes()} SELECT {_READING_SQL} FROM scored",
        "score_with_table": f"WITH {O.scored_ctes()} SELECT {_READING_SQL} FROM scored",
        "hourly_city_aqi": f"WITH {O.hourly_ctes()} SELECT {', '.join(B.HOURLY_COLUMNS)} FROM hourly",
        "hourly_from_buckets": f"WITH {O.hourly_ctes()} SELECT {', '.join(B.HOURLY_COLUMNS)} FROM hourly",
        "city_summary": f"WITH {O.summary_ctes()} SELECT {_SUMMARY_SQL} FROM summary",
        "worst_cities_top10": f"WITH {O.summary_ctes()} SELECT {_SUMMARY_SQL} FROM summary {top} LIMIT 10",
        "worst_cities_top15": f"WITH {O.summary_ctes()} SELECT {_SUMMARY_SQL} FROM summary {top} LIMIT 15",
        "category_counts": (
            f"WITH {O.hourly_ctes()} SELECT {O.category_sql('round_even(aqi, 0)')} AS category, "
            "CAST(count(*) AS BIGINT) AS city_hours FROM hourly GROUP BY 1"),
        "overall_aqi_city_day": (
            f"WITH {O.scored_ctes()}, d AS ("
            f"  SELECT city, country, date_trunc('day', event_time) AS day, "
            f"         max(aqi_sub_index) AS worst, {O.pollutant_max_sql()} "
            f"  FROM prepared GROUP BY city, country, day) "
            f"SELECT city, country, day, round_even(worst, 0) AS aqi, "
            f"       {O.category_sql('round_even(worst, 0)')} AS category, "
            f"       {O.dominant_sql('worst')} AS dominant_pollutant, "
            f"       round_even(worst, 0) >= {aqi.DANGEROUS_AQI} AS dangerous, "
            + ", ".join(f"m_{n} AS sub_{n}" for n in aqi.POLLUTANTS) + " FROM d"),
        "windowed_aqi": f"WITH {O.windowed_ctes()} SELECT {_WINDOW_SQL} FROM windowed",
        "windowed_aqi_bucketed": f"WITH {O.windowed_ctes()} SELECT {_WINDOW_SQL} FROM windowed",
        "latest_windows": f"WITH {O.windowed_ctes()}, latest AS ({_LATEST}) SELECT {_WINDOW_SQL} FROM latest",
        "trailing_hour": (
            f"WITH {O.windowed_ctes()}, ended AS (SELECT * FROM windowed "
            f"WHERE window_end <= (SELECT max(event_time) FROM readings)), "
            f"latest AS ({_LATEST.replace('FROM windowed', 'FROM ended')}) "
            f"SELECT {_WINDOW_SQL} FROM latest"),
        "latest_windows_direct": (
            f"WITH {O.windowed_ctes()}, latest AS ({_LATEST}) SELECT {_WINDOW_SQL} FROM latest"),
        "trailing_hour_direct": (
            f"WITH {O.windowed_ctes()}, ended AS (SELECT * FROM windowed "
            f"WHERE window_end <= (SELECT max(event_time) FROM readings)), "
            f"latest AS ({_LATEST.replace('FROM windowed', 'FROM ended')}) "
            f"SELECT {_WINDOW_SQL} FROM latest"),
        "serving_view": f"WITH {serving} SELECT {_SERVING_SQL} FROM serving",
        "dangerous_now": (
            f"WITH {serving} SELECT city, country, aqi, dominant_pollutant, reading_count, "
            f"window_end, round(historical_avg_aqi, 6) AS historical_avg_aqi FROM serving WHERE dangerous"),
        "map_points": (
            f"WITH {serving} SELECT latitude AS lat, longitude AS lon FROM serving "
            f"WHERE dangerous AND latitude IS NOT NULL AND longitude IS NOT NULL"),
        "console_dangerous": f"WITH {serving} SELECT city, country, aqi, dominant_pollutant FROM serving WHERE dangerous",
        "serving_counts": (
            f"WITH {serving} SELECT CAST(count(*) AS BIGINT) AS cities, "
            f"CAST(count(*) FILTER (WHERE dangerous) AS BIGINT) AS dangerous_cities FROM serving"),
        "dangerous_reading_count": (
            f"WITH {O.scored_ctes()}, s AS MATERIALIZED (SELECT aqi_sub_index FROM scored) SELECT "
            f"CAST(count(*) FILTER (WHERE coalesce(aqi_sub_index, 0) >= {aqi.DANGEROUS_AQI}) AS BIGINT) "
            f"AS dangerous_readings, CAST(count(*) AS BIGINT) AS readings FROM s"),
        "readings_from_latest": (
            f"WITH {O.scored_ctes(ingest=True)} SELECT {', '.join(READING_COLUMNS)} FROM scored"),
        "sensor_lookup": (
            f"SELECT CAST(u.user_id AS INTEGER) AS location_id, u.user_id * {td.SENSOR_STRIDE} + p.k AS sensor_id, "
            f"p.pollutant, p.units FROM (SELECT DISTINCT user_id FROM events) u, "
            f"(VALUES {_sensor_values()}) p(k, pollutant, units) "
            f"WHERE u.user_id % {td.NATIONS} IN (SELECT n_nationkey FROM nation n "
            f"JOIN region r ON n.n_regionkey = r.r_regionkey)"),
        "parameter_catalog": (
            f"SELECT DISTINCT p.pollutant, p.units FROM (SELECT DISTINCT user_id FROM events) u, "
            f"(VALUES {_sensor_values()}) p(k, pollutant, units)"),
        "select_stations": _select_stations_sql(),
        "keyed_records": (
            f"WITH {O.scored_ctes(ingest=True)} SELECT coalesce(nullif(city, ''), "
            f"CAST(nullif(location_id, 0) AS VARCHAR), 'unknown') AS key, "
            f"{', '.join(READING_COLUMNS)} FROM scored"),
        "view_roundtrip": f"WITH {O.hourly_ctes()} SELECT {', '.join(B.HOURLY_COLUMNS)} FROM hourly",
        "windowed_aqi_stream": f"WITH {O.windowed_ctes()} SELECT {_WINDOW_SQL} FROM windowed",
        "snapshot_roundtrip": (
            f"WITH {O.windowed_ctes()}, latest AS ({_LATEST}) SELECT city, country, aqi, "
            f"dominant_pollutant, reading_count, dangerous, latitude, longitude, window_start, "
            f"window_end FROM latest"),
        "readings_json_roundtrip": f"WITH {O.scored_ctes()} SELECT {_READING_SQL} FROM scored",
        "batch_job_from_json": f"WITH {O.summary_ctes()} SELECT {_SUMMARY_SQL} FROM summary",
        "batch_job_stored_scores": f"WITH {O.summary_ctes()} SELECT {_SUMMARY_SQL} FROM summary",
        "windowed_aqi_stream_restarted": f"WITH {O.windowed_ctes()} SELECT {_WINDOW_SQL} FROM windowed",
        "batch_incremental": f"WITH {O.hourly_ctes()} SELECT {', '.join(B.HOURLY_COLUMNS)} FROM hourly",
        "serving_job": (
            f"WITH {serving} SELECT " + _SERVING_SQL.replace("computed_at, ", "") + " FROM serving"),
        "ingest_from_json": (
            f"WITH {O.scored_ctes(ingest=True)} SELECT {', '.join(READING_COLUMNS)} FROM scored"),
        "score_with_bands": f"WITH {O.scored_ctes()} SELECT {_READING_SQL} FROM scored",
        "final_windows_stream": (
            f"WITH {O.windowed_ctes()} SELECT {_WINDOW_SQL} FROM windowed WHERE window_end <= "
            f"(SELECT max(event_time) - INTERVAL 2 MINUTE FROM prepared)"),
        "latest_state_stream": (
            f"WITH {O.windowed_ctes()}, latest AS ({_LATEST}) SELECT {_WINDOW_SQL} FROM latest"),
        "settled_history_stream": f"WITH {O.windowed_ctes()} SELECT {_WINDOW_SQL} FROM windowed",
        "stream_late_rows": _late_rows_sql(),
        "batch_views_committed": (
            f"WITH {O.summary_ctes()} SELECT {_SUMMARY_SQL}, hours_observed AS hours_in_view, max_aqi AS max_in_view FROM summary"),
        "city_summary_incremental": f"WITH {O.summary_ctes()} SELECT {_SUMMARY_SQL} FROM summary",
        "quarantined_lines": (
            f"WITH readings AS ({O.readings_cte()}), "
            f"bad AS (SELECT '{{\"city\": \"broken ' || event_id AS what FROM events WHERE event_id % 97 = 0) "
            f"SELECT 'line' AS kind, what, CAST(1 AS BIGINT) AS n FROM bad "
            f"UNION ALL SELECT 'city', city, CAST(count(*) AS BIGINT) FROM readings GROUP BY city "
            f"UNION ALL SELECT 'count', 'malformed', CAST(count(*) AS BIGINT) FROM bad "
            f"UNION ALL SELECT 'count', 'lines', CAST((SELECT count(*) FROM readings) + (SELECT count(*) FROM bad) AS BIGINT)"),
        "select_stations_from_config": _select_stations_sql(td.REGION_WITHOUT_LIMIT),
        "readings_polled": (
            f"WITH {O.scored_ctes(ingest=True)}, undated AS (SELECT *, (location_id * {td.SENSOR_STRIDE} + event_id % "
            f"{len(td.POLLUTANT_CYCLE)}) % {td.UNDATED_EVERY} = 0 AS undated FROM scored) SELECT "
            + ", ".join("CASE WHEN undated THEN ingested_at ELSE datetime_utc END AS datetime_utc" if c == "datetime_utc" else c
                        for c in READING_COLUMNS) + " FROM undated"),
    }
