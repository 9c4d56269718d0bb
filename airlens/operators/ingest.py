"""Ingest as Spark jobs: landed station documents and latest-value entries
become scored readings; stations are chosen by country quotas.

The reference does this per station in a Python loop with dict probes; here
each step is a column transform or a join, so it scales with the number of
stations and entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlens.functions.common import first_truthy, iso_utc_string
from airlens.operators.scoring import score
from airlens.schemas import READING_COLUMNS
from airlens.sources.files import DEFAULT_COUNTRY_LIMIT


RANK_SPAN = 1 << 16          # ids of a country that are ranked together


def _named(sensors: Column) -> Column:
    return F.filter(sensors, lambda s: F.coalesce(s["parameter"]["name"], F.lit("")) != "")


def _last_per_id(named: Column) -> Column:
    """Each sensor id once, the last one in array order winning. Done
    inside each document (no shuffle); documents hold a handful of
    sensors."""
    return F.filter(
        named,
        lambda s, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda t: t["id"] == s["id"]),
    )


def station_attributes(locations: DataFrame) -> DataFrame:
    """Flattened station columns: city = locality, else name, else
    'Unknown' (empty counts as missing); country code, '' without one; coordinates; name ('' when missing); named sensors."""
    flat = locations.select(
        F.col("id").cast("int").alias("location_id"),
        F.coalesce(F.col("name"), F.lit("")).alias("location_name"),
        first_truthy(F.col("locality"), F.col("name"), F.lit("Unknown")).alias("city"),
        F.coalesce(F.col("country.code"), F.lit("")).alias("country"),
        F.col("coordinates.latitude").alias("latitude"),
        F.col("coordinates.longitude").alias("longitude"),
        _named(F.col("sensors")).alias("_named"),
    )
    return flat.withColumn("_sensors", _last_per_id(F.col("_named"))).drop("_named")


def _explode_sensors(stations: DataFrame, *keep: str) -> DataFrame:
    """One row per sensor. ``explode_outer`` + a NULL filter rather than
    ``explode``: the latter makes Catalyst infer a ``size(array) > 0``
    filter and push the (interpreted) array functions below joins and
    aggregates, onto every input row."""
    return (stations.select(*keep, F.explode_outer("_sensors").alias("s"))
            .filter(F.col("s").isNotNull()))


def sensor_lookup(locations: DataFrame) -> DataFrame:
    """(location_id, sensor_id, pollutant, units): named sensors only,
    pollutant lower-cased, the last duplicate id winning."""
    return (_explode_sensors(station_attributes(locations), "location_id")
            .select("location_id",
                    F.col("s.id").alias("sensor_id"),
                    F.lower(F.col("s.parameter.name")).alias("pollutant"),
                    F.coalesce(F.col("s.parameter.units"), F.lit("")).alias("units")))


def readings_from_latest(locations: DataFrame, latest: DataFrame,
                         polled_at: Column | None = None, rescore: bool = True) -> DataFrame:
    """Scored readings in the declared 12-column schema.

    Latest entries join their station's sensor (inner: unknown sensors
    drop) and entries without a value drop (0 stays). A missing reading
    time becomes the poll time; ``ingested_at`` is the poll time, one per
    call (``current_timestamp()`` unless given). A station with no entry
    contributes nothing. The sensor side is not broadcast by hint: it grows
    with the number of stations, so the join is left to AQE's runtime size
    check.
    """
    polled = iso_utc_string(polled_at if polled_at is not None else F.current_timestamp())
    stations = station_attributes(locations)
    sensors = _explode_sensors(
        stations, "location_id", "location_name", "city", "country", "latitude", "longitude",
    ).select(
        "*",
        F.col("s.id").alias("sensor_id"),
        F.lower(F.col("s.parameter.name")).alias("pollutant"),
        F.coalesce(F.col("s.parameter.units"), F.lit("")).alias("unit"),
    ).drop("s")
    entries = latest.filter(F.col("value").isNotNull()).select(
        F.col("location_id").cast("int").alias("location_id"),
        F.col("sensorsId").alias("sensor_id"),
        F.col("value"),
        F.col("datetime.utc").alias("_utc"),
    )
    joined = entries.join(sensors, ["location_id", "sensor_id"], "inner")
    out = joined.select(
        "location_id", "location_name", "city", "country", "latitude", "longitude",
        "pollutant", "value", "unit",
        first_truthy(F.col("_utc"), polled).alias("datetime_utc"),
        polled.alias("ingested_at"),
        F.lit(None).cast("double").alias("aqi_sub_index"),
    )
    out = score(out) if rescore else out
    return out.select(*READING_COLUMNS)


def parameters(locations: DataFrame) -> DataFrame:
    """Distinct (pollutant, units) over all stations' named sensors."""
    return sensor_lookup(locations).select("pollutant", "units").distinct()


def select_stations(stations: DataFrame, quotas: DataFrame, max_locations: int | Column = 150) -> DataFrame:
    """Stations chosen by country quota with a running global cap.

    ``stations``: (location_id, iso), list order = ``location_id`` within a
    country. ``quotas``: (ord, iso, label, quota) in priority order (no quota: the
    default limit). Country
    *i* takes ``min(quota_i, found_i, max_locations - taken so far)``; since
    the running total is ``min(cap, prefix sum of min(quota, found))`` this
    is two small prefix sums instead of a loop. Output: (ord, iso, label,
    location_id, station_rank).

    The quota table is a small config list (one row per country), so it is
    broadcast and its one-partition running sum is bounded. No country takes more
    stations than its quota, so the quotas are joined first and a station's rank is
    compared with its own country's; a station of no listed country is never
    shuffled. A country's stations are ranked in spans of their ids (the span in the
    key), so one that holds most of them is spread over tasks; a span's rank goes
    on from the stations counted in the spans before it.
    """
    q = quotas.select("ord", "iso", "label", F.coalesce(F.col("quota").cast("long"), F.lit(DEFAULT_COUNTRY_LIMIT)).alias("quota"))
    span = F.coalesce(F.floor(F.col("location_id") / F.lit(RANK_SPAN)), F.lit(-(1 << 62)))     # no id ranks first
    listed = stations.join(F.broadcast(q.select("iso", "quota")), "iso").withColumn("_span", span)
    counts = listed.groupBy("iso", "_span").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("iso").agg(F.sum("n").alias("found"))
    before = F.sum("n").over(Window.partitionBy("iso").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1))
    # Only spans that start within the quota can hold a taken station.
    starts = (counts.withColumn("_before", F.coalesce(before, F.lit(0))).join(F.broadcast(q.select("iso", "quota")), "iso")
              .where("_before < quota").select("iso", "_span", "_before"))
    capped = (q.join(found, "iso", "left")
              .withColumn("a", F.least(F.col("quota"), F.coalesce(F.col("found"), F.lit(0)))))
    upto = Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cap = max_locations.cast("long") if isinstance(max_locations, Column) else F.lit(int(max_locations)).cast("long")
    cum = F.sum("a").over(upto)
    takes = (capped.withColumn("taken", F.least(cap, cum) - F.least(cap, cum - F.col("a")))
             .select("ord", "iso", "label", "taken"))
    rank = F.row_number().over(Window.partitionBy("iso", "_span").orderBy("location_id"))
    ranked = listed.withColumn("_rank", rank)
    if not isinstance(max_locations, Column):           # a literal limit is applied before the shuffle, too
        ranked = ranked.filter(F.col("_rank") <= int(max_locations))
    ranked = ranked.join(starts, ["iso", "_span"]).withColumn("station_rank", (F.col("_before") + F.col("_rank")).cast("int"))
    return (ranked.join(F.broadcast(takes), "iso")
            .filter(F.col("station_rank") <= F.col("taken"))
            .select("ord", "iso", "label", "location_id", "station_rank"))
