"""Serving layer: the speed snapshot joined with the batch history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airlens.operators.windows import latest_windows
from airlens.schemas import SERVING_COLUMNS, SNAPSHOT_COLUMNS

_HISTORY_RENAMES = {
    "avg_aqi": "historical_avg_aqi",
    "max_aqi": "historical_max_aqi",
    "worst_pollutant": "historical_worst_pollutant",
}
_HISTORY_KEEP = ["city", "country", "historical_avg_aqi", "historical_max_aqi",
                 "historical_worst_pollutant", "pct_hours_dangerous"]


def speed_snapshot(windowed: DataFrame, computed_at: Column | None = None) -> DataFrame:
    """Latest window per city in the 11 snapshot columns, stamped with
    ``computed_at`` (one ``current_timestamp()`` per query by default)."""
    stamp = computed_at if computed_at is not None else F.current_timestamp()
    latest = latest_windows(windowed, ordered=False).withColumn("computed_at", stamp)
    return latest.select(*SNAPSHOT_COLUMNS).orderBy(F.desc("aqi"), "city", "country")


def snapshot_from_latest(latest: DataFrame, computed_at: Column | None = None) -> DataFrame:
    """The 11 snapshot columns from rows that already are one window per
    city (e.g. ``latest_windows_direct``)."""
    stamp = computed_at if computed_at is not None else F.current_timestamp()
    return latest.withColumn("computed_at", stamp).select(*SNAPSHOT_COLUMNS)


def merge_views(summary: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Snapshot ⟕ summary on (city, country): the 16 serving columns.

    History columns are renamed ``historical_*`` (those the summary has);
    ``vs_historical_avg`` is NULL for a city without history. The join is a
    plain equi-join: both sides hold one row per city, and AQE turns it
    into a broadcast when the runtime size of a side is small.
    """
    renamed = summary.withColumnsRenamed(
        {k: v for k, v in _HISTORY_RENAMES.items() if k in summary.columns})
    keep = [c for c in _HISTORY_KEEP if c in renamed.columns]
    merged = snapshot.join(renamed.select(*keep), ["city", "country"], "left")
    for c in _HISTORY_KEEP[2:]:
        if c not in merged.columns:
            merged = merged.withColumn(c, F.lit(None))
    merged = merged.withColumn("vs_historical_avg", F.col("aqi") - F.col("historical_avg_aqi"))
    return merged.select(*SERVING_COLUMNS).orderBy(F.desc("aqi"), "city", "country")


def dangerous_now(serving: DataFrame) -> DataFrame:
    """Dangerous cities, worst first; passes through without the column."""
    if "dangerous" not in serving.columns:
        return serving
    return serving.filter(F.col("dangerous")).orderBy(F.desc("aqi"), "city", "country")


DASHBOARD_COLUMNS = ["city", "country", "aqi", "dominant_pollutant", "reading_count",
                     "window_end", "historical_avg_aqi"]


def dashboard_table(df: DataFrame) -> DataFrame:
    """The 7-column result table, keeping those present."""
    return df.select(*[c for c in DASHBOARD_COLUMNS if c in df.columns])


def map_points(df: DataFrame) -> DataFrame:
    """Points with both coordinates, as (lat, lon)."""
    return (df.dropna(subset=["latitude", "longitude"])
            .select(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")))


def console_rows(df: DataFrame) -> DataFrame:
    return df.select("city", "country", "aqi", "dominant_pollutant")


def serving_counts(serving: DataFrame) -> DataFrame:
    """Cities in the view and dangerous ones, in one pass."""
    return serving.agg(
        F.count(F.lit(1)).alias("cities"),
        F.count_if(F.col("dangerous")).alias("dangerous_cities"),
    )
