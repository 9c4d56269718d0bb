"""Batch layer operators: prepared readings, hourly city AQI (from readings
or from 5-minute bucket aggregates), city summary, top-k worst cities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlens.functions import aqi
from airlens.functions.common import parse_iso_timestamp
from airlens.operators.scoring import (
    SCORE,
    dominant_of_maxes,
    dominant_with_other,
    merge_pollutant_max_aggs,
    other_pollutant_aggs,
    pollutant_max_aggs,
    score,
)

HOURLY_COLUMNS = ["city", "country", "hour", "dominant_pollutant", "aqi", "reading_count", "dangerous"]
SUMMARY_COLUMNS = ["city", "country", "hours_observed", "avg_aqi", "max_aqi", "max_aqi_at",
                   "worst_pollutant", "pct_hours_dangerous"]


def with_event_time(readings: DataFrame) -> DataFrame:
    """``event_time`` from ``datetime_utc`` unless the source already has a
    typed one. Garbage text gives NULL instead of failing the job."""
    if "event_time" in readings.columns:
        return readings
    return readings.withColumn("event_time", parse_iso_timestamp("datetime_utc"))


def prepare(readings: DataFrame, rescore: bool = True, trust_existing: bool = False) -> DataFrame:
    """Scored readings with ``event_time`` and ``hour``.

    Unscored readings stay, with a NULL score, and every aggregate ignores
    them (same results as dropping them first, without a filter that
    Catalyst would push below the scoring projections and so evaluate the
    score twice). ``rescore=False`` trusts the score stored in the data.
    """
    df = score(readings, trust_existing=trust_existing) if rescore else readings
    df = with_event_time(df)
    return df.withColumn("hour", F.date_trunc("hour", F.col("event_time")))


def hourly_aqi(prepared: DataFrame, other_pollutants: bool = False) -> DataFrame:
    """Per (city, country, hour): worst sub-index, its pollutant (ties in
    the order pm25, pm10, o3, co, so2, no2), count of scored readings and
    the danger flag on the unrounded value. A NULL hour (unparseable time)
    is a group of its own; groups with no scored reading give no row.

    ``other_pollutants``: also report a pollutant without breakpoints as
    dominant when its (trusted, stored) score is the worst.
    """
    extra = other_pollutant_aggs() if other_pollutants else []
    agg = prepared.groupBy("city", "country", "hour").agg(
        F.max(SCORE).alias("aqi"),
        F.count(SCORE).alias("reading_count"),
        *pollutant_max_aggs(),
        *extra,
    )
    dominant = dominant_with_other("aqi") if other_pollutants else dominant_of_maxes("aqi")
    return agg.filter(F.col("aqi").isNotNull()).select(
        "city", "country", "hour",
        dominant.alias("dominant_pollutant"),
        "aqi", "reading_count",
        aqi.is_dangerous("aqi").alias("dangerous"),
    )


def hourly_from_buckets(buckets: DataFrame) -> DataFrame:
    """:func:`hourly_aqi` merged from 5-minute bucket aggregates
    (``airlens.operators.windows.bucket_aggregates(..., keep_null_time=True)``):
    buckets nest in hours, so maxima merge and counts add. The hourly view
    then costs one small aggregate over buckets a plan already has."""
    hour = F.date_trunc("hour", F.timestamp_micros(F.col("_bucket")))
    agg = buckets.groupBy("city", "country", hour.alias("hour")).agg(
        F.max("_b_aqi").alias("aqi"),
        F.sum("_b_count").alias("reading_count"),
        *merge_pollutant_max_aggs(),
    )
    return agg.select(
        "city", "country", "hour",
        dominant_of_maxes("aqi").alias("dominant_pollutant"),
        "aqi", "reading_count",
        aqi.is_dangerous("aqi").alias("dangerous"),
    )


_NO_HOUR = (1 << 63) - 1            # the NULL hour, after every other
_SUM = "decimal(38,12)"             # sums that do not depend on their order


def daily_partials(hourly: DataFrame) -> DataFrame:
    """Per (city, country, day) of the hourly view (a NULL hour has a NULL day), what a
    city summary merges (``DAILY``): hours, sum, dangerous hours, the maximum, its
    earliest hour and the pollutant at it. Fixed width: the hour is a long and the
    pollutant a code, so both aggregates stay hash-based. The first groups equal scores, which
    makes the hour of the maximum unique for the second; one shuffle serves both."""
    pos = F.array_position(F.array(*[F.lit(p) for p in aqi.POLLUTANTS]), F.col("dominant_pollutant"))
    rows = hourly.select(
        "city", "country", F.to_date("hour").alias("day"), "aqi", F.col("aqi").cast(_SUM).alias("_s"),
        F.col("dangerous").cast("int").alias("_d"), F.coalesce(F.unix_micros("hour"), F.lit(_NO_HOUR)).alias("_at"),
        F.when(pos > 0, (pos - 1).cast("int")).alias("_code"))
    keys = ["city", "country", "day"]
    equal = rows.repartition(*keys).groupBy(*keys, "aqi").agg(
        F.count(F.lit(1)).alias("hours"), F.sum("_s").alias("aqi_sum"), F.sum("_d").alias("dangerous_hours"),
        F.min("_at").alias("max_at"), F.min_by("_code", "_at").alias("worst_code"))
    return _of_equal_scores(equal.withColumnRenamed("aqi", "max_aqi"), keys)


def merge_daily(daily: DataFrame) -> DataFrame:
    """The days of each city merged (no ``day``); as hash-based as the days."""
    keys = ["city", "country"]
    equal = daily.repartition(*keys).groupBy(*keys, "max_aqi").agg(
        F.sum("hours").alias("hours"), F.sum("aqi_sum").alias("aqi_sum"), F.sum("dangerous_hours").alias("dangerous_hours"),
        F.min("max_at").alias("max_at"), F.min_by("worst_code", "max_at").alias("worst_code"))
    return _of_equal_scores(equal, keys)


def _of_equal_scores(equal: DataFrame, keys: list[str]) -> DataFrame:
    return equal.groupBy(*keys).agg(
        F.sum("hours").alias("hours"), F.sum("aqi_sum").cast(_SUM).alias("aqi_sum"),
        F.sum("dangerous_hours").alias("dangerous_hours"), F.max("max_aqi").alias("max_aqi"),
        F.max_by("max_at", "max_aqi").alias("max_at"), F.max_by("worst_code", "max_aqi").alias("worst_code"))


DAILY = (f"city string, country string, day date, hours long, aqi_sum {_SUM}, dangerous_hours long, max_aqi double, "
         "max_at long, worst_code int")


def summary_of_daily(daily: DataFrame, ordered: bool = True) -> DataFrame:
    """The city summary from :func:`daily_partials`."""
    hours = F.col("hours")
    out = merge_daily(daily).select(
        "city", "country", hours.alias("hours_observed"),
        (F.col("aqi_sum").cast("double") / hours).alias("avg_aqi"), "max_aqi",
        F.when(F.col("max_at") < _NO_HOUR, F.timestamp_micros("max_at")).alias("max_aqi_at"),
        F.get(F.array(*[F.lit(p) for p in aqi.POLLUTANTS]), F.col("worst_code")).alias("worst_pollutant"),
        (F.col("dangerous_hours") / hours).alias("pct_hours_dangerous"))
    return out.orderBy(F.desc("max_aqi"), "city", "country") if ordered else out


def city_summary(hourly: DataFrame, ordered: bool = True, other_pollutants: bool = False) -> DataFrame:
    """Per (city, country) over the hourly view.

    ``max_aqi_at`` and ``worst_pollutant`` come from one row: the earliest
    hour at the maximum (a NULL hour last). ``pct_hours_dangerous`` is a
    fraction 0..1. Sorted by ``max_aqi`` descending, then city, country.

    ``other_pollutants``: the view may name pollutants without breakpoints
    (trusted, stored scores). Names of any length need a sort-based aggregate;
    without the option such a name is NULL here.
    """
    if not other_pollutants:
        return summary_of_daily(daily_partials(hourly), ordered)
    best = F.max(F.struct(
        F.col("aqi"),
        (-F.unix_micros(F.col("hour"))).alias("neg_hour"),
        F.col("hour"),
        F.col("dominant_pollutant"),
    ))
    agg = hourly.groupBy("city", "country").agg(
        F.count(F.lit(1)).alias("hours_observed"),
        (F.sum(F.col("aqi").cast(_SUM)).cast("double") / F.count(F.lit(1))).alias("avg_aqi"),
        F.max("aqi").alias("max_aqi"),
        best.alias("_best"),
        (F.sum(F.col("dangerous").cast("int")) / F.count(F.lit(1))).alias("pct_hours_dangerous"),
    )
    out = agg.select(
        "city", "country", "hours_observed", "avg_aqi", "max_aqi",
        F.col("_best.hour").alias("max_aqi_at"),
        F.col("_best.dominant_pollutant").alias("worst_pollutant"),
        "pct_hours_dangerous",
    )
    return out.orderBy(F.desc("max_aqi"), "city", "country") if ordered else out


def worst_cities(summary: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` cities by ``max_aqi`` (ties by city, country): a
    TakeOrderedAndProject, never a full sort."""
    return summary.orderBy(F.desc("max_aqi"), F.asc("city"), F.asc("country")).limit(n)


def dangerous_reading_counts(prepared_or_scored: DataFrame) -> DataFrame:
    """Readings at a dangerous level (a NULL score counts as 0) and all
    readings, in one pass."""
    s = F.coalesce(F.col(SCORE), F.lit(0.0))
    return prepared_or_scored.agg(
        F.count_if(s >= aqi.DANGEROUS_AQI).alias("dangerous_readings"),
        F.count(F.lit(1)).alias("readings"),
    )
