"""Sliding event-time windows per city (batch or stream), and the
"latest window per city" selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airlens.functions import aqi
from airlens.operators.batch import with_event_time
from airlens.operators.scoring import (
    SCORE,
    dominant_of_maxes,
    dominant_with_other,
    merge_other_pollutant_aggs,
    merge_pollutant_max_aggs,
    other_pollutant_aggs,
    pollutant_max_aggs,
    pollutant_max_columns,
)
from airlens.schemas import WINDOW_COLUMNS

# Fixed settings of the speed layer.
WINDOW_DURATION = "60 minutes"
SLIDE_DURATION = "5 minutes"
WATERMARK = "2 minutes"

_SLIDE_US = 5 * 60 * 1_000_000
_SLIDES_PER_WINDOW = 12


def _coord_key() -> Column:
    """Station id used to pick coordinates: the smallest scored station
    that has both of them (deterministic, never mixes two stations)."""
    ok = F.col(SCORE).isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return F.when(ok, F.col("location_id"))


def _finish(agg: DataFrame, start: Column, end: Column, other: bool = False) -> DataFrame:
    dominant = dominant_with_other("aqi") if other else dominant_of_maxes("aqi")
    return agg.filter(F.col("aqi").isNotNull()).select(
        start.alias("window_start"),
        end.alias("window_end"),
        "city", "country", "aqi",
        dominant.alias("dominant_pollutant"),
        "reading_count",
        aqi.is_dangerous("aqi").alias("dangerous"),
        "latitude", "longitude",
    )


def windowed_aqi(scored: DataFrame, watermark: str | None = None,
                 other_pollutants: bool = False) -> DataFrame:
    """60-minute windows sliding by 5 minutes (12 per reading), per
    (window, city, country): worst sub-index, dominant pollutant, count of
    scored readings, danger flag, one station's coordinates.

    The same function serves a batch frame and a streaming one; pass
    ``watermark`` for a stream. In a stream an unscored reading gets a NULL
    event time, so it neither feeds a window nor moves the watermark (the
    predicate on the event time stays above the watermark node, so the
    score is not recomputed by a pushed-down filter). ``other_pollutants``
    as in :func:`airlens.operators.batch.hourly_aqi`.
    """
    df = with_event_time(scored)
    if watermark:
        df = df.withColumn("event_time", F.when(F.col(SCORE).isNotNull(), F.col("event_time")))
        df = df.withWatermark("event_time", watermark)
    df = df.withColumn("_sid", _coord_key())
    agg = df.groupBy(
        F.window("event_time", WINDOW_DURATION, SLIDE_DURATION).alias("window"),
        "city", "country",
    ).agg(
        F.max(SCORE).alias("aqi"),
        F.count(SCORE).alias("reading_count"),
        F.min_by("latitude", "_sid").alias("latitude"),
        F.min_by("longitude", "_sid").alias("longitude"),
        *pollutant_max_aggs(),
        *(other_pollutant_aggs() if other_pollutants else []),
    )
    return _finish(agg, F.col("window.start"), F.col("window.end"), other=other_pollutants)


def windowed_aqi_bucketed(scored: DataFrame) -> DataFrame:
    """Batch form of :func:`windowed_aqi` with the same result.

    Readings are first reduced to 5-minute buckets per city (max per
    pollutant, count, smallest station id and its coordinates); only the
    buckets are expanded 12 times. Dense data (many readings per city per
    5 minutes) expands far fewer rows than the 12x-per-reading form.
    """
    buckets = bucket_aggregates(scored)
    slides = F.array(*[F.lit(i * _SLIDE_US) for i in range(_SLIDES_PER_WINDOW)])
    expanded = (buckets.withColumn("_k", F.explode(slides))
                .withColumn("_ws", F.col("_bucket") - F.col("_k")))
    agg = _window_from_buckets(expanded, ["_ws", "city", "country"])
    start = F.timestamp_micros(F.col("_ws"))
    end = F.timestamp_micros(F.col("_ws") + F.lit(_SLIDES_PER_WINDOW * _SLIDE_US))
    return _finish(agg, start, end)


def latest_windows(windowed: DataFrame, ordered: bool = True, ties: list[Column] | None = None) -> DataFrame:
    """Per (city, country) the window with the largest ``window_end``,
    sorted by ``aqi`` descending. Rows without a city or country are left
    out. Note that this window is mostly in the future of the newest
    reading (it starts at its 5-minute mark); :func:`trailing_hour` gives
    the window that ends at a given time. ``ties`` orders several rows of
    one window (re-emissions).

    ``row_number() = 1`` lets Spark insert a partial group limit before the
    shuffle, so a city with very many windows ships one row per map task.
    """
    w = Window.partitionBy("city", "country").orderBy(F.col("window_end").desc(), *(ties or []))
    out = (windowed.filter(F.col("city").isNotNull() & F.col("country").isNotNull())
           .withColumn("_rn", F.row_number().over(w))
           .filter(F.col("_rn") == 1)
           .drop("_rn"))
    return out.orderBy(F.desc("aqi"), "city", "country") if ordered else out


def trailing_hour(windowed: DataFrame, as_of) -> DataFrame:
    """Per city, the last window that has ended by ``as_of`` (a timestamp
    or a Column): the hour that actually trails ``as_of``."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return latest_windows(windowed.filter(F.col("window_end") <= as_of))


def bucket_aggregates(scored: DataFrame, keep_null_time: bool = False) -> DataFrame:
    """Per (city, country, 5-minute bucket) with a scored reading: the
    mergeable partials of a window or an hour (per-pollutant maxima,
    count, smallest station id and its coordinates). Map-side combined, so
    a hot city is spread over its buckets. ``keep_null_time`` keeps one
    NULL bucket per city for readings without a usable time (the hourly
    view keeps them as a group; windows never do)."""
    df = with_event_time(scored)
    if not keep_null_time:
        df = df.filter(F.col("event_time").isNotNull())
    us = F.unix_micros(F.col("event_time"))
    df = df.withColumns({"_bucket": us - F.pmod(us, F.lit(_SLIDE_US)), "_sid": _coord_key()})
    return df.groupBy("_bucket", "city", "country").agg(
        F.max(SCORE).alias("_b_aqi"),
        F.count(SCORE).alias("_b_count"),
        F.min("_sid").alias("_b_sid"),
        F.min_by("latitude", "_sid").alias("_b_lat"),
        F.min_by("longitude", "_sid").alias("_b_lon"),
        *pollutant_max_aggs(),
    ).filter(F.col("_b_aqi").isNotNull())


def _merged_bucket_aggs() -> list[Column]:
    return [
        F.max("_b_aqi").alias("aqi"),
        F.sum("_b_count").alias("reading_count"),
        F.min_by("_b_lat", "_b_sid").alias("latitude"),
        F.min_by("_b_lon", "_b_sid").alias("longitude"),
        *merge_pollutant_max_aggs(),
    ]


def _window_from_buckets(buckets: DataFrame, keys: list[str]) -> DataFrame:
    return buckets.groupBy(*keys).agg(*_merged_bucket_aggs())


def latest_windows_direct(scored: DataFrame, ordered: bool = True) -> DataFrame:
    """Same rows as ``latest_windows(windowed_aqi(scored))`` without
    computing every window of the history.

    A city's newest window starts at the 5-minute mark of its newest scored
    reading, so it holds exactly that reading's bucket: the answer is the
    newest bucket aggregate per city (a partial top-1 before the shuffle).
    """
    return latest_windows_from_buckets(bucket_aggregates(scored), ordered=ordered)


def latest_windows_from_buckets(buckets: DataFrame, ordered: bool = True) -> DataFrame:
    """:func:`latest_windows_direct` over bucket aggregates that may be
    shared with other plans (e.g. the hourly view, from the same shuffle)."""
    b = buckets.filter(F.col("city").isNotNull() & F.col("country").isNotNull())
    # A NULL bucket (no usable time) sorts last and is dropped after the
    # rank, so the bucket aggregate itself stays as given (a filter on its
    # grouping key would be pushed below it).
    w = Window.partitionBy("city", "country").orderBy(F.col("_bucket").desc_nulls_last())
    newest = (b.withColumn("_rn", F.row_number().over(w))
              .filter((F.col("_rn") == 1) & F.col("_bucket").isNotNull()))
    out = windows_of_buckets(newest)
    return out.orderBy(F.desc("aqi"), "city", "country") if ordered else out


def windows_of_buckets(buckets: DataFrame) -> DataFrame:
    """The window that starts at each bucket and holds only it."""
    agg = buckets.select(
        F.col("_bucket").alias("_ws"), "city", "country",
        F.col("_b_aqi").alias("aqi"), F.col("_b_count").alias("reading_count"),
        F.col("_b_lat").alias("latitude"), F.col("_b_lon").alias("longitude"),
        *pollutant_max_columns())
    start = F.timestamp_micros(F.col("_ws"))
    end = F.timestamp_micros(F.col("_ws") + F.lit(_SLIDES_PER_WINDOW * _SLIDE_US))
    return _finish(agg, start, end)


def bucket_start(us: Column) -> Column:
    """The 5-minute mark at or before a time in microseconds."""
    return us - F.pmod(us, F.lit(_SLIDE_US))


def trailing_hour_direct(scored: DataFrame, as_of) -> DataFrame:
    """Same rows as ``trailing_hour(windowed_aqi(scored), as_of)`` from the
    5-minute buckets before ``as_of`` only, in one aggregate per city.

    With E the last 5-minute mark at or before ``as_of``: a city with a
    bucket in ``[E - 60 min, E)`` gets exactly that hour (an aggregate over
    those buckets); any other city's last ended window starts at its newest
    bucket before E and holds only that bucket. Both come from conditional
    aggregates over the same buckets, combined on the map side, so a city holding
    most of the data does not land in one task.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    a_us = F.unix_micros(as_of.cast("timestamp"))
    mark = a_us - F.pmod(a_us, F.lit(_SLIDE_US))
    span = F.lit(_SLIDES_PER_WINDOW * _SLIDE_US)
    b = (bucket_aggregates(scored)
         .filter(F.col("city").isNotNull() & F.col("country").isNotNull())
         .withColumn("_mark", mark).filter(F.col("_bucket") < F.col("_mark")))
    recent = F.col("_bucket") >= F.col("_mark") - span
    older = F.when(~recent, F.col("_bucket"))
    sid = F.when(recent, F.col("_b_sid"))
    hour = {"_ws": F.max(F.when(recent, F.col("_mark") - span)), "aqi": F.max(F.when(recent, F.col("_b_aqi"))),
            "reading_count": F.sum(F.when(recent, F.col("_b_count"))),
            "latitude": F.min_by("_b_lat", sid), "longitude": F.min_by("_b_lon", sid),
            **{c: F.max(F.when(recent, F.col(c))) for c in pollutant_max_columns()}}
    newest = {"_ws": F.max(older), "aqi": F.max_by("_b_aqi", older), "reading_count": F.max_by("_b_count", older),
              "latitude": F.max_by("_b_lat", older), "longitude": F.max_by("_b_lon", older),
              **{c: F.max_by(c, older) for c in pollutant_max_columns()}}
    agg = b.groupBy("city", "country").agg(*[c.alias(f"h_{n}") for n, c in hour.items()],
                                           *[c.alias(f"n_{n}") for n, c in newest.items()])
    whole = F.col("h__ws").isNotNull()
    agg = agg.select("city", "country", *[F.when(whole, F.col(f"h_{n}")).otherwise(F.col(f"n_{n}")).alias(n) for n in hour])
    start = F.timestamp_micros(F.col("_ws"))
    end = F.timestamp_micros(F.col("_ws") + span)
    return _finish(agg, start, end).orderBy(F.desc("aqi"), "city", "country")


def final_windows(scored: DataFrame, watermark: str = WATERMARK, other_pollutants: bool = False) -> DataFrame:
    """Ended windows of a stream, each exactly once (append mode): the windows
    of :func:`windowed_aqi` that end at or before the watermark.

    Two chained stateful aggregations: readings are reduced to 5-minute tumbling
    buckets per city, and only a finished bucket is expanded to its 12 windows.
    State and shuffle therefore hold a row per (bucket, city) in the first step
    and 12 per bucket in the second, not 12 per reading. A late reading is dropped
    once its bucket has ended, so a window never changes after it is given.
    """
    df = with_event_time(scored)
    df = df.withColumn("event_time", F.when(F.col(SCORE).isNotNull(), F.col("event_time")))
    df = df.withWatermark("event_time", watermark).withColumn("_sid", _coord_key())
    buckets = df.groupBy(F.window("event_time", SLIDE_DURATION).alias("_slot"), "city", "country").agg(
        F.max(SCORE).alias("_b_aqi"), F.count(SCORE).alias("_b_count"), F.min("_sid").alias("_b_sid"),
        F.min_by("latitude", "_sid").alias("_b_lat"), F.min_by("longitude", "_sid").alias("_b_lon"),
        *pollutant_max_aggs(), *(other_pollutant_aggs() if other_pollutants else []))
    sliding = F.window(F.window_time("_slot"), WINDOW_DURATION, SLIDE_DURATION).alias("window")
    agg = buckets.groupBy(sliding, "city", "country").agg(
        *_merged_bucket_aggs(), *(merge_other_pollutant_aggs() if other_pollutants else []))
    return _finish(agg, F.col("window.start"), F.col("window.end"), other=other_pollutants)


__all__ = ["windowed_aqi", "windowed_aqi_bucketed", "latest_windows", "trailing_hour",
           "latest_windows_direct", "latest_windows_from_buckets", "trailing_hour_direct",
           "bucket_aggregates", "windows_of_buckets", "bucket_start", "final_windows", "WINDOW_COLUMNS"]
