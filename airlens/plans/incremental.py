"""Incremental batch layer: hourly aggregates of only the new raw files.

The full-history batch job (:func:`airlens.plans.batch.run_batch`) rescans
every raw file each cycle. Here an ``availableNow`` file stream over the raw
folder hands each run only the files it has not seen (its checkpoint keeps
the file log). Each micro-batch adds one small run of mergeable hourly
partials (per-pollutant maxima and a count), partitioned by day; nothing old is
rewritten for it. Readers merge the runs, which is one aggregate with map-side
combine over hourly rows. The days that a micro-batch touches are summed up anew
(``daily/stream=ID``), so a city summary merges one row per city and day.

Runs are folders ``hourly/stream=ID/run=LEVEL-FROM-TO`` over micro-batches FROM
to TO. Once ``fan_in`` runs of a level lie side by side they are merged into one
of the next level, so a row is rewritten once a level, not once a cycle, and
readers meet few runs. A run within a finished larger one is superseded and not
read. A replayed micro-batch overwrites its own run, so a retry never counts a
file twice; a stream with another checkpoint is refused
(:func:`airlens.sources.versions.claim`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airlens.functions import aqi
from airlens.operators.batch import DAILY, HOURLY_COLUMNS, city_summary, daily_partials, prepare, summary_of_daily
from airlens.operators.scoring import (
    SCORE,
    dominant_with_other,
    merge_other_pollutant_aggs,
    merge_pollutant_max_aggs,
    other_pollutant_aggs,
    pollutant_max_aggs,
    pollutant_max_columns,
)
from airlens.schemas import SUMMARY
from airlens.sources import runs
from airlens.sources.versions import claim, stream_identity
from airlens.streaming.speed import read_stream

KEYS = ["city", "country", "hour"]
PARTIALS = ("city string, country string, hour timestamp, aqi double, reading_count long, "
            + ", ".join(f"{c} double" for c in pollutant_max_columns()) + ", _max_other double, _other_name string")


def hourly_partials(prepared: DataFrame, other_pollutants: bool = False) -> DataFrame:
    """The mergeable form of :func:`airlens.operators.batch.hourly_aqi`."""
    agg = prepared.groupBy(*KEYS).agg(
        F.max(SCORE).alias("aqi"), F.count(SCORE).alias("reading_count"), *pollutant_max_aggs(),
        *(other_pollutant_aggs() if other_pollutants else []))
    if not other_pollutants:
        agg = agg.withColumns({"_max_other": F.lit(None).cast("double"), "_other_name": F.lit(None).cast("string")})
    return agg.filter(F.col("aqi").isNotNull())


def merge_partials(partials: DataFrame) -> DataFrame:
    """One row per (city, country, hour); exact, as maxima and counts merge."""
    return partials.groupBy(*KEYS).agg(
        F.max("aqi").alias("aqi"), F.sum("reading_count").alias("reading_count"), *merge_pollutant_max_aggs(),
        *merge_other_pollutant_aggs())


def hourly_of_partials(partials: DataFrame) -> DataFrame:
    """The hourly view; ties of the dominant pollutant in the fixed order."""
    return merge_partials(partials).select(
        *KEYS, dominant_with_other("aqi").alias("dominant_pollutant"), "aqi", "reading_count",
        aqi.is_dangerous("aqi").alias("dangerous")).select(*HOURLY_COLUMNS)


def _read(spark: SparkSession, folder: str, some: list[runs.Run]) -> DataFrame:
    return runs.read(spark, folder, some, PARTIALS).drop("day")


def _write(partials: DataFrame, folder: str, run: runs.Run) -> None:
    (partials.withColumn("day", F.to_date("hour")).hint("rebalance", "day").write.mode("overwrite")
     .partitionBy("day").parquet(runs.path(folder, run)))


def compact(spark: SparkSession, folder: str, below: int, fan_in: int = runs.FAN_IN) -> None:
    """Merge runs of micro-batches before ``below`` by levels."""
    runs.compact(spark, folder, below, lambda some, larger: _write(merge_partials(_read(spark, folder, some)), folder, larger), fan_in)


def read_hourly_version(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The hourly view over all finished runs (None before the first)."""
    found = runs.of_stream(spark, f"{out_dir.rstrip('/')}/hourly")
    return hourly_of_partials(_read(spark, *found)) if found else None


_DAILY_RUN = f"{DAILY}, batch_id long"


def _newest_days(rows: DataFrame) -> DataFrame:
    """Each city's day from the newest run that holds it (a run holds its days whole)."""
    w = Window.partitionBy("city", "country", "day").orderBy(F.desc("batch_id"))
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _add_days(spark: SparkSession, folder: str, hourly_folder: str, batch_id: int, fan_in: int) -> None:
    """Daily partials anew for the days that micro-batch ``batch_id`` touches; of the
    hourly runs only those days are read."""
    run = (0, batch_id, batch_id)
    days = [r["day"] for r in spark.read.schema(f"{PARTIALS}, day date").parquet(runs.path(hourly_folder, run))
            .select("day").distinct().collect()]
    if not days:
        return

    def merge(some: list[runs.Run], larger: runs.Run) -> None:
        _write_days(_newest_days(runs.read(spark, folder, some, _DAILY_RUN)), folder, larger)

    runs.compact(spark, folder, batch_id, merge, fan_in)
    touched = F.col("day").isin([d for d in days if d is not None])
    if None in days:
        touched = touched | F.col("day").isNull()
    parts = runs.read(spark, hourly_folder, runs.live(spark, hourly_folder), f"{PARTIALS}, day date").where(touched)
    fresh = daily_partials(hourly_of_partials(parts.drop("day")))
    _write_days(fresh.withColumn("batch_id", F.lit(batch_id).cast("long")), folder, run)


def _write_days(days: DataFrame, folder: str, run: runs.Run) -> None:
    days.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(runs.path(folder, run))


def read_summary_version(spark: SparkSession, out_dir: str, other_pollutants: bool = False) -> DataFrame:
    """The city summary of the hourly view, from its daily partials, or an empty frame of
    its shape. ``other_pollutants`` as in :func:`airlens.operators.batch.city_summary`; it
    reads the hourly runs."""
    if other_pollutants:
        hourly = read_hourly_version(spark, out_dir)
        return spark.createDataFrame([], SUMMARY) if hourly is None else city_summary(hourly, other_pollutants=True)
    found = runs.of_stream(spark, f"{out_dir.rstrip('/')}/daily")
    if found is None:
        return spark.createDataFrame([], SUMMARY)
    return summary_of_daily(_newest_days(runs.read(spark, *found, _DAILY_RUN)))


def make_merge_writer(out_dir: str, rescore: bool = True, checkpoint_location: str | None = None,
                      fan_in: int = runs.FAN_IN):
    """``foreachBatch`` callback adding one micro-batch of raw readings: a run of
    hourly partials, and a run of daily partials for the days it touches."""
    root = out_dir.rstrip("/")

    def add_batch(raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        stream = stream_identity(spark, checkpoint_location)
        folder, days = claim(spark, f"{root}/hourly", stream), claim(spark, f"{root}/daily", stream)
        compact(spark, folder, batch_id, fan_in)
        _write(hourly_partials(prepare(raw, rescore=rescore), other_pollutants=not rescore),
               folder, (0, batch_id, batch_id))
        _add_days(spark, days, folder, batch_id, fan_in)

    return add_batch


def run_batch_incremental(spark: SparkSession, raw_path: str, out_dir: str, checkpoint_location: str,
                          max_files_per_trigger: int | None = None, rescore: bool = True,
                          fmt: str = "json") -> StreamingQuery:
    """Add every raw file not added before, then stop (``availableNow``).
    Call it once per cycle; wait with ``awaitTermination()``. The file log
    in ``checkpoint_location`` (a shared folder) is what makes each file
    count once, so producers should land files atomically (write, then
    rename into ``raw_path``), as for any file stream."""
    stream = read_stream(spark, raw_path, fmt=fmt, max_files_per_trigger=max_files_per_trigger)
    return (stream.writeStream.foreachBatch(make_merge_writer(out_dir, rescore, checkpoint_location))
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())


__all__ = ["hourly_partials", "merge_partials", "hourly_of_partials", "compact", "read_hourly_version",
           "read_summary_version", "make_merge_writer", "run_batch_incremental"]
