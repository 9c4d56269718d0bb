"""The latest window of every city as keyed state.

A city's newest window starts at the 5-minute mark of its newest scored
reading, so it is that mark's bucket (see
:func:`airlens.operators.windows.latest_windows_direct`). The stream keeps one bucket
per (city, country): readings of a newer mark replace it, readings of the same mark
add to it, older ones change nothing. Cities that send nothing stay; a city without
readings for ``ttl`` is forgotten (processing time, renewed by every reading).

A trigger reads and writes the state of the cities it touches only, and adds one run of
them to ``latest``; runs are merged by levels (:mod:`airlens.sources.runs`), and
a reader takes each city's newest row. State is in RocksDB under the
checkpoint, so a restart goes on where the stream stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from airlens.functions import aqi
from airlens.operators.batch import with_event_time
from airlens.operators.scoring import SCORE
from airlens.operators.windows import bucket_start, windows_of_buckets
from airlens.session import ship
from airlens.sources import runs
from airlens.sources.versions import claim, stream_identity
from airlens.streaming.speed import DEFAULT_TRIGGER_SECONDS, ROCKSDB_PROVIDER, start_with

TTL_MS = 30 * 24 * 3600 * 1000
# The columns of a bucket, under names that a named tuple can have.
MAXES = [f"max_{p}" for p in aqi.POLLUTANTS]
FIELDS = ["bucket", "b_aqi", "b_count", "b_sid", "b_lat", "b_lon", *MAXES]
STATE = ("bucket long, b_aqi double, b_count long, b_sid int, b_lat double, b_lon double, "
         + ", ".join(f"{c} double" for c in MAXES))
OUTPUT = f"city string, country string, {STATE}"
POSITION = {p: FIELDS.index(f"max_{p}") for p in aqi.POLLUTANTS}


class NewestBucket(StatefulProcessor):
    """State of a city: the bucket of its newest 5-minute mark (``STATE``)."""

    def __init__(self, ttl_ms: int | None = TTL_MS):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("newest", STATE, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = list(self.state.get()) if self.state.exists() else None
        for r in rows:
            bucket, score, pollutant, station, lat, lon = r[2:]
            if bucket is None or score is None:
                continue
            if best is None or bucket > best[0]:
                best = [bucket, score, 0, *[None] * (len(FIELDS) - 3)]
            if bucket == best[0]:
                best[1] = max(best[1], score)
                best[2] += 1
                if lat is not None and lon is not None and station is not None and (best[3] is None or station < best[3]):
                    best[3:6] = station, lat, lon       # the smallest station that has coordinates
                if pollutant in POSITION:
                    i = POSITION[pollutant]
                    best[i] = score if best[i] is None else max(best[i], score)
        if best is not None:
            self.state.update(tuple(best))
            yield Row(**dict(zip(["city", "country", *FIELDS], (*key, *best))))

    def close(self) -> None:
        pass


def latest_stream(scored: DataFrame, ttl_ms: int | None = TTL_MS) -> DataFrame:
    """The newest bucket (``OUTPUT``) of each city that a trigger touches, from a stream of
    scored readings. Readings without a score, a time, a city or a country take no part; the
    processor leaves the unscored ones out (a filter on the score would be pushed below
    the scoring projections)."""
    ship(scored.sparkSession)
    us = F.unix_micros("event_time")
    used = with_event_time(scored).where(F.col("city").isNotNull() & F.col("country").isNotNull()).select(
        "city", "country", bucket_start(us).alias("bucket"), F.col(SCORE).alias("score"), F.lower("pollutant").alias("pollutant"),
        F.col("location_id").cast("int").alias("station"), "latitude", "longitude")
    return used.groupBy("city", "country").transformWithState(
        statefulProcessor=NewestBucket(ttl_ms), outputStructType=OUTPUT, outputMode="Update", timeMode="ProcessingTime")


def _newest(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("city", "country").orderBy(F.desc("batch_id"))
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


_RUN = f"{OUTPUT}, batch_id long"


def make_latest_writer(out_dir: str, checkpoint_location: str | None = None, fan_in: int = runs.FAN_IN):
    """``foreachBatch`` callback that adds a run of the cities touched."""
    root = f"{out_dir.rstrip('/')}/latest"

    def add(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        folder = claim(spark, root, stream_identity(spark, checkpoint_location))

        def merge(some: list[runs.Run], larger: runs.Run) -> None:
            _newest(runs.read(spark, folder, some, _RUN)).write.mode("overwrite").parquet(runs.path(folder, larger))

        runs.compact(spark, folder, batch_id, merge, fan_in)
        df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
            runs.path(folder, (0, batch_id, batch_id)))

    return add


def start_latest(latest: DataFrame, out_dir: str, checkpoint_location: str,
                 trigger_seconds: int | None = DEFAULT_TRIGGER_SECONDS, available_now: bool = False,
                 state_partitions: int | None = None) -> StreamingQuery:
    """Start the stream of :func:`latest_stream`; settings as in :func:`airlens.streaming.speed.start`.
    State with a TTL would ask for one empty micro-batch after the other, so these
    are off: what has expired is not read, and is cleared with the next readings."""
    own = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
           "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    if state_partitions:
        own["spark.sql.shuffle.partitions"] = str(int(state_partitions))
    writer = (latest.writeStream.outputMode("update").foreachBatch(make_latest_writer(out_dir, checkpoint_location))
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_seconds:
        writer = writer.trigger(processingTime=f"{int(trigger_seconds)} seconds")
    return start_with(writer, latest.sparkSession, own)


def read_latest_windows(spark: SparkSession, out_dir: str) -> DataFrame:
    """The newest window of every city so far (window columns, worst first)."""
    found = runs.of_stream(spark, f"{out_dir.rstrip('/')}/latest")
    rows = runs.read(spark, *found, _RUN) if found else spark.createDataFrame([], _RUN)
    buckets = _newest(rows).withColumnsRenamed({f: f"_{f}" for f in FIELDS})
    return windows_of_buckets(buckets).orderBy(F.desc("aqi"), "city", "country")


__all__ = ["NewestBucket", "latest_stream", "make_latest_writer", "start_latest", "read_latest_windows"]
