"""Speed layer on Structured Streaming: a growing directory of readings
becomes 60-minute sliding windows per city (watermark 2 minutes, update
mode), written each micro-batch as a history partition and a snapshot of
the latest window per city."""

from __future__ import annotations

import logging
import threading

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from airlens.operators.batch import prepare
from airlens.operators.serving import speed_snapshot
from airlens.operators.windows import WATERMARK, latest_windows, windowed_aqi
from airlens.schemas import READING, SNAPSHOT_COLUMNS, WINDOW
from airlens.sources.appends import recover
from airlens.sources.manifest import Draft, Manifest, current
from airlens.sources.versions import claim, file_system, stream_identity
from airlens.streaming.metrics import BatchMetrics

log = logging.getLogger(__name__)

DEFAULT_TRIGGER_SECONDS = 30


def read_stream(spark: SparkSession, path: str, fmt: str = "json", schema: StructType = READING,
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Streaming scan of ``path`` (subdirectories too) with a declared
    schema. ``fmt`` may name any streaming source (e.g. ``kafka`` with its
    options, then parse ``value`` with ``from_json``)."""
    recover(spark, path)
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def parse_keyed_readings(records: DataFrame, schema: StructType = READING) -> DataFrame:
    """Readings from keyed records (a Kafka-style source: ``value`` holds
    one JSON reading, as written by ``airlens.sinks.files.keyed_records``).
    A malformed value gives an all-NULL reading, as the file scan does."""
    value = F.col("value").cast("string")
    return records.select(F.from_json(value, schema).alias("r")).select("r.*")


def read_kafka_readings(spark: SparkSession, bootstrap_servers: str, topic: str,
                        max_offsets_per_trigger: int | None = None, **options) -> DataFrame:
    """Streaming readings from a Kafka topic (needs the Kafka connector on
    the classpath)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", int(max_offsets_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    return parse_keyed_readings(reader.load())


def windowed_stream(raw_stream: DataFrame, rescore: bool = True,
                    watermark: str = WATERMARK) -> DataFrame:
    """Windowed AQI per city over a stream of readings. ``rescore=False``
    trusts the score stored with each reading (then a pollutant without
    breakpoints can be the dominant one, too)."""
    return windowed_aqi(prepare(raw_stream, rescore=rescore), watermark=watermark,
                        other_pollutants=not rescore)


DAY_US = 24 * 3600 * 1_000_000
FINAL = StructType([*WINDOW.fields, StructField("day", DateType(), True)])


def _open_windows(spark: SparkSession, commit: Manifest, batches: list[dict]) -> DataFrame:
    """Windows of these open micro-batches, the newest emission of each."""
    folder = f"{commit.root}/history/stream={commit.details['stream']}"
    rows = spark.read.schema(_with_batch(WINDOW)).option("basePath", folder).parquet(
        *[f"{folder}/batch_id={b['batch_id']}" for b in batches])
    return _newest_emission(rows)


def _with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("batch_id", LongType(), True)])


def _newest_emission(history: DataFrame) -> DataFrame:
    w = Window.partitionBy("window_start", "city", "country").orderBy(F.desc("batch_id"))
    return history.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def _settle(draft: Draft, batch_id: int, delay_us: int) -> None:
    """Move windows that no later micro-batch can touch to the final table.

    A micro-batch drops what ended before the watermark of the one before it,
    which follows the readings of the batches up to two back. The newest window of a
    batch starts at its newest reading's 5-minute mark, so windows that end
    ``delay`` before the newest start of those batches are final. Whole days move, so a
    day's windows are written once, to a few files."""
    d, spark = draft.details, draft.spark
    starts = [b["newest_start"] for b in d["open"] if b["batch_id"] <= batch_id - 2] + [d.get("newest_start")]
    newest = max((x for x in starts if x is not None), default=None)
    if newest is None:
        return
    d["newest_start"] = newest
    until = (newest - delay_us) // DAY_US * DAY_US
    since = d.get("settled_until")
    if since is not None and until <= since:
        return
    touched = [b for b in d["open"] if b["first_end"] <= until]
    if touched:
        end = F.unix_micros("window_end")
        settled = _open_windows(spark, Manifest(draft.root, 0, {}, d), touched).where(end <= until)
        if since is not None:
            settled = settled.where(end > since)
        (settled.drop("batch_id").withColumn("day", F.to_date(F.col("window_end") - F.expr("INTERVAL 1 MICROSECOND")))
         .hint("rebalance", "day").write.partitionBy("day").parquet(draft.part("final")))
    d["settled_until"] = until
    d["open"] = [b for b in d["open"] if b["last_end"] > until]


def make_batch_writer(out_dir: str, snapshot_mode: str = "batch", checkpoint_location: str | None = None,
                      settle_after: str | None = None, metrics: BatchMetrics | None = None):
    """``foreachBatch`` callback.

    Per non-empty micro-batch: the updated windows go to
    ``history/stream=ID/batch_id=N`` (overwritten, so a replayed batch leaves
    the history unchanged; another stream's output is refused), the snapshot
    (latest window per city) to a folder of its own, and one manifest commits
    both. ``snapshot_mode="batch"`` keeps only cities this batch
    touched (as the reference does); ``"merge"`` folds in the previous
    snapshot so quiet cities stay, and a window emitted again replaces its
    previous row (:mod:`airlens.streaming.latest` keeps them as state instead).

    ``settle_after`` (the stream's watermark delay): days that lie behind the watermark
    move once to a final table, partitioned by day, and leave the history, so
    readers rank open windows only. ``metrics`` gets each batch's counts.
    """
    if snapshot_mode not in ("batch", "merge"):
        raise ValueError(f"snapshot_mode must be 'batch' or 'merge', not {snapshot_mode!r}")
    root = out_dir.rstrip("/")

    def write_batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            if df.isEmpty():
                return
            spark = df.sparkSession
            stream = stream_identity(spark, checkpoint_location)
            history = claim(spark, f"{root}/history", stream)
            draft = Draft(spark, root)
            seen = Observation(f"airlens_windows_{batch_id}")
            windows = df.observe(
                seen, F.count(F.lit(1)).alias("windows"), F.max(F.unix_micros("window_start")).alias("newest_start"),
                F.min(F.unix_micros("window_end")).alias("first_end"), F.max(F.unix_micros("window_end")).alias("last_end"))
            windows.write.mode("overwrite").parquet(f"{history}/batch_id={batch_id}")
            snap = speed_snapshot(df)
            if snapshot_mode == "merge" and draft.before and draft.before.path("snapshot"):
                prev = spark.read.schema(snap.schema).json(draft.before.path("snapshot"))
                both = snap.withColumn("_age", F.lit(0)).unionByName(prev.withColumn("_age", F.lit(1)))
                snap = latest_windows(both, ties=[F.col("_age")]).select(*SNAPSHOT_COLUMNS)
            # Metrics ride along with the write (no second pass over the snapshot).
            tracked = Observation(f"airlens_snapshot_{batch_id}")
            snap = snap.observe(tracked, F.count(F.lit(1)).alias("cities"),
                                F.count_if(F.col("dangerous")).alias("dangerous_cities"))
            snap.write.mode("overwrite").json(draft.folder("snapshot"))
            m, w = tracked.get, seen.get
            gone = draft.details.pop("gone", [])
            draft.details["stream"] = stream
            if settle_after:
                open_ = [b for b in draft.details.get("open", []) if b["batch_id"] != batch_id]
                draft.details["open"] = [*open_, {"batch_id": batch_id, **{k: w[k] for k in ("newest_start", "first_end", "last_end")}}]
                before = {b["batch_id"] for b in draft.details["open"]}
                _settle(draft, batch_id, _microseconds(settle_after))
                draft.details["gone"] = sorted(before - {b["batch_id"] for b in draft.details["open"]})
            draft.commit()
            for b in gone:                      # no kept manifest needs them any more
                hpath, fs = file_system(spark, f"{history}/batch_id={b}")
                fs.delete(hpath, True)
            if metrics:
                metrics.note(batch_id, windows=w["windows"], **m)
            log.info("batch %s: %s cities tracked, %s dangerous now", batch_id, m["cities"], m["dangerous_cities"])
        finally:
            df.unpersist()

    return write_batch


def _microseconds(interval: str) -> int:
    n, unit = interval.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1_000_000


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start(windowed: DataFrame, out_dir: str, checkpoint_location: str,
          trigger_seconds: int | None = DEFAULT_TRIGGER_SECONDS, available_now: bool = False,
          snapshot_mode: str = "batch", query_name: str | None = None,
          rocksdb_state: bool = False, state_partitions: int | None = None,
          settle_after: str | None = None, metrics: BatchMetrics | None = None) -> StreamingQuery:
    """Start the update-mode query. ``available_now`` processes what is
    there and stops; otherwise a processing-time trigger fires every
    ``trigger_seconds``. The checkpoint makes a restart resume where it
    stopped, and fixes the number of state partitions at the first start:
    ``state_partitions``, or the session's ``spark.sql.shuffle.partitions``.
    ``rocksdb_state`` keeps window state in RocksDB on local disk instead of
    the JVM heap, for many cities; it must be chosen before the first start.
    Both hold for this stream only: a stream takes its own copy of the
    session's settings when it starts, and the session gets its own back.
    ``settle_after`` and ``metrics`` as in :func:`make_batch_writer`."""
    own = {}
    if rocksdb_state:
        own["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    if state_partitions:
        own["spark.sql.shuffle.partitions"] = str(int(state_partitions))
    writer = (windowed.writeStream.outputMode("update")
              .foreachBatch(make_batch_writer(out_dir, snapshot_mode, checkpoint_location, settle_after, metrics))
              .option("checkpointLocation", checkpoint_location))
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_seconds:
        writer = writer.trigger(processingTime=f"{int(trigger_seconds)} seconds")
    if metrics:
        metrics.listen(windowed.sparkSession)
    query = start_with(writer, windowed.sparkSession, own)
    if metrics:
        metrics.follow(query)
    return query


_STARTING = threading.Lock()


def start_with(writer: DataStreamWriter, spark: SparkSession, own: dict[str, str]) -> StreamingQuery:
    """Start a stream with settings of its own; one start at a time borrows the session's."""
    with _STARTING:
        before = {k: spark.conf.get(k, None) for k in own}
        try:
            for k, v in own.items():
                spark.conf.set(k, v)
            return writer.start()
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_final(windows: DataFrame, out_dir: str, checkpoint_location: str,
                trigger_seconds: int | None = DEFAULT_TRIGGER_SECONDS, available_now: bool = False,
                query_name: str | None = None) -> StreamingQuery:
    """Write :func:`airlens.operators.windows.final_windows` in append mode to
    ``final``, partitioned by the day a window ends in. The file sink's log names the
    files of finished micro-batches, so a restart adds each window once."""
    day = F.to_date(F.col("window_end") - F.expr("INTERVAL 1 MICROSECOND"))
    writer = (windows.withColumn("day", day).writeStream.outputMode("append").format("parquet").partitionBy("day")
              .option("path", f"{out_dir.rstrip('/')}/final").option("checkpointLocation", checkpoint_location))
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger_seconds:
        writer = writer.trigger(processingTime=f"{int(trigger_seconds)} seconds")
    return writer.start()


def read_final(spark: SparkSession, out_dir: str, day=None) -> DataFrame:
    """Windows that :func:`start_final` has written; of one ``day`` (a date), only
    its folder is read."""
    df = spark.read.schema(FINAL).parquet(f"{out_dir.rstrip('/')}/final")
    df = df if day is None else df.where(F.col("day") == F.lit(day))
    return df.drop("day")


def run_for(query: StreamingQuery, seconds: float | None = None) -> None:
    """Block until the query ends, or stop it after ``seconds``."""
    if seconds:
        query.awaitTermination(seconds)
        query.stop()
    else:
        query.awaitTermination()


def read_history(spark: SparkSession, out_dir: str, latest_only: bool = True, day=None) -> DataFrame:
    """Window rows written so far; with ``latest_only`` each window's most
    recent emission (update mode re-emits a window whenever it changes).
    Window keys have high cardinality, so the rank shuffles evenly.

    Of a stream that settles its history, the windows of settled days come from
    the final table as they are, and only micro-batches with open windows are
    ranked; emissions that were replaced before a day settled are gone. ``day`` (a
    date) gives the windows that end in it and reads only its part of the final table."""
    root = out_dir.rstrip("/")
    commit = current(spark, root)
    if commit is None or "open" not in commit.details:
        hist = spark.read.parquet(f"{root}/history").drop("stream")
        hist = _newest_emission(hist) if latest_only else hist
    else:
        d, parts = commit.details, []
        if commit.views.get("final"):
            settled = spark.read.schema(FINAL).option("basePath", f"{root}/final").parquet(*commit.paths("final")).drop("v")
            settled = settled if day is None else settled.where(F.col("day") == F.lit(day))
            parts.append(settled.drop("day"))
        if d["open"] or not parts:
            end = F.unix_micros("window_end")
            open_ = _open_windows(spark, commit, d["open"]).drop("batch_id")
            parts.append(open_ if d.get("settled_until") is None else open_.where(end > d["settled_until"]))
        hist = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if day is not None:
        hist = hist.where(F.to_date(F.col("window_end") - F.expr("INTERVAL 1 MICROSECOND")) == F.lit(day))
    return hist


def read_snapshot(spark: SparkSession, out_dir: str) -> DataFrame:
    from airlens.sources.files import load_speed_snapshot

    return load_speed_snapshot(spark, out_dir)
