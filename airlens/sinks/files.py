"""Sinks: raw readings (JSON lines or keyed records), batch views, the
serving view."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from airlens.functions.common import record_key
from airlens.sources.files import EMPTY_PARTITION
from airlens.sources.appends import commit_append, discard, recover
from airlens.sources.manifest import Draft

SINK_KINDS = ("local", "kafka")


def keyed_records(readings: DataFrame) -> DataFrame:
    """(key, value) rows, the shape a keyed stream sink (Kafka) takes:
    key = city, else a non-zero location id, else 'unknown'; value = the
    record as one JSON object."""
    return readings.select(
        record_key("city", "location_id").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in readings.columns])).alias("value"),
    )


def _write_counted(df: DataFrame, write) -> int:
    obs = Observation("airlens_sink")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    write(observed)
    return int(obs.get["rows"])


def write_readings(df: DataFrame, kind: str, directory: str | None = None,
                   topic: str | None = None, **options) -> int:
    """Append readings to a sink and return how many were written.

    ``local``: JSON lines under ``directory``; every write adds new part
    files and an empty frame writes nothing. The plan runs once: files are
    written beside ``directory`` and appended to it, all or none of them
    (:mod:`airlens.sources.appends`), if they hold any row.
    ``kafka``: keyed records to ``topic`` (needs the Kafka connector on the
    classpath; options such as ``kafka.bootstrap.servers`` pass through).
    Anything else: ValueError.
    """
    if kind not in SINK_KINDS:
        raise ValueError(f"Unknown sink kind: {kind!r} (expected one of {SINK_KINDS})")
    if kind == "local":
        if not directory:
            raise ValueError("the local sink needs a directory")
        staging = f"{directory.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"
        written = _write_counted(df, lambda d: d.write.json(staging))
        if written:
            recover(df.sparkSession, directory)
            commit_append(df.sparkSession, staging, directory)
        else:
            discard(df.sparkSession, staging)
        return written
    keyed = keyed_records(df)
    return _write_counted(keyed, lambda d: d.write.format("kafka").options(**options)
                          .option("topic", topic).save())


def write_hourly_view(hourly: DataFrame, folder: str) -> None:
    """Write the hourly view to ``folder``, partitioned by country; an empty
    country is written as a sentinel so that it reads back as "". The
    rebalance gives a country few files, and AQE splits a large country over
    several tasks."""
    part = F.when(F.col("country") == "", F.lit(EMPTY_PARTITION)).otherwise(F.col("country"))
    (hourly.withColumn("country", part).hint("rebalance", "country")
     .write.mode("overwrite").partitionBy("country").parquet(folder))


def write_summary_view(summary: DataFrame, folder: str) -> None:
    summary.write.mode("overwrite").parquet(folder)


def write_views(hourly: DataFrame, summary: DataFrame, batch_view_dir: str) -> None:
    """Commit both batch views together."""
    draft = Draft(hourly.sparkSession, batch_view_dir)
    write_hourly_view(hourly, draft.folder("hourly_city_aqi"))
    write_summary_view(summary, draft.folder("city_summary"))
    draft.commit()


def write_serving_view(serving: DataFrame, out_dir: str) -> None:
    draft = Draft(serving.sparkSession, out_dir)
    serving.write.mode("overwrite").json(draft.folder("serving_view"))
    draft.commit()
