"""The batch layer job: raw readings -> hourly view -> city summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airlens.operators.batch import city_summary, hourly_aqi, prepare
from airlens.session import ensure_utc
from airlens.sinks.files import write_hourly_view, write_summary_view
from airlens.sources.files import hourly_view, load_batch_views, read_readings
from airlens.sources.manifest import Draft


def run_batch(spark: SparkSession, out_path: str, raw_path: str | None = None,
              readings: DataFrame | None = None, rescore: bool = True) -> tuple[DataFrame, DataFrame]:
    """Compute both batch views anew, commit them together and return them as
    read back.

    The raw input is scanned once: the summary is computed from the written
    hourly view (not by re-running the hourly plan from raw), which also
    cuts the lineage, so a lost executor in the summary stage re-reads
    files instead of recomputing the scan and the shuffle.
    """
    ensure_utc(spark)
    if readings is None:
        readings = read_readings(spark, raw_path)
    hourly = hourly_aqi(prepare(readings, rescore=rescore), other_pollutants=not rescore)
    draft = Draft(spark, out_path)
    at = draft.folder("hourly_city_aqi")
    write_hourly_view(hourly, at)
    summary = city_summary(hourly_view(spark, at), other_pollutants=not rescore)
    write_summary_view(summary, draft.folder("city_summary"))
    draft.commit()
    return load_batch_views(spark, out_path)
