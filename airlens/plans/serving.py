"""The serving job: batch summary ⟕ speed snapshot -> serving view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airlens.operators.serving import merge_views
from airlens.sinks.files import write_serving_view
from airlens.sources.files import load_batch_summary, load_speed_snapshot
from airlens.sources.manifest import current


def build_and_write_serving_view(spark: SparkSession, batch_view_dir: str, speed_view_dir: str,
                                 out_dir: str) -> DataFrame:
    """Merge the views, commit ``out_dir``'s next serving view and return it as
    written. An empty snapshot gives an empty 16-column view; a
    missing summary gives NULL history columns."""
    merged = merge_views(load_batch_summary(spark, batch_view_dir),
                         load_speed_snapshot(spark, speed_view_dir))
    write_serving_view(merged, out_dir)
    return spark.read.schema(merged.schema).json(current(spark, out_dir).path("serving_view"))
