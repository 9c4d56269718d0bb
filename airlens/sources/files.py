"""File sources: raw readings, raw API documents, the batch and speed views,
and the country quota list."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from airlens.schemas import HOURLY, LATEST, LOCATION, QUOTA, QUOTA_FILE, READING, SNAPSHOT, SUMMARY
from airlens.sources.appends import commit_append, discard, recover
from airlens.sources.manifest import current

# Written in place of an empty-string partition value (Hive would turn ""
# into its default partition and read it back as NULL).
EMPTY_PARTITION = "__EMPTY__"

# The default country priority list, its per-country limits,
# and the overall cap of the station discovery.
DEFAULT_QUOTAS = [
    (1, "IE", "Ireland", 15),
    (2, "GB", "United Kingdom", 15),
    (3, "US", "United States", 20),
    (4, "IN", "India", 20),
    (5, "CN", "China", 15),
    (6, "PK", "Pakistan", 10),
    (7, "BD", "Bangladesh", 10),
    (8, "NG", "Nigeria", 10),
    (9, "BR", "Brazil", 10),
    (10, "AU", "Australia", 10),
    (11, "DE", "Germany", 10),
    (12, "ZA", "South Africa", 5),
]
DEFAULT_MAX_LOCATIONS = 150
DEFAULT_COUNTRY_LIMIT = 10


def read_readings(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Raw readings under ``path`` (any depth). Permissive: a malformed line
    is an all-NULL row, a bad field a NULL field."""
    recover(spark, path)
    return (spark.read.schema(READING).option("recursiveFileLookup", "true")
            .option("mode", "PERMISSIVE").format(fmt).load(path))


CORRUPT = "_corrupt_line"


def quarantine_readings(spark: SparkSession, path: str, quarantine_dir: str) -> tuple[DataFrame, dict[str, int]]:
    """Readings under ``path`` without the lines that are no JSON object of the
    reading schema (a field of the wrong type included), and the counts ``lines`` and
    ``malformed``. Each malformed line is appended to ``quarantine_dir`` as (line,
    file, quarantined_at), all or none of them; the counts come with that write, so
    the files are scanned once for it. A blank line is no line."""
    recover(spark, path)
    schema = StructType([*READING.fields, StructField(CORRUPT, StringType(), True)])
    lines = spark.read.option("recursiveFileLookup", "true").text(path).where("trim(value) <> ''")
    record = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = lines.select("value", F.col("_metadata.file_path").alias("file"), record.alias("r"))
    malformed = ~F.col("value").rlike(r"^\s*\{") | F.col(f"r.{CORRUPT}").isNotNull()
    counts = Observation("airlens_quarantine")
    bad = (parsed.withColumn("bad", malformed)
           .observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if("bad").alias("malformed"))
           .where("bad").select(F.col("value").alias("line"), "file", F.current_timestamp().alias("quarantined_at")))
    staging = f"{quarantine_dir.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"
    bad.write.json(staging)
    found = {k: int(v) for k, v in counts.get.items()}
    if found["malformed"]:
        recover(spark, quarantine_dir)
        commit_append(spark, staging, quarantine_dir)
    else:
        discard(spark, staging)
    return parsed.where(~malformed).select("r.*").drop(CORRUPT), found


def read_quarantine(spark: SparkSession, quarantine_dir: str) -> DataFrame:
    """(line, file, quarantined_at) of every malformed line put aside."""
    recover(spark, quarantine_dir)
    return spark.read.schema("line string, file string, quarantined_at timestamp").json(quarantine_dir)


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """Landed station documents (one JSON object per line)."""
    return spark.read.schema(LOCATION).option("recursiveFileLookup", "true").json(path)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """Landed latest-value entries, each with its ``location_id``."""
    return spark.read.schema(LATEST).option("recursiveFileLookup", "true").json(path)


def country_quotas(spark: SparkSession, rows=None) -> DataFrame:
    """(ord, iso, label, quota) in priority order; a small config table."""
    return spark.createDataFrame(rows if rows is not None else DEFAULT_QUOTAS, QUOTA)


def read_quotas(spark: SparkSession, path: str) -> tuple[DataFrame, Column]:
    """(quotas, cap) of a landed config file: one JSON document with
    ``max_locations`` and ``countries``, a list of (iso, label, limit). The list
    order is the priority; a country without a limit gets ``DEFAULT_COUNTRY_LIMIT``, a
    document without a cap ``DEFAULT_MAX_LOCATIONS``. Both are read by the plan that
    uses them (the cap is a scalar subquery), not while it is built."""
    doc = spark.read.schema(QUOTA_FILE).option("multiLine", "true").json(path)
    rows = doc.select(F.posexplode("countries").alias("at", "c")).select(
        (F.col("at") + 1).alias("ord"), F.col("c.iso").alias("iso"), F.col("c.label").alias("label"),
        F.coalesce(F.col("c.limit"), F.lit(DEFAULT_COUNTRY_LIMIT)).alias("quota"))
    cap = F.coalesce(doc.select(F.max("max_locations")).scalar(), F.lit(DEFAULT_MAX_LOCATIONS))
    return rows, cap


def read_hourly_view(spark: SparkSession, batch_view_dir: str) -> DataFrame:
    """The hourly view, with the empty-country partition mapped back. Read
    with the declared schema, so a country code that looks like a number
    stays a string (partition values are otherwise type-inferred)."""
    commit = current(spark, batch_view_dir)
    return hourly_view(spark, commit.path("hourly_city_aqi") if commit else f"{batch_view_dir.rstrip('/')}/hourly_city_aqi")


def hourly_view(spark: SparkSession, path: str) -> DataFrame:
    """The hourly view in one folder, committed or not."""
    df = spark.read.schema(HOURLY).parquet(path)
    country = F.when(F.col("country") == EMPTY_PARTITION, F.lit("")).otherwise(F.col("country"))
    return df.withColumn("country", country).select(
        "city", "country", "hour", "dominant_pollutant", "aqi", "reading_count", "dangerous")


def load_batch_summary(spark: SparkSession, batch_view_dir: str) -> DataFrame:
    """The city summary, or an empty frame of the same shape."""
    commit = current(spark, batch_view_dir)
    path = commit and commit.path("city_summary")
    return spark.read.schema(SUMMARY).parquet(path) if path else spark.createDataFrame([], SUMMARY)


def load_batch_views(spark: SparkSession, batch_view_dir: str) -> tuple[DataFrame, DataFrame] | None:
    """(hourly view, city summary) of one run of the batch job; None before the first."""
    commit = current(spark, batch_view_dir)
    if commit is None:
        return None
    return hourly_view(spark, commit.path("hourly_city_aqi")), spark.read.schema(SUMMARY).parquet(commit.path("city_summary"))


def load_speed_snapshot(spark: SparkSession, speed_view_dir: str) -> DataFrame:
    """The latest speed snapshot, or an empty frame of the same shape."""
    commit = current(spark, speed_view_dir)
    path = commit and commit.path("snapshot")
    return spark.read.schema(SNAPSHOT).json(path) if path else spark.createDataFrame([], SNAPSHOT)
