"""The six declared schemas: raw reading, the two raw API documents, and
the batch / speed views."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The wire format. Field names, order and types of the readings, of
# the API documents and of the views below are what producers and consumers share.

# One pollutant value at one location and one instant, flat.
READING = StructType([
    StructField("location_id", IntegerType(), True),
    StructField("location_name", StringType(), True),
    StructField("city", StringType(), True),
    StructField("country", StringType(), True),
    StructField("latitude", DoubleType(), True),
    StructField("longitude", DoubleType(), True),
    StructField("pollutant", StringType(), True),
    StructField("value", DoubleType(), True),
    StructField("unit", StringType(), True),
    StructField("datetime_utc", StringType(), True),
    StructField("ingested_at", StringType(), True),
    StructField("aqi_sub_index", DoubleType(), True),
])
READING_COLUMNS = READING.fieldNames()

# A station document as the air-quality API lists it.
LOCATION = StructType([
    StructField("id", LongType(), True),
    StructField("name", StringType(), True),
    StructField("locality", StringType(), True),
    StructField("country", StructType([
        StructField("code", StringType(), True),
        StructField("name", StringType(), True),
    ]), True),
    StructField("coordinates", StructType([
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
    ]), True),
    StructField("sensors", ArrayType(StructType([
        StructField("id", LongType(), True),
        StructField("parameter", StructType([
            StructField("name", StringType(), True),
            StructField("units", StringType(), True),
        ]), True),
    ])), True),
])

# One "latest value" entry of a station, keyed by the station it came from.
LATEST = StructType([
    StructField("location_id", LongType(), True),
    StructField("sensorsId", LongType(), True),
    StructField("value", DoubleType(), True),
    StructField("datetime", StructType([
        StructField("utc", StringType(), True),
    ]), True),
])

HOURLY = StructType([
    StructField("city", StringType(), True),
    StructField("country", StringType(), True),
    StructField("hour", TimestampType(), True),
    StructField("dominant_pollutant", StringType(), True),
    StructField("aqi", DoubleType(), True),
    StructField("reading_count", LongType(), False),
    StructField("dangerous", BooleanType(), True),
])

SUMMARY = StructType([
    StructField("city", StringType(), True),
    StructField("country", StringType(), True),
    StructField("hours_observed", LongType(), False),
    StructField("avg_aqi", DoubleType(), True),
    StructField("max_aqi", DoubleType(), True),
    StructField("max_aqi_at", TimestampType(), True),
    StructField("worst_pollutant", StringType(), True),
    StructField("pct_hours_dangerous", DoubleType(), True),
])

SNAPSHOT = StructType([
    StructField("city", StringType(), True),
    StructField("country", StringType(), True),
    StructField("aqi", DoubleType(), True),
    StructField("dominant_pollutant", StringType(), True),
    StructField("reading_count", LongType(), True),
    StructField("dangerous", BooleanType(), True),
    StructField("latitude", DoubleType(), True),
    StructField("longitude", DoubleType(), True),
    StructField("window_start", TimestampType(), True),
    StructField("window_end", TimestampType(), True),
    StructField("computed_at", TimestampType(), True),
])
SNAPSHOT_COLUMNS = SNAPSHOT.fieldNames()

WINDOW = StructType([
    StructField("window_start", TimestampType(), True),
    StructField("window_end", TimestampType(), True),
    StructField("city", StringType(), True),
    StructField("country", StringType(), True),
    StructField("aqi", DoubleType(), True),
    StructField("dominant_pollutant", StringType(), True),
    StructField("reading_count", LongType(), True),
    StructField("dangerous", BooleanType(), True),
    StructField("latitude", DoubleType(), True),
    StructField("longitude", DoubleType(), True),
])
WINDOW_COLUMNS = WINDOW.fieldNames()

SERVING_COLUMNS = SNAPSHOT_COLUMNS + [
    "historical_avg_aqi", "historical_max_aqi", "historical_worst_pollutant",
    "pct_hours_dangerous", "vs_historical_avg",
]

QUOTA = "ord int, iso string, label string, quota int"
# The landed station quota config: its list order is the priority.
QUOTA_FILE = "max_locations int, countries array<struct<iso: string, label: string, limit: int>>"
