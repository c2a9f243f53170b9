"""Declared schemas. Nothing in the package infers types from data."""

from pyspark.sql import types as T

# Raw trip columns as the loaders deliver them; station ids stay text.
RAW_COLUMNS = [
    ("ride_id", T.StringType()),
    ("rideable_type", T.StringType()),
    ("started_at", T.TimestampNTZType()),
    ("ended_at", T.TimestampNTZType()),
    ("start_station_name", T.StringType()),
    ("start_station_id", T.StringType()),
    ("end_station_name", T.StringType()),
    ("end_station_id", T.StringType()),
    ("start_lat", T.DoubleType()),
    ("start_lng", T.DoubleType()),
    ("end_lat", T.DoubleType()),
    ("end_lng", T.DoubleType()),
    ("member_casual", T.StringType()),
]

RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_COLUMNS])

# With the lineage column every loader adds.
RAW_WITH_FILE = T.StructType(RAW_SCHEMA.fields + [T.StructField("filename", T.StringType(), True)])

RAW_NAMES = [n for n, _ in RAW_COLUMNS]
