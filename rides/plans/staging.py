"""Staging: typed, keyed trips with non-negative durations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rides.functions.keys import surrogate_key_sql

# (output column, SQL expression over the raw columns)
STG_PROJECTION = [
    ("trip_sk", surrogate_key_sql("ride_id")),
    ("ride_id", "cast(ride_id as string)"),
    ("rideable_type", "cast(rideable_type as string)"),
    ("start_ts", "cast(started_at as timestamp_ntz)"),
    ("end_ts", "cast(ended_at as timestamp_ntz)"),
    ("start_station_name", "cast(start_station_name as string)"),
    ("start_station_id", "cast(start_station_id as string)"),
    ("end_station_name", "cast(end_station_name as string)"),
    ("end_station_id", "cast(end_station_id as string)"),
    ("start_lat", "cast(start_lat as double)"),
    ("start_lng", "cast(start_lng as double)"),
    ("end_lat", "cast(end_lat as double)"),
    ("end_lng", "cast(end_lng as double)"),
    ("member_casual", "cast(member_casual as string)"),
]
# Zero durations stay; a NULL start or end drops the row (the comparison is
# not true). Same test as "end - start >= 0 seconds" without an interval.
NON_NEGATIVE = "cast(ended_at as timestamp_ntz) >= cast(started_at as timestamp_ntz)"


def stg_trips(raw: DataFrame, include_ingestion_ts: bool = True) -> DataFrame:
    """Cast and rename the raw columns, add ``trip_sk``, keep end >= start."""
    cols = [f"{e} as {n}" for n, e in STG_PROJECTION]
    if include_ingestion_ts:
        cols.append("current_timestamp() as ingestion_ts")
    cols.append("cast(filename as string) as source_file")
    return raw.where(NON_NEGATIVE).selectExpr(*cols)
