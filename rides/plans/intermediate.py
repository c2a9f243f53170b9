"""Intermediate: staging plus calendar parts, distance and duration."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rides.functions import calendar as C
from rides.functions.geo import haversine_sql


def int_trips(stg: DataFrame) -> DataFrame:
    """One row per staging row (a pure projection, no shuffle)."""
    tail = [c for c in ("ingestion_ts", "source_file") if c in stg.columns]
    return stg.selectExpr(
        "trip_sk", "ride_id", "rideable_type", "start_ts", "end_ts",
        f"{C.trip_date_sql('start_ts')} as trip_date",
        f"{C.start_hour_sql('start_ts')} as start_hour",
        f"{C.weekday_num_sql('start_ts')} as weekday_num",
        f"{C.weekday_type_sql(C.weekday_num_sql('start_ts'))} as weekday_type",
        "start_station_id", "start_station_name", "start_lat", "start_lng",
        "end_station_id", "end_station_name", "end_lat", "end_lng",
        "member_casual",
        f"{haversine_sql('start_lat', 'start_lng', 'end_lat', 'end_lng')} as trip_distance_km",
        f"{C.duration_minutes_sql('start_ts', 'end_ts')} as duration_minutes",
        *tail,
    )
