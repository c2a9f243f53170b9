"""Column functions. Each returns a JVM-side ``Column``; none is a Python UDF."""

from rides.functions.calendar import (
    duration_micros, duration_minutes, minutes_from_micros, season, start_hour, time_of_day, trip_date,
    weekday_name, weekday_num, weekday_type,
)
from rides.functions.geo import haversine_km
from rides.functions.keys import surrogate_key

__all__ = [
    "duration_micros", "duration_minutes", "haversine_km", "minutes_from_micros", "season", "start_hour", "surrogate_key",
    "time_of_day", "trip_date", "weekday_name", "weekday_num", "weekday_type",
]
