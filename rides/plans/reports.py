"""The six reports. Each takes a fact DataFrame and returns an ordered one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rides.functions.calendar import weekday_order_sql
from rides.functions.numeric import round_half_away_sql


def _asc(*cols: str):
    """Ascending with NULLs last, the order SQL engines such as DuckDB use
    (Spark's default puts NULLs first)."""
    return [F.expr(c).asc_nulls_last() for c in cols]


def rpt_all_stations_by_weekday(popular: DataFrame) -> DataFrame:
    """Full ranking per weekday (weekday names sort alphabetically)."""
    return (popular.select("weekday", "station_name", "total_trips", "station_rank")
                   .orderBy(*_asc("weekday", "station_rank")))


def rpt_top_station_by_weekday(popular: DataFrame) -> DataFrame:
    """Rank-1 stations per weekday (ties kept), Monday first."""
    return (popular.where("station_rank = 1")
                   .select("weekday", "station_name", "total_trips", "station_rank")
                   .orderBy(*_asc(weekday_order_sql("weekday"))))


def rpt_daily_rolling(trends: DataFrame) -> DataFrame:
    return (trends.selectExpr("ride_date", "daily_trips",
                              f"{round_half_away_sql('avg_7d_trips', 1)} as avg_7d_trips",
                              f"{round_half_away_sql('avg_30d_trips', 1)} as avg_30d_trips",
                              "is_anomaly")
                  .orderBy(*_asc("ride_date")))


def rpt_hourly_duration(durations: DataFrame) -> DataFrame:
    return (durations.selectExpr(
                "start_hour", "time_of_day_category", "rider_type", "trips_count",
                f"{round_half_away_sql('avg_duration_minutes', 2)} as avg_duration_minutes",
                f"{round_half_away_sql('median_duration_minutes', 2)} as median_duration_minutes")
            .orderBy(*_asc("start_hour", "rider_type")))


def rpt_monthly_trends(trends: DataFrame) -> DataFrame:
    """Month totals are constant within a month, so MAX picks them up."""
    return (trends.groupBy(F.expr("trunc(ride_date, 'month') as month"))
                  .agg(F.expr("max(month_total) as total_rides_in_month"),
                       F.expr("max(mom_percent_change) as mom_change_percentage"))
                  .orderBy(*_asc("month")))


def rpt_rush_hour_gap(durations: DataFrame, category: str = "Rush Hour") -> DataFrame:
    """Member and casual medians side by side and casual - member (NULL if
    either is missing)."""
    member = "max(case when rider_type = 'member' then median_duration_minutes end)"
    casual = "max(case when rider_type = 'casual' then median_duration_minutes end)"
    return (durations.where(F.col("time_of_day_category") == category)
                     .groupBy("start_hour", "time_of_day_category")
                     .agg(F.expr(f"{member} as member_median_duration"),
                          F.expr(f"{casual} as casual_median_duration"),
                          F.expr(f"{casual} - {member} as duration_difference"))
                     .orderBy(*_asc("start_hour")))
