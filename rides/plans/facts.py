"""Fact tables.

Each fact is computed from a small materialized aggregate of the trips (see
``rides.plans.aggregates``) and joins its dimensions *after* aggregating: the
dimensions are unique on the join key and built from the same trips, so the
inner join at the aggregate's grain gives the same rows as joining every
trip. Pass ``counts`` / ``hist`` to share one aggregate between facts; when
omitted, the fact takes and materializes its own from ``trips``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rides.functions.calendar import minutes_from_micros_sql
from rides.operators.monthly import month_over_month
from rides.operators.percentiles import stats_from_histogram
from rides.operators.ranking import rank_within
from rides.operators.rolling import rolling_stats, zscore_flag_sql
from rides.plans.aggregates import daily_station_counts, duration_histogram, materialize
from rides.plans.dimensions import (as_of, dim_date_from_dates, dim_stations_from,
                                    dim_stations_history, dim_time_from_hours)

# The reported duration percentiles, the rolling frames (rows)
# and the anomaly rule (population z-score over the long frame).
DURATION_PERCENTILES = {"median_duration_minutes": 0.5, "p25_duration_minutes": 0.25,
                        "p75_duration_minutes": 0.75}
SHORT_FRAME_ROWS = 7
LONG_FRAME_ROWS = 30
ANOMALY_Z = 3.0


def _counts(trips, counts):
    return counts if counts is not None else materialize(daily_station_counts(trips), "counts")


def fct_popular_stations_by_weekday(trips: DataFrame | None = None,
                                    dates: DataFrame | None = None,
                                    stations: DataFrame | None = None,
                                    counts: DataFrame | None = None) -> DataFrame:
    """(station_id, station_name, weekday) -> total_trips, station_rank.

    RANK() per weekday by total_trips descending: ties share a rank and the
    next rank skips. A station id with two names joins both names (N:M), as in
    the source rule; the NULL-station group finds no dimension row and drops.
    The joins are between aggregates; AQE broadcasts a side only after its
    measured size is under the threshold and keeps a shuffle join otherwise.
    """
    counts = _counts(trips, counts)
    dates = dates if dates is not None else dim_date_from_dates(counts)
    stations = stations if stations is not None else dim_stations_from(counts)
    day = dates.selectExpr("ride_date as trip_date", "weekday")
    swc = (counts.join(day, "trip_date")
                 .groupBy("start_station_id", "weekday")
                 .agg(F.expr("cast(sum(trips) as bigint) as total_trips")))
    joined = (swc.join(stations.withColumnRenamed("station_id", "start_station_id"),
                       "start_station_id")
                 .selectExpr("start_station_id as station_id", "station_name", "weekday",
                             "total_trips"))
    return rank_within(joined, ["weekday"], "total_trips", name="station_rank")


def fct_popular_stations_one_name(trips: DataFrame | None = None, counts: DataFrame | None = None) -> DataFrame:
    """The popularity fact with one name for each station id: trips are counted
    under the name that held on their day (``dim_stations_history``), so an id
    with several names neither doubles its trips nor its rank."""
    counts = _counts(trips, counts)
    history = dim_stations_history(counts)
    per_day = (counts.where("start_station_id is not null").groupBy("start_station_id", "trip_date")
                     .agg(F.expr("sum(trips) as trips")))
    dates = dim_date_from_dates(counts).selectExpr("ride_date as trip_date", "weekday")
    totals = (as_of(per_day, history, "start_station_id", "trip_date").join(dates, "trip_date")
              .groupBy(F.expr("start_station_id as station_id"), "station_name", "weekday")
              .agg(F.expr("cast(sum(trips) as bigint) as total_trips")))
    return rank_within(totals, ["weekday"], "total_trips", name="station_rank")


def fct_trip_duration_by_hour(trips: DataFrame | None = None, times: DataFrame | None = None,
                              hist: DataFrame | None = None) -> DataFrame:
    """(start_hour, time_of_day_category, rider_type) -> trips_count, average,
    median, p25 and p75 of duration in minutes (exact, interpolated).

    ``dim_time`` has at most 24 rows (hours 0-23), a proven bound, so it is
    broadcast explicitly.
    """
    hist = hist if hist is not None else materialize(duration_histogram(trips), "durations")
    times = times if times is not None else dim_time_from_hours(hist)
    stats = stats_from_histogram(hist, ["start_hour", "rider_type"], "duration_us", "trips",
                                 minutes_from_micros_sql, DURATION_PERCENTILES,
                                 count_name="trips_count", mean_name="avg_duration_minutes")
    return (stats.join(F.broadcast(times.withColumnRenamed("hour", "start_hour")), "start_hour")
                 .select("start_hour", "time_of_day_category", "rider_type", "trips_count",
                         "avg_duration_minutes", "median_duration_minutes",
                         "p25_duration_minutes", "p75_duration_minutes"))


def daily_counts(trips: DataFrame | None = None, dates: DataFrame | None = None,
                 counts: DataFrame | None = None) -> DataFrame:
    """ride_date -> daily_trips, for dates present in the date dimension. A
    dimension made from the same counts holds every date, so the join is only
    needed when ``dates`` is given."""
    counts = _counts(trips, counts)
    per_day = (counts.where("trip_date is not null").groupBy(F.expr("trip_date as ride_date"))
                     .agg(F.expr("cast(sum(trips) as bigint) as daily_trips")))
    return per_day if dates is None else per_day.join(dates.select("ride_date"), "ride_date")


def fct_daily_trip_trends(trips: DataFrame | None = None, dates: DataFrame | None = None,
                          counts: DataFrame | None = None) -> DataFrame:
    """One row per observed date: counts, 7/30-row rolling averages, month
    totals with the previous observed month, season and a z-score anomaly
    flag over the 30-row frame that includes the current row.

    The rolling and lag windows are unpartitioned; their input has one row
    per date (or month), bounded by the calendar span, not by trips.
    """
    counts = _counts(trips, counts)
    dates = dates if dates is not None else dim_date_from_dates(counts)
    # One row per date: the rolling and LAG windows need the whole series in
    # one partition anyway, so the finished counts are put there once; the
    # month aggregate, the windows and the joins then need no further shuffles.
    per_day = daily_counts(dates=dates, counts=counts).repartition(1)
    rolling = rolling_stats(per_day, "ride_date", "daily_trips",
                            {"avg_7d_trips": SHORT_FRAME_ROWS, "avg_30d_trips": LONG_FRAME_ROWS},
                            {"stddev_30d_trips": LONG_FRAME_ROWS})
    monthly = month_over_month(per_day, "ride_date", "daily_trips")
    return (rolling.withColumn("month_start", F.expr("trunc(ride_date, 'month')"))
                   .join(monthly, "month_start")
                   .join(dates.select("ride_date", "season"), "ride_date")
                   .selectExpr("ride_date", "daily_trips", "avg_7d_trips", "avg_30d_trips",
                               "month_total", "prev_month_total", "mom_percent_change", "season",
                               f"{zscore_flag_sql('daily_trips', 'avg_30d_trips', 'stddev_30d_trips', ANOMALY_Z)}"
                               " as is_anomaly"))
