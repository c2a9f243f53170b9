"""Dimensions: DISTINCTs over the trips.

Each has a standalone form over trips and a form over the small aggregates
of ``rides.plans.aggregates``, which ``build`` uses so that one scan of the
trips feeds every dimension and fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rides.functions import calendar as C


def dim_date_from_dates(dates: DataFrame, date_col: str = "trip_date") -> DataFrame:
    """ride_date, day, ISO week, month, year, weekday name, season."""
    return (dates.selectExpr(f"{date_col} as ride_date").distinct()
                 .selectExpr("ride_date",
                             "cast(dayofmonth(ride_date) as bigint) as day",
                             "cast(weekofyear(ride_date) as bigint) as week",
                             "cast(month(ride_date) as bigint) as month",
                             "cast(year(ride_date) as bigint) as year",
                             f"{C.weekday_name_sql('ride_date')} as weekday",
                             f"{C.season_sql('month(ride_date)')} as season"))


def dim_date(trips: DataFrame) -> DataFrame:
    """One row per observed trip date."""
    return dim_date_from_dates(trips.select("trip_date"))


def dim_stations_from(pairs: DataFrame) -> DataFrame:
    return (pairs.where("start_station_id is not null")
                 .selectExpr("start_station_id as station_id", "start_station_name as station_name")
                 .distinct())


def dim_stations(trips: DataFrame) -> DataFrame:
    """One row per (station_id, station_name) pair: an id seen with two names
    appears twice, as in the source rule."""
    return dim_stations_from(trips.select("start_station_id", "start_station_name"))


def dim_time_from_hours(hours: DataFrame, hour_col: str = "start_hour") -> DataFrame:
    return (hours.selectExpr(f"{hour_col} as hour").distinct()
                 .selectExpr("hour", f"{C.time_of_day_sql('hour')} as time_of_day_category"))


def dim_time(trips: DataFrame) -> DataFrame:
    """One row per observed start hour (at most 24)."""
    return dim_time_from_hours(trips)


def dim_stations_history(counts: DataFrame) -> DataFrame:
    """One name for each station id and day: (station_id, station_name,
    valid_from, valid_to), from the daily counts.

    The name of a day is the one with most trips that day (ties: the smallest;
    no name only where the day has no other). A row spans the days from the
    first that has its name to the day before the first that has another; the
    last row of an id has no end."""
    per_day = (counts.where("start_station_id is not null and trip_date is not null")
                     .groupBy(F.expr("start_station_id as station_id"), "trip_date")
                     .agg(F.min(F.struct(-F.col("trips"), F.col("start_station_name").isNull(),
                                         F.col("start_station_name").alias("name"))).alias("best"))
                     .selectExpr("station_id", "trip_date", "best.name as station_name"))
    days = Window.partitionBy("station_id").orderBy("trip_date")
    starts = (per_day.withColumn("before", F.lag("station_name").over(days))
                     .withColumn("is_first", F.row_number().over(days) == 1)
                     .where("is_first or not (station_name <=> before)"))
    return starts.select("station_id", "station_name", F.col("trip_date").alias("valid_from"),
                         F.date_sub(F.lead("trip_date").over(days), 1).alias("valid_to"))


def as_of(facts: DataFrame, history: DataFrame, key: str, date_col: str) -> DataFrame:
    """``facts`` with the station name that holds on ``date_col``: at most one
    row of the history fits, so no row is doubled."""
    h = history.withColumnRenamed("station_id", "_id")
    fits = ((F.col(key) == F.col("_id")) & (F.col(date_col) >= F.col("valid_from"))
            & (F.col("valid_to").isNull() | (F.col(date_col) <= F.col("valid_to"))))
    return facts.join(h, fits).drop("_id", "valid_from", "valid_to")
