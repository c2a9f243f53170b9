"""The declared data-quality suite over the models.

Counts per kind: 31 not_null, 6 unique, 3 accepted_values, 2 value-set,
2 relationships, 2 singular non-negative checks, 1 source freshness.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rides.functions.calendar import TIME_OF_DAY_LABELS
from rides.operators import quality as Q

# The declared checks (table -> columns).
NOT_NULL = {
    "stg_trips": ["trip_sk", "ride_id", "start_ts", "end_ts", "member_casual"],
    "int_trips": ["trip_sk", "trip_date", "start_hour", "duration_minutes"],
    "dim_stations": ["station_id", "station_name"],
    "dim_date": ["ride_date", "weekday", "season"],
    "dim_time": ["hour", "time_of_day_category"],
    "fct_popular_stations_by_weekday": ["station_id", "weekday", "total_trips", "station_rank"],
    "fct_trip_duration_by_hour": ["start_hour", "time_of_day_category", "rider_type",
                                  "trips_count", "avg_duration_minutes",
                                  "median_duration_minutes"],
    "fct_daily_trip_trends": ["ride_date", "daily_trips", "avg_7d_trips", "avg_30d_trips",
                              "is_anomaly"],
}
UNIQUE = [
    ("stg_trips", "trip_sk"), ("stg_trips", "ride_id"), ("int_trips", "trip_sk"),
    ("dim_date", "ride_date"), ("dim_time", "hour"), ("fct_daily_trip_trends", "ride_date"),
]
RIDER_TYPES = ["member", "casual"]
ACCEPTED = [
    ("stg_trips", "member_casual", RIDER_TYPES),
    ("dim_time", "time_of_day_category", list(TIME_OF_DAY_LABELS)),
    ("fct_daily_trip_trends", "is_anomaly", [0, 1]),
]
IN_SET = [
    ("fct_trip_duration_by_hour", "time_of_day_category", list(TIME_OF_DAY_LABELS)),
    ("fct_trip_duration_by_hour", "rider_type", RIDER_TYPES),
]
RELATIONSHIPS = [
    ("fct_popular_stations_by_weekday", "station_id", "dim_stations", "station_id"),
    ("fct_daily_trip_trends", "ride_date", "dim_date", "ride_date"),
]
FRESHNESS_WARN_AFTER_S = 86400         # 1 day
FRESHNESS_ERROR_AFTER_S = 2 * 86400    # 2 days
NONNEGATIVE = [
    ("fct_trip_duration_by_hour", "avg_duration_minutes"),
    ("fct_popular_stations_by_weekday", "total_trips"),
]


SMALL = [t for t in NOT_NULL if t.startswith(("dim_", "fct_"))]


def with_small_models_written(m: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``m`` with each dimension and fact written once in the shared folder,
    so that several checks of one do not compute it again."""
    from rides.plans.aggregates import materialize

    return m | {t: materialize(m[t], t) for t in SMALL}


def dq_not_null(m: dict[str, DataFrame]) -> DataFrame:
    return Q.union_all([Q.not_null(m[t], t, cols) for t, cols in NOT_NULL.items()])


def dq_not_null_saved(spark: SparkSession, tables: dict[str, list[str]]) -> DataFrame:
    """``dq_not_null`` of saved tables (table -> its Parquet files): the null
    counts stand in the file footers, so no row is read. A table without files
    has no row that could fail."""
    from rides.sources.footers import column_statistics

    wanted = spark.createDataFrame([(t, c) for t, cols in NOT_NULL.items() for c in cols if t in tables],
                                   "table_name string, column_name string")
    known = column_statistics(spark, tables).select("table_name", "column_name", "null_count", "row_count")
    return wanted.join(known, ["table_name", "column_name"], "left").select(
        F.lit("not_null").alias("check_name"), "table_name", "column_name",
        F.when(F.col("row_count").isNull(), F.lit(0).cast("long")).otherwise(
            F.coalesce("null_count", F.raise_error(F.lit("null count missing in a footer")).cast("long")))
        .alias("violations"))


def dq_unique(m: dict[str, DataFrame]) -> DataFrame:
    """The trip tables take one shuffle on ``trip_sk`` for all their checks
    (``trip_sk`` is made from ``ride_id``; where the intermediate trips are a
    projection of staging, both read the same exchange)."""
    trips = [Q.unique_with_key(m[t], t, "trip_sk", "ride_id") for t in ("stg_trips", "int_trips")]
    wanted = " or ".join(f"table_name = '{t}' and column_name = '{c}'" for t, c in UNIQUE)
    rest = [Q.unique(m[t], t, c) for t, c in UNIQUE if t not in ("stg_trips", "int_trips")]
    return Q.union_all([t.where(wanted) for t in trips] + rest)


def dq_accepted_values(m: dict[str, DataFrame]) -> DataFrame:
    return Q.union_all([Q.accepted_values(m[t], t, c, v) for t, c, v in ACCEPTED]
                       + [Q.values_in_set(m[t], t, c, v) for t, c, v in IN_SET])


def dq_relationships(m: dict[str, DataFrame]) -> DataFrame:
    return Q.union_all([Q.relationships(m[t], t, c, m[p], pc) for t, c, p, pc in RELATIONSHIPS])


def dq_nonnegative(m: dict[str, DataFrame]) -> DataFrame:
    return Q.union_all([Q.expression_is_false(m[t], t, c, f"{c} < 0") for t, c in NONNEGATIVE])


def dq_freshness(raw: DataFrame, as_of) -> DataFrame:
    """Newest ``ended_at`` of the raw trips: warn after 1 day, error after 2."""
    return Q.freshness(raw, "trips_raw", "ended_at", as_of,
                       warn_after_s=FRESHNESS_WARN_AFTER_S, error_after_s=FRESHNESS_ERROR_AFTER_S)


def run_all(m: dict[str, DataFrame], not_null: DataFrame | None = None) -> DataFrame:
    """Every model check as one DataFrame (freshness is reported separately).
    ``not_null`` are the results of these checks where the models are saved
    tables (``dq_not_null_saved``); such models are not written once more."""
    if not_null is None:
        m = with_small_models_written(m)
        not_null = dq_not_null(m)
    return Q.union_all([not_null, dq_unique(m), dq_accepted_values(m),
                        dq_relationships(m), dq_nonnegative(m)])
