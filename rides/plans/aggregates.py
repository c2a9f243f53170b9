"""The two small aggregates every dimension and fact is built from.

The trip table is the only large input. Each of its two aggregates is taken
in one scan (reading only the columns it needs), with partial aggregation
before the shuffle, and then materialized once as Parquet in the cluster's
shared checkpoint folder. After that the dimensions, facts and reports read
only these small tables, and a lost executor recomputes from the written
aggregate, not from the raw files.

* ``daily_station_counts``: (trip_date, start_station_id, start_station_name)
  -> trips; bounded by days x station names.
* ``duration_histogram``: (start_hour, rider_type, duration_us) -> trips;
  bounded by 48 x distinct durations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rides.functions.calendar import duration_micros_sql
from rides.session import together


def materialize(df: DataFrame, name: str = "agg") -> DataFrame:
    """Write ``df`` once as Parquet into a fresh folder of the shared
    checkpoint directory and return a DataFrame reading it back.

    Unlike an eager ``checkpoint()``, which runs the plan once for the action
    and again to write the checkpoint files, this computes the aggregate (and
    scans the trips) exactly once. The lineage of the result starts at the
    written files, so a lost executor re-reads them instead of the trips.
    """
    from rides.session import shared_dir

    path = shared_dir(df.sparkSession, "materialized", name, unique=True)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def daily_station_counts(trips: DataFrame) -> DataFrame:
    return (trips.groupBy("trip_date", "start_station_id", "start_station_name")
                 .agg(F.expr("count(1) as trips")))


def duration_histogram(trips: DataFrame) -> DataFrame:
    return (trips.selectExpr("start_hour", "member_casual as rider_type",
                             f"{duration_micros_sql('start_ts', 'end_ts')} as duration_us")
                 .groupBy("start_hour", "rider_type", "duration_us")
                 .agg(F.expr("count(1) as trips")))


COUNT_KEYS = ["trip_date", "start_station_id", "start_station_name"]
DURATION_KEYS = ["start_hour", "rider_type", "duration_us"]


# grouping_id() sets a bit for every key column NOT in the set (first key = highest bit)
COUNTS_ID = (1 << len(DURATION_KEYS)) - 1
HISTOGRAM_ID = ((1 << len(COUNT_KEYS)) - 1) << len(DURATION_KEYS)


def both_aggregates(trips: DataFrame, per: list[str] | None = None) -> DataFrame:
    """Both aggregates as one GROUPING SETS aggregation of a single scan, told
    apart by ``grouping_set``; with ``per``, for each value of these columns."""
    per = per or []
    keys = COUNT_KEYS + DURATION_KEYS
    cols = trips.selectExpr(*per, *COUNT_KEYS, "start_hour", "member_casual as rider_type",
                            f"{duration_micros_sql('start_ts', 'end_ts')} as duration_us")
    return (cols.groupingSets([per + COUNT_KEYS, per + DURATION_KEYS], *per, *keys)
                .agg(F.expr("count(1) as trips"), F.expr("grouping_id() as grouping_set")))


def combined(partials: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both aggregates from partial ones (``both_aggregates`` of parts of the
    trips, say of each month): their counts add up."""
    def of(grouping_set, keys):
        return (partials.where(F.col("grouping_set") == grouping_set).groupBy(*keys)
                        .agg(F.expr("cast(sum(trips) as bigint) as trips")))

    counts, hist = together(lambda: materialize(of(COUNTS_ID, COUNT_KEYS), "counts"),
                            lambda: materialize(of(HISTOGRAM_ID, DURATION_KEYS), "durations"))
    return counts, hist


def trip_aggregates(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both aggregates from ONE scan of the trips, written once.

    Each row is expanded once per grouping set before the map-side partial
    aggregation. The result is written once, partitioned by grouping id, and
    read back as two small tables.
    """
    from rides.session import shared_dir

    both = both_aggregates(trips)
    path = shared_dir(trips.sparkSession, "materialized", "trip_aggregates", unique=True)
    both.write.mode("overwrite").partitionBy("grouping_set").parquet(path)
    back = trips.sparkSession.read.schema(both.schema).parquet(path)
    counts = back.where(f"grouping_set = {COUNTS_ID}").select(*COUNT_KEYS, "trips")
    hist = back.where(f"grouping_set = {HISTOGRAM_ID}").select(*DURATION_KEYS, "trips")
    return counts, hist
