"""Counts published in FIXTURES.md for the trips mapped from `orders`."""

import os

import pytest
from pyspark.sql import functions as F

from rides.plans import facts as FCT
from rides.plans.intermediate import int_trips
from rides.plans.staging import stg_trips
from rides.sources.fixtures import trips_from_orders

# sf: (rows, negative, zero, null start station, observed dates, anomalous dates,
#      (weekday, station id) groups, distinct (weekday, count) pairs)
EXPECTED = {
    "sf0.001": (1500, 14, 0, 24, 1084, 13, 279, 75),
    "sf0.01": (15000, 127, 2, 158, 2398, 7, 280, 158),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_mapped_trips_match_published_counts(spark, sf):
    path = f"/root/testdata/{sf}"
    if not os.path.exists(path):
        pytest.skip("test data not present")
    rows, neg, zero, null_start, dates, anomalies, groups, pairs = EXPECTED[sf]
    raw = trips_from_orders(spark, path)
    got = raw.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col("ended_at") < F.col("started_at")).alias("neg"),
                  F.count_if(F.col("ended_at") == F.col("started_at")).alias("zero"),
                  F.count_if(F.col("start_station_id").isNull()).alias("null_start")).first()
    assert (got.n, got.neg, got.zero, got.null_start) == (rows, neg, zero, null_start)
    it = int_trips(stg_trips(raw))
    trends = FCT.fct_daily_trip_trends(it)
    assert trends.count() == dates
    assert trends.where("is_anomaly = 1").count() == anomalies
    # the group figures describe the raw mapping: non-NULL start stations,
    # before the duration filter
    swc = (raw.where("start_station_id is not null")
              .selectExpr("date_format(to_date(started_at), 'EEEE') as weekday", "start_station_id")
              .groupBy("weekday", "start_station_id").count())
    assert swc.count() == groups
    assert swc.select("weekday", "count").distinct().count() == pairs
