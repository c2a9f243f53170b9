"""Semantic traps: zone-less time, casts, result types, NULL ordering."""

import datetime as dt

import pytest

from rides.plans import facts as FCT
from rides.plans.intermediate import int_trips
from rides.plans.staging import stg_trips
from rides.sources.csv import read_trips_csv


def test_session_zone_does_not_move_days_or_hours(spark, raw_df):
    raw = raw_df([("r1", "2023-03-12 23:30:00", "2023-03-13 00:10:00", "1", "A", "member")])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = int_trips(stg_trips(raw)).first()
        assert (r.trip_date, r.start_hour) == (dt.date(2023, 3, 12), 23)
        assert r.duration_minutes == pytest.approx(40.0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_clock_change_ride_is_negative_and_dropped(spark, raw_df):
    # wall-clock times without zone: 01:50 -> 01:10 after the autumn change
    raw = raw_df([("r1", "2023-11-05 01:50:00", "2023-11-05 01:10:00", "1", "A", "member")])
    assert stg_trips(raw).count() == 0


def test_bad_values_fail_strict_and_null_lenient(spark, tmp_path):
    from rides.schema import RAW_NAMES

    vals = ["r1", "classic_bike", "2023-13-01 00:00:00", "2023-06-01 00:10:00", "A", "1", "B", "2",
            "x", "-74", "40.7", "-73.9", "member"]
    (tmp_path / "bad.csv").write_text(",".join(RAW_NAMES) + "\n" + ",".join(vals) + "\n")
    with pytest.raises(Exception):
        read_trips_csv(spark, str(tmp_path)).collect()
    r = read_trips_csv(spark, str(tmp_path), strict=False).first()
    assert r.started_at is None and r.start_lat is None and r.end_lat == 40.7


def test_result_types(spark, raw_df):
    raw = raw_df([("a", "2023-06-01 08:00:00", "2023-06-01 08:10:00", "1", "A", "member"),
                  ("b", "2023-07-01 08:00:00", "2023-07-01 08:20:00", "1", "A", "member")])
    it = int_trips(stg_trips(raw))
    assert dict(it.dtypes)["start_hour"] == "bigint" and dict(it.dtypes)["trip_date"] == "date"
    trends = dict(FCT.fct_daily_trip_trends(it).dtypes)
    assert trends["mom_percent_change"] == "double"          # not a decimal
    assert trends["month_total"] == "bigint" and trends["prev_month_total"] == "bigint"
    pop = dict(FCT.fct_popular_stations_by_weekday(it).dtypes)
    assert pop["station_rank"] == "bigint" and pop["total_trips"] == "bigint"


def test_zero_deviation_never_divides(spark, raw_df):
    rows = [(f"r{i}", dt.datetime(2023, 6, 1 + i, 8), dt.datetime(2023, 6, 1 + i, 8, 10), "1", "A",
             "member") for i in range(20)]
    trends = FCT.fct_daily_trip_trends(int_trips(stg_trips(raw_df(rows)))).collect()
    assert all(r.is_anomaly == 0 for r in trends)      # sd = 0 everywhere, no error


def test_ranking_puts_nothing_before_real_counts(spark):
    from rides.operators.ranking import rank_within

    df = spark.createDataFrame([("d", "a", 3), ("d", "b", None), ("d", "c", 5)],
                               "w string, s string, n long")
    got = {r.s: r.r for r in rank_within(df, ["w"], "n", name="r").collect()}
    assert got == {"c": 1, "a": 2, "b": 3}


def test_reports_sort_nulls_last(spark):
    from rides.plans.reports import rpt_hourly_duration

    df = spark.createDataFrame(
        [(8, "Rush Hour", None, 1, 1.0, 1.0), (8, "Rush Hour", "casual", 2, 2.0, 2.0),
         (7, "Rush Hour", "member", 3, 3.0, 3.0)],
        "start_hour bigint, time_of_day_category string, rider_type string, trips_count bigint, "
        "avg_duration_minutes double, median_duration_minutes double")
    got = [(r.start_hour, r.rider_type) for r in rpt_hourly_duration(df).collect()]
    assert got == [(7, "member"), (8, "casual"), (8, None)]
