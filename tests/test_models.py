"""Staging, intermediate, dimensions and facts on hand-written trips."""

import datetime as dt

import pytest

from rides.plans import dimensions as D, facts as FCT, reports as R
from rides.plans.build import build
from rides.plans.intermediate import int_trips
from rides.plans.staging import stg_trips


def test_staging_duration_filter(spark, raw_df):
    raw = raw_df([
        ("neg", "2023-06-01 10:00:00", "2023-06-01 09:59:00", "1", "A", "member"),
        ("zero", "2023-06-01 10:00:00", "2023-06-01 10:00:00", "1", "A", "member"),
        ("ok", "2023-06-01 10:00:00", "2023-06-01 10:05:00", "1", "A", "casual"),
        ("nullstart", None, "2023-06-01 10:05:00", "1", "A", "casual"),
    ])
    stg = stg_trips(raw)
    assert sorted(r.ride_id for r in stg.collect()) == ["ok", "zero"]
    assert dict(stg.dtypes)["start_ts"] == "timestamp_ntz"
    assert stg.columns[-2:] == ["ingestion_ts", "source_file"]


def test_intermediate_columns_and_values(spark, raw_df):
    raw = raw_df([("r1", "2023-01-01 23:30:00", "2023-01-02 00:15:30", "7", "S7", "member",
                   40.6, -74.0, 40.7, -73.9)])
    it = int_trips(stg_trips(raw)).first()
    assert it.trip_date == dt.date(2023, 1, 1)
    assert it.start_hour == 23 and it.weekday_num == 0 and it.weekday_type == "weekend"
    assert it.duration_minutes == pytest.approx(45.5)
    assert it.trip_distance_km == pytest.approx(13.957642696, abs=1e-9)


def test_null_end_coordinates_give_null_distance(spark, raw_df):
    raw = raw_df([("r1", "2023-01-01 10:00:00", "2023-01-01 10:10:00", "7", "S7", "member",
                   40.6, -74.0, None, None)])
    assert int_trips(stg_trips(raw)).first().trip_distance_km is None


def test_dim_stations_keeps_both_names_and_fact_fans_out(spark, raw_df):
    rows = [(f"a{i}", "2023-06-05 08:00:00", "2023-06-05 08:10:00", "7", "Old", "member")
            for i in range(3)]
    rows += [("b1", "2023-06-05 09:00:00", "2023-06-05 09:10:00", "7", "New", "member"),
             ("c1", "2023-06-05 09:00:00", "2023-06-05 09:10:00", None, None, "member")]
    it = int_trips(stg_trips(raw_df(rows)))
    dims = sorted((r.station_id, r.station_name) for r in D.dim_stations(it).collect())
    assert dims == [("7", "New"), ("7", "Old")]
    fct = FCT.fct_popular_stations_by_weekday(it).collect()
    # one id with two names: the 4 trips of station 7 appear under each name
    assert sorted((r.station_name, r.total_trips, r.station_rank) for r in fct) == \
        [("New", 4, 1), ("Old", 4, 1)]


def test_rank_ties_share_rank_and_skip(spark, raw_df):
    rows = []
    for sid, n in (("1", 9), ("2", 9), ("3", 5)):
        rows += [(f"{sid}-{i}", "2023-06-05 08:00:00", "2023-06-05 08:10:00", sid, f"S{sid}", "member")
                 for i in range(n)]
    fct = FCT.fct_popular_stations_by_weekday(int_trips(stg_trips(raw_df(rows))))
    got = sorted((r.station_id, r.total_trips, r.station_rank) for r in fct.collect())
    assert got == [("1", 9, 1), ("2", 9, 1), ("3", 5, 3)]
    top = R.rpt_top_station_by_weekday(fct).collect()
    assert sorted(r.station_name for r in top) == ["S1", "S2"]


def _daily_gaps_rows():
    """45 observed dates with a missing week and a missing month; 3 trips a
    day except a spike at observed row 5 and row 40."""
    start = dt.date(2023, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(0, 20)]          # Jan 1-20
    days += [dt.date(2023, 1, 28) + dt.timedelta(days=i) for i in range(0, 4)]   # gap of a week
    days += [dt.date(2023, 3, 1) + dt.timedelta(days=i) for i in range(0, 21)]   # February missing
    assert len(days) == 45
    rows = []
    for idx, d in enumerate(days, start=1):
        n = 40 if idx in (5, 40) else 3
        for k in range(n):
            ts = dt.datetime.combine(d, dt.time(8, 0, 0))
            rows.append((f"{idx}-{k}", ts, ts + dt.timedelta(minutes=10), "1", "S1", "member"))
    return days, rows


def test_daily_trends_frames_lag_and_anomalies(spark, raw_df):
    days, rows = _daily_gaps_rows()
    fct = FCT.fct_daily_trip_trends(int_trips(stg_trips(raw_df(rows))))
    out = {r.ride_date: r for r in fct.collect()}
    assert len(out) == 45
    ordered = [out[d] for d in days]
    # row frames: the 7-row average on the first March day reaches back over the gaps
    first_march = ordered[24]
    window = [40 if i in (5, 40) else 3 for i in range(19, 26)]
    assert first_march.avg_7d_trips == pytest.approx(sum(window) / 7)
    # the first 10 rows can never be flagged, even with a spike at row 5
    assert all(r.is_anomaly == 0 for r in ordered[:10])
    assert ordered[39].is_anomaly == 1
    assert sum(r.is_anomaly for r in ordered) == 1
    # LAG skips the missing February: March's previous month is January
    assert first_march.prev_month_total == out[days[0]].month_total
    jan = out[days[0]].month_total
    assert first_march.mom_percent_change == pytest.approx((first_march.month_total - jan) * 100.0 / jan)
    assert out[days[0]].prev_month_total is None and out[days[0]].season == "Winter"


def test_duration_percentiles_and_rush_gap(spark, raw_df):
    base = dt.datetime(2023, 6, 5, 8, 0, 0)
    rows = [(f"m{i}", base, base + dt.timedelta(minutes=m), "1", "S1", "member")
            for i, m in enumerate([1, 2, 3, 4])]
    rows += [("c1", base, base + dt.timedelta(minutes=10), "1", "S1", "casual")]
    rows += [("x1", base.replace(hour=12), base.replace(hour=12) + dt.timedelta(minutes=5), "1", "S1", "member")]
    fct = FCT.fct_trip_duration_by_hour(int_trips(stg_trips(raw_df(rows))))
    m = [r for r in fct.collect() if r.start_hour == 8 and r.rider_type == "member"][0]
    assert (m.trips_count, m.avg_duration_minutes, m.median_duration_minutes,
            m.p25_duration_minutes, m.p75_duration_minutes) == (4, 2.5, 2.5, 1.75, 3.25)
    assert m.time_of_day_category == "Rush Hour"
    gap = R.rpt_rush_hour_gap(fct).collect()
    assert [(g.start_hour, g.member_median_duration, g.casual_median_duration, g.duration_difference)
            for g in gap] == [(8, 2.5, 10.0, 7.5)]


def test_build_and_report_order(spark, raw_df):
    days, rows = _daily_gaps_rows()
    models = build(raw_df(rows))
    assert set(models) >= {"dim_date", "fct_daily_trip_trends", "rpt_monthly_trends"}
    months = [r.month for r in models["rpt_monthly_trends"].collect()]
    assert months == [dt.date(2023, 1, 1), dt.date(2023, 3, 1)]
    dates = [r.ride_date for r in models["rpt_daily_rolling"].collect()]
    assert dates == sorted(dates)
    week = [r.weekday for r in models["rpt_top_station_by_weekday"].collect()]
    order = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert week == sorted(week, key=order.index)


def test_models_answer_sql_by_name(spark, raw_df):
    from rides.plans.build import register_views

    days, rows = _daily_gaps_rows()
    names = register_views(build(raw_df(rows)))
    assert "fct_popular_stations_by_weekday" in names
    top = spark.sql("""
        select weekday, station_name, total_trips from fct_popular_stations_by_weekday
        where station_rank = 1 order by total_trips desc, weekday""").collect()
    assert len(top) == 7 and top[0].station_name == "S1"
    monthly = spark.sql("""
        select date_trunc('month', ride_date) as m, max(month_total) as total
        from fct_daily_trip_trends group by 1 order by 1""").collect()
    assert [r.total for r in monthly] == [sum(40 if i in (5, 40) else 3 for i in range(1, 25)),
                                          sum(40 if i in (5, 40) else 3 for i in range(25, 46))]
