"""Model run with tables: incremental staging, rebuilt marts, statistics."""

import datetime as dt


def trip(rid, start, sid="1"):
    s = dt.datetime.fromisoformat(start)
    return (rid, s, s + dt.timedelta(minutes=12), sid, f"S{sid}", "member")


def test_run_models_twice_is_incremental(spark, raw_df, tmp_path):
    from rides.plans.build import run_models

    first = raw_df([trip("a", "2023-06-01 08:00:00"), trip("b", "2023-06-02 17:00:00", "2")])
    out = run_models(spark, first, database="rides_t", root=str(tmp_path / "wh"))
    assert out["stg_load"]["mode"] == "full"
    assert out["fct_daily_trip_trends"].count() == 2
    stats = spark.sql("DESCRIBE TABLE EXTENDED rides_t.fct_trip_duration_by_hour").collect()
    assert any("Statistics" in (r.col_name or "") for r in stats)
    col = spark.sql("DESCRIBE TABLE EXTENDED rides_t.fct_trip_duration_by_hour trips_count").collect()
    assert any(r.info_name == "distinct_count" for r in col)
    assert "station_rank" in spark.table("rides_t.fct_popular_stations_by_weekday").columns

    second = raw_df([trip("a", "2023-06-01 08:00:00"), trip("b", "2023-06-02 17:00:00", "2"),
                     trip("c", "2023-07-01 09:00:00"), trip("late", "2023-05-01 09:00:00")])
    out = run_models(spark, second, database="rides_t", root=str(tmp_path / "wh"))
    assert out["stg_load"]["months"] == ["2023-07"]
    assert sorted(r.ride_id for r in spark.table("rides_t.stg_trips").collect()) == ["a", "b", "c"]
    assert [r.month.month for r in out["rpt_monthly_trends"].collect()] == [6, 7]

    out = run_models(spark, second, database="rides_t", root=str(tmp_path / "wh"),
                     full_refresh=True)
    assert spark.table("rides_t.int_trips").count() == 4


def test_rebuilt_tables_hold_no_dead_months(spark, raw_df, tmp_path):
    """A ride that changes month, and a month that a full refresh drops."""
    from rides.plans.build import run_models

    root, db = str(tmp_path / "wh"), "rides_moved"
    per_month = lambda: {r.trip_month: r["count"] for r in spark.table(f"{db}.int_trips").groupBy("trip_month").count().collect()}
    run_models(spark, raw_df([trip("a", "2023-05-01 08:00:00"), trip("b", "2023-06-02 17:00:00")]), database=db, root=root)
    run_models(spark, raw_df([trip("a", "2023-07-01 08:00:00")]), database=db, root=root)
    assert per_month() == {"2023-06": 1, "2023-07": 1}
    out = run_models(spark, raw_df([trip("z", "2023-04-01 08:00:00")]), database=db, root=root, full_refresh=True)
    assert per_month() == {"2023-04": 1}
    assert [r.month.month for r in out["rpt_monthly_trends"].collect()] == [4]
