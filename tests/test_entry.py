"""Driver contract and Spark-vs-SQL agreement on the smallest data set."""

import hashlib
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["ride_date", "daily_trips", "avg_7d_trips", "avg_30d_trips", "is_anomaly"]
    assert df.count() > 0


def test_every_query_has_an_oracle_unless_listed():
    from __spark_entry__ import NO_ORACLE, oracle_sql, queries

    from rides.registry import QUERIES

    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) - set(o) == NO_ORACLE


def _digest(tbl):
    cols = sorted(tbl.column_names)
    data = {c: tbl.column(c).to_pylist() for c in cols}
    rows = sorted(repr(tuple(data[c][i] for c in cols)) for i in range(tbl.num_rows))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


FAST_KEYS = ["raw_row_count", "stg_trips", "int_trips", "stg_trips_incremental", "dim_date", "dim_stations",
             "dim_time", "fct_popular_stations_by_weekday", "fct_trip_duration_by_hour",
             "fct_daily_trip_trends", "rpt_all_stations_by_weekday", "rpt_top_station_by_weekday",
             "rpt_daily_rolling", "rpt_hourly_duration", "rpt_monthly_trends", "rpt_rush_hour_gap",
             "op_haversine", "op_surrogate_key", "op_percentiles", "op_rolling_stats", "op_lag_mom",
             "op_rank", "dq_not_null", "dq_unique", "dq_accepted_values", "dq_relationships",
             "dq_nonnegative", "dq_freshness", "parquet_roundtrip", "csv_by_name_roundtrip",
             "archive_ingest", "ingest_stats", "archive_ingest_stats", "csv_dialect",
             "archive_dialect", "raw_two_appends", "empty_raw_append", "file_admission", "view_sink", "table_statistics",
             "table_columns"]


def test_spark_matches_sql_oracle(spark):
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    con = duckdb.connect()
    con.execute(f"create view orders as select * from read_parquet('{SF}/orders.parquet')")
    q, o = queries(), oracle_sql()
    bad = []
    for k in FAST_KEYS:
        s = q[k](spark, SF).toArrow()
        d = con.sql(o[k]).to_arrow_table()
        if sorted(s.column_names) != sorted(d.column_names) or s.num_rows != d.num_rows \
                or _digest(s) != _digest(d):
            bad.append(k)
    assert not bad


def test_report_order_of_stations_and_rush_hours(spark):
    from __spark_entry__ import queries

    stations = [(r.weekday, r.station_rank) for r in queries()["rpt_all_stations_by_weekday"](spark, SF).collect()]
    assert stations == sorted(stations) and len({d for d, _ in stations}) == 7
    hours = [r.start_hour for r in queries()["rpt_rush_hour_gap"](spark, SF).collect()]
    assert hours == sorted(hours) and len(hours) > 1
