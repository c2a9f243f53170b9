"""Physical-plan properties the design relies on (checked with explain)."""

import contextlib
import io

from pyspark.sql import functions as F

from rides.operators.ranking import rank_within
from rides.plans import facts as FCT
from rides.plans.aggregates import daily_station_counts, duration_histogram
from rides.plans.intermediate import int_trips
from rides.plans.staging import stg_trips
from rides.sources.parquet import MONTH_COL, read_trips_by_month, write_trips_by_month


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def _parquet_trips(spark, raw_df, tmp_path):
    import datetime as dt

    rows = [(f"r{i}", dt.datetime(2023, 6, 1 + i % 20, 8 + i % 10), dt.datetime(2023, 6, 1 + i % 20, 9),
             str(i % 5), f"S{i % 5}", "member" if i % 2 else "casual") for i in range(200)]
    raw = raw_df(rows)
    path = str(tmp_path / "raw")
    write_trips_by_month(raw, path, source_col="started_at")
    return read_trips_by_month(spark, path, raw.schema)


def test_aggregates_prune_columns_and_combine_before_shuffle(spark, raw_df, tmp_path):
    it = int_trips(stg_trips(_parquet_trips(spark, raw_df, tmp_path)))
    p = plan(duration_histogram(it))
    read_schema = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")][0]
    assert "started_at" in read_schema and "member_casual" in read_schema
    assert "start_station_name" not in read_schema and "end_lat" not in read_schema
    assert_partial_before_exchange(p)
    assert_partial_before_exchange(plan(daily_station_counts(it)))


def assert_partial_before_exchange(p: str):
    """In the tree the node right under each Exchange is a (partial) HashAggregate."""
    tree = p.split("\n\n")[0].splitlines()
    below = [tree[i + 1] for i, ln in enumerate(tree) if "Exchange" in ln]
    assert below and all("HashAggregate" in b for b in below)
    assert "partial_count" in p


def test_partition_and_pushed_filters(spark, raw_df, tmp_path):
    t = _parquet_trips(spark, raw_df, tmp_path)
    p = plan(t.where((F.col(MONTH_COL) == "2023-06") & (F.col("start_station_id") == "3")))
    assert "PartitionFilters: [isnotnull(trip_month" in p
    assert "PushedFilters: [IsNotNull(start_station_id), EqualTo(start_station_id,3)]" in p


def test_rank_filter_limits_before_shuffle(spark):
    df = spark.createDataFrame([("d", str(i), i) for i in range(50)], "w string, s string, n long")
    p = plan(rank_within(df, ["w"], "n", name="r").where("r <= 1"))
    assert "WindowGroupLimit" in p


def test_build_aggregates_scan_trips_once(spark, raw_df, tmp_path):
    from rides.plans.aggregates import COUNT_KEYS, DURATION_KEYS, trip_aggregates

    it = int_trips(stg_trips(_parquet_trips(spark, raw_df, tmp_path)))
    cols = it.selectExpr(*COUNT_KEYS, "start_hour", "member_casual as rider_type",
                         "timestampdiff(MICROSECOND, start_ts, end_ts) as duration_us")
    both = cols.groupingSets([COUNT_KEYS, DURATION_KEYS], *(COUNT_KEYS + DURATION_KEYS)).count()
    p = plan(both)
    tree = p.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and "Expand" in tree
    counts, hist = trip_aggregates(it)
    assert counts.count() == daily_station_counts(it).count()
    assert hist.count() == duration_histogram(it).count()


def test_ranking_limits_groups_before_the_shuffle(spark, raw_df, tmp_path):
    from rides.plans.reports import rpt_top_station_by_weekday

    it = int_trips(stg_trips(_parquet_trips(spark, raw_df, tmp_path)))
    p = plan(rpt_top_station_by_weekday(FCT.fct_popular_stations_by_weekday(it)), mode="simple")
    lines = [ln.strip(" :+-") for ln in p.splitlines()]
    at = next(i for i, ln in enumerate(lines) if ln.startswith("Exchange hashpartitioning(weekday"))
    assert lines[at + 1].startswith("WindowGroupLimit") and "Partial" in lines[at + 1]
    assert "Coalesce 1" not in p


def test_unique_checks_shuffle_trips_once(spark, raw_df, tmp_path):
    from rides.plans import checks as C
    from rides.plans.build import build

    m = build(_parquet_trips(spark, raw_df, tmp_path))
    df = C.dq_unique(m)
    assert {(r.table_name, r.column_name): r.violations for r in df.collect()} == {k: 0 for k in C.UNIQUE}
    p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    own = [ln for ln in p.splitlines() if "Exchange hashpartitioning(trip_sk" in ln and "Reused" not in ln]
    assert len(own) == 1 and "ReusedExchange" in p and "hashpartitioning(ride_id" not in p


def test_percentiles_hold_no_map_of_a_group(spark, raw_df, tmp_path):
    it = int_trips(stg_trips(_parquet_trips(spark, raw_df, tmp_path)))
    p = plan(FCT.fct_trip_duration_by_hour(it))
    assert "ObjectHashAggregate" not in p and "BroadcastHashJoin" in p
