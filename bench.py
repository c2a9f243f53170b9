"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8): one warm-up run, then the median of
``$BENCH_RUNS`` (default 5) timed runs, each forcing the full result with a
no-op write. Prints one JSON line.

With ``BENCH_EVENT_LOG_DIR`` set (use a fresh scratch folder), Spark writes
its event log there, with every job tagged by query name;
``tools/stage_times.py`` summarizes it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "stg_trips", "int_trips", "fct_popular_stations_by_weekday", "fct_trip_duration_by_hour",
    "fct_daily_trip_trends", "rpt_top_station_by_weekday", "rpt_daily_rolling",
    "rpt_hourly_duration", "rpt_monthly_trends", "rpt_rush_hour_gap", "stg_trips_incremental",
    "dq_not_null", "dq_unique", "raw_row_count", "csv_by_name_roundtrip", "archive_ingest",
    "stream_incremental", "run_models_incremental", "full_build",
]


def run_full_build(spark, sf):
    """Every model and report from one raw read (two trip scans)."""
    from rides.plans.build import build
    from rides.sources.fixtures import trips_from_orders

    models = build(trips_from_orders(spark, sf))
    for name, df in models.items():
        if name.startswith(("fct_", "rpt_", "dim_")):
            df.write.format("noop").mode("overwrite").save()


def main():
    from rides.registry import QUERIES
    from rides.session import get_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": "16g"}
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")   # e.g. a fresh mktemp -d folder
    if event_dir:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = get_session(f"local[{cpus}]", app="rides-bench", shuffle_partitions=cpus * 2,
                        extra=extra)
    spark.sparkContext.setLogLevel("ERROR")

    def once(name):
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        if name == "full_build":
            run_full_build(spark, sf)
        else:
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    results = {}
    for name in only or HEADLINE:
        once(name)
        results[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
    total = round(sum(results.values()), 4)
    from rides.sources.fixtures import trips_from_orders

    trips = trips_from_orders(spark, sf).count()
    more = {}
    if "full_build" in results:
        more["full_build_trips_per_sec"] = round(trips / results["full_build"])
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
                      "queries": results, "sf": os.path.basename(sf.rstrip("/")),
                      "cpus": cpus, "runs": runs, "trips": trips, **more}))
    from rides.session import cleanup_scratch

    cleanup_scratch(spark)


if __name__ == "__main__":
    main()
