"""Command line: load trip files, run the models, run the data tests.

    python -m rides load  --input DIR_OR_ZIP --raw PATH [--mode replace|append]
    python -m rides run   --raw PATH [--database rides] [--root PATH] [--full-refresh]
    python -m rides test  [--database rides] [--as-of TIMESTAMP]
    python -m rides show  REPORT [--database rides] [--rows N]

``load`` writes the CSV files and the zip archives of the input to a
month-partitioned raw Parquet table, which it replaces (loading twice is the
same as once) or appends to; ``run`` loads
staging incrementally and rebuilds the dimension and fact tables; ``test``
prints every check and exits with status 1 when any check fails.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="rides")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("--input", required=True)
    p.add_argument("--raw", required=True)
    p.add_argument("--mode", choices=["replace", "append"], default="replace")
    p.add_argument("--lenient", action="store_true", help="unparsable values become NULL")
    p.add_argument("--rejects", help="folder for rows that do not fit the schema, with their reasons")
    p = sub.add_parser("run")
    p.add_argument("--raw", required=True)
    p.add_argument("--database", default="rides")
    p.add_argument("--root")
    p.add_argument("--full-refresh", action="store_true")
    p = sub.add_parser("test")
    p.add_argument("--database", default="rides")
    p.add_argument("--raw")
    p.add_argument("--as-of")
    p = sub.add_parser("show")
    p.add_argument("report")
    p.add_argument("--database", default="rides")
    p.add_argument("--rows", type=int, help="show only the first rows")
    args = ap.parse_args(argv)

    from rides.session import cleanup_scratch, get_session

    spark = get_session()
    try:
        return _run(spark, args)
    finally:
        cleanup_scratch(spark)      # written aggregates and staged rows of this application


def _run(spark, args) -> int:
    if args.cmd == "load":
        return _load(spark, args)
    if args.cmd == "run":
        from rides.plans.build import run_models
        from rides.schema import RAW_WITH_FILE

        raw = spark.read.schema(RAW_WITH_FILE).parquet(args.raw)
        out = run_models(spark, raw, database=args.database, root=args.root,
                         full_refresh=args.full_refresh)
        print(json.dumps(out["stg_load"], default=str))
        return 0
    if args.cmd == "test":
        return _test(spark, args)
    if args.cmd == "show":
        return _show(spark, args)
    return 2


def _load(spark, args) -> int:
    from rides.sources.archive import ingest_archives
    from rides.sources.csv import ingest
    from rides.sources.files import NoUsableFiles

    kinds = [fn for fn, glob in ((ingest, "*.csv"), (ingest_archives, "*.zip"))
             if _has(args.input, glob)]
    if not kinds:
        raise NoUsableFiles(f"no CSV files or archives under {args.input!r}")
    mode = args.mode
    for fn in kinds:
        report = fn(spark, args.input, args.raw, strict=not args.lenient, mode=mode, rejects=args.rejects)
        print(json.dumps(report, default=str))
        mode = "append"     # the second kind joins the first
    return 0


def _has(path: str, glob: str) -> bool:
    from rides.sources.files import NoUsableFiles, admit

    if path.endswith((".csv", ".zip")) and not path.endswith(glob[1:]):
        return False
    try:
        return bool(admit(None, path, glob).admitted)
    except NoUsableFiles:
        return False


def _models_from_catalog(spark, db):
    from rides.plans.build import MODEL_TABLES

    names = ["stg_trips", "int_trips", *MODEL_TABLES]
    return {n: spark.table(f"{db}.{n}").drop("trip_month") for n in names}


def _test(spark, args) -> int:
    from pyspark.sql import functions as F

    from rides.plans import checks as C
    from rides.sources.footers import table_files

    m = _models_from_catalog(spark, args.database)
    files = {t: table_files(spark, f"{args.database}.{t}") for t in C.NOT_NULL}
    rows = C.run_all(m, C.dq_not_null_saved(spark, files)).collect()
    failed = 0
    for r in rows:
        status = "PASS" if r.violations == 0 else "FAIL"
        failed += status == "FAIL"
        print(f"{status} {r.check_name}({r.table_name}.{r.column_name}) {r.violations}")
    if args.raw:
        from rides.schema import RAW_WITH_FILE

        raw = spark.read.schema(RAW_WITH_FILE).parquet(args.raw)
        as_of = args.as_of or F.current_timestamp().cast("timestamp_ntz")
        f = C.dq_freshness(raw, as_of).first()
        print(f"{f.status.upper()} freshness(trips_raw) newest={f.max_loaded_at} age_s={f.age_seconds}")
        failed += f.status == "error"
    return 1 if failed else 0


def _show(spark, args) -> int:
    from rides.plans import reports as R

    t = lambda n: spark.table(f"{args.database}.{n}")
    builders = {
        "all_stations_by_weekday": lambda: R.rpt_all_stations_by_weekday(t("fct_popular_stations_by_weekday")),
        "top_station_by_weekday": lambda: R.rpt_top_station_by_weekday(t("fct_popular_stations_by_weekday")),
        "daily_rolling": lambda: R.rpt_daily_rolling(t("fct_daily_trip_trends")),
        "hourly_duration": lambda: R.rpt_hourly_duration(t("fct_trip_duration_by_hour")),
        "monthly_trends": lambda: R.rpt_monthly_trends(t("fct_daily_trip_trends")),
        "rush_hour_gap": lambda: R.rpt_rush_hour_gap(t("fct_trip_duration_by_hour")),
    }
    if args.report not in builders:
        print("reports: " + ", ".join(builders), file=sys.stderr)
        return 2
    report = builders[args.report]()
    report.show(report.count() if args.rows is None else args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
