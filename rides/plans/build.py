"""Assemble every model and report from raw trips.

The staging and intermediate tables stay lazy (they are projections of the
raw trips). Both small aggregates come from one grouping-sets scan of the
trips, written once as Parquet in the shared folder; every dimension, fact
and report is then built from them, so the trips are scanned once, reading
only the columns the aggregates need.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from rides.plans import dimensions as D, facts as FCT, reports as R
from rides.plans.aggregates import both_aggregates, combined, trip_aggregates
from rides.plans.intermediate import int_trips
from rides.plans.staging import stg_trips
from rides.session import together
from rides.sources.parquet import month_key


def build(raw: DataFrame, include_ingestion_ts: bool = True) -> dict[str, DataFrame]:
    return build_from_stg(stg_trips(raw, include_ingestion_ts=include_ingestion_ts))


def build_from_stg(stg: DataFrame, it: DataFrame | None = None,
                   aggregates: tuple[DataFrame, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every model and report from the staging table and, where given, an
    already written intermediate table and the two aggregates of its trips."""
    it = it if it is not None else int_trips(stg)
    counts, hist = aggregates or trip_aggregates(it)
    dim_date = D.dim_date_from_dates(counts)
    dim_stations = D.dim_stations_from(counts)
    dim_time = D.dim_time_from_hours(hist)
    popular = FCT.fct_popular_stations_by_weekday(dates=dim_date, stations=dim_stations,
                                                  counts=counts)
    durations = FCT.fct_trip_duration_by_hour(times=dim_time, hist=hist)
    trends = FCT.fct_daily_trip_trends(dates=dim_date, counts=counts)
    return {
        "stg_trips": stg,
        "int_trips": it,
        "dim_date": dim_date,
        "dim_stations": dim_stations,
        "dim_time": dim_time,
        "fct_popular_stations_by_weekday": popular,
        "fct_trip_duration_by_hour": durations,
        "fct_daily_trip_trends": trends,
        "rpt_all_stations_by_weekday": R.rpt_all_stations_by_weekday(popular),
        "rpt_top_station_by_weekday": R.rpt_top_station_by_weekday(popular),
        "rpt_daily_rolling": R.rpt_daily_rolling(trends),
        "rpt_hourly_duration": R.rpt_hourly_duration(durations),
        "rpt_monthly_trends": R.rpt_monthly_trends(trends),
        "rpt_rush_hour_gap": R.rpt_rush_hour_gap(durations),
    }


def stage_observed(raw: DataFrame):
    """Staged trips, and the figures of the raw rows (all, those that staging
    drops and why, those without an id or station) once they are written."""
    from rides.operators.metrics import observed, raw_counts

    rows, watch = observed(raw, raw_counts())
    return stg_trips(rows), watch


MODEL_TABLES = ["dim_date", "dim_stations", "dim_time", "fct_popular_stations_by_weekday",
                "fct_trip_duration_by_hour", "fct_daily_trip_trends"]


def run_models(spark: SparkSession, raw: DataFrame, database: str = "rides",
               root: str | None = None, full_refresh: bool = False,
               lookback=None, with_stats: bool = True) -> dict:
    """Load every model as a table, like a scheduled model run.

    * staging: incremental high-water-mark upsert (``full_refresh`` rebuilds);
    * intermediate and the partial aggregates of each month: made anew for the
      months that the load changed, and for no others;
    * dimensions and facts: rebuilt from the aggregates.

    Each table is published by one step at its end: a reader, or a run that
    stops, never meets a table half written. Statistics follow the source
    project (staging, intermediate and the three facts): the two trip-sized
    tables get size, row count and per column nulls, least and greatest value,
    all from file footers, the small facts full column statistics.

    Tables are external, under ``root`` (default: a folder of the database in
    the session's warehouse). Returns
    the staging load summary, ``refreshed`` (the months made anew, by table)
    and a DataFrame per table and report.
    """
    from rides.operators import derived
    from rides.operators.incremental import IncrementalTable
    from rides.sources import tables as TB, versions as V
    from rides.sources.footers import column_statistics, set_in_catalog
    from rides.sources.parquet import MONTH_COL

    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{database}.rides"
    TB.create_schema(spark, database, location=f"{root}/_db")
    staged, watch = stage_observed(raw)
    stg_table = IncrementalTable(spark, f"{root}/stg_trips")
    summary = stg_table.load(staged, full_refresh=full_refresh, lookback=lookback)
    summary["counts"] = watch.get
    version = stg_table.version()

    def derive(name, source, read, transform):
        path = f"{root}/{name}"
        schema = transform(read([])).drop(MONTH_COL).schema
        manifest = derived.refresh(spark, path, source, read, transform)
        return manifest, lambda months=None: derived.read(spark, path, schema, months)

    def read_stg(months):
        return stg_table.read(staged.schema, months)

    def with_month(rows):
        return int_trips(rows).withColumn(MONTH_COL, month_key())

    (int_version, read_int), (agg_version, read_agg) = together(
        lambda: derive("int_trips", version, read_stg, with_month),
        lambda: derive("agg_trips", version, read_stg,
                       lambda rows: both_aggregates(with_month(rows), per=[MONTH_COL])))

    def publish(name, schema, manifest):
        TB.publish_months(spark, f"{database}.{name}", f"{root}/{name}", schema, manifest)
        if with_stats:
            TB.analyze(spark, f"{database}.{name}", columns=False)
            set_in_catalog(spark, f"{database}.{name}",
                           column_statistics(spark, {name: V.folders(f"{root}/{name}")}))

    def save(name):
        TB.save_table(models[name], f"{database}.{name}", f"{root}/{name}")
        if with_stats and name.startswith("fct_"):
            TB.analyze(spark, f"{database}.{name}")

    models = build_from_stg(read_stg(None).drop(MONTH_COL), read_int().drop(MONTH_COL), combined(read_agg()))
    together(lambda: publish("stg_trips", staged.schema, version),
             lambda: publish("int_trips", read_int([]).drop(MONTH_COL).schema, int_version),
             *(partial(save, name) for name in MODEL_TABLES))
    out = {"stg_load": summary, "refreshed": {"int_trips": int_version["refreshed"],
                                              "agg_trips": agg_version["refreshed"]}}
    out.update({name: spark.table(f"{database}.{name}") for name in MODEL_TABLES})
    popular, durations, trends = (out["fct_popular_stations_by_weekday"],
                                  out["fct_trip_duration_by_hour"], out["fct_daily_trip_trends"])
    out.update({
        "rpt_all_stations_by_weekday": R.rpt_all_stations_by_weekday(popular),
        "rpt_top_station_by_weekday": R.rpt_top_station_by_weekday(popular),
        "rpt_daily_rolling": R.rpt_daily_rolling(trends),
        "rpt_hourly_duration": R.rpt_hourly_duration(durations),
        "rpt_monthly_trends": R.rpt_monthly_trends(trends),
        "rpt_rush_hour_gap": R.rpt_rush_hour_gap(durations),
    })
    return out


def register_views(models: dict[str, DataFrame]) -> list[str]:
    """Expose every model and report as a session view under its own name,
    so ad-hoc SQL can query ``fct_daily_trip_trends`` and friends directly."""
    from rides.sources.tables import create_view

    names = []
    for name, df in models.items():
        if isinstance(df, DataFrame):
            create_view(df, name)
            names.append(name)
    return names
