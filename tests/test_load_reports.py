"""Rows set aside, figures taken while writing, and statistics from footers."""

import datetime as dt

from pyspark.sql import functions as F

from rides.schema import RAW_NAMES


def _line(i, start="2023-06-01 08:00:00", end="2023-06-01 08:10:00", lat="40.6", cols=RAW_NAMES):
    vals = {"ride_id": str(i), "rideable_type": "classic_bike", "started_at": start, "ended_at": end,
            "start_station_name": "A", "start_station_id": "1", "end_station_name": "B", "end_station_id": "2",
            "start_lat": lat, "start_lng": "-74.0", "end_lat": "40.7", "end_lng": "-73.9", "member_casual": "member"}
    return ",".join(vals[c] for c in cols)


def _write(path, lines, cols=RAW_NAMES):
    path.write_text("\n".join([",".join(cols), *lines]) + "\n")


def test_unfit_rows_are_set_aside_with_reason_and_text(spark, tmp_path):
    from rides.sources.csv import ingest

    src = tmp_path / "in"
    src.mkdir()
    _write(src / "a.csv", [_line(1), _line(2, start="yesterday", lat="north"), _line(3) + ",one more",
                           _line(4, start="", lat=""), _line(5, end="2023-06-01 07:00:00")])
    _write(src / "b.csv", [_line(6, cols=RAW_NAMES[::-1]), _line(7, lat="x", cols=RAW_NAMES[::-1])], RAW_NAMES[::-1])
    report = ingest(spark, str(src), str(tmp_path / "raw"), mode="replace", rejects=str(tmp_path / "rejects"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    assert sorted(r.ride_id for r in raw.collect()) == ["1", "4", "5", "6"]
    bad = {r.raw.split(",")[0] if r.filename.endswith("a.csv") else "7": r
           for r in spark.read.parquet(str(tmp_path / "rejects")).collect()}
    assert sorted(bad) == ["2", "3", "7"]
    assert bad["2"].reasons == ["bad started_at", "bad start_lat"] and "yesterday" in bad["2"].raw
    assert bad["3"].reasons == ["wrong number of fields"] and bad["3"].raw.endswith("one more")
    assert bad["7"].reasons == ["bad start_lat"]
    assert report["counts"] == {"rows_in": 4, "negative_duration": 1, "no_start_or_end": 1, "no_ride_id": 0,
                                "no_start_station": 0, "rows_rejected": 3}
    assert {f["file"].rsplit("/", 1)[1]: (f["rows_added"], f["rows_unfit"]) for f in report["files"]} == {
        "a.csv": (3, 2), "b.csv": (1, 0)}
    # a load whose rows all fit writes no rejects
    ingest(spark, str(src / "b.csv"), str(tmp_path / "raw2"), mode="replace", strict=False)
    _write(src / "b.csv", [_line(6)])
    clean = ingest(spark, str(src / "b.csv"), str(tmp_path / "raw3"), mode="replace", rejects=str(tmp_path / "none"))
    assert clean["counts"]["rows_rejected"] == 0 and not (tmp_path / "none").exists()


def test_figures_of_a_model_run_are_of_all_raw_rows(spark, raw_df, tmp_path):
    from rides.plans.build import run_models

    def t(s):
        return dt.datetime.fromisoformat(s)

    rows = [("a", t("2023-06-01 08:00:00"), t("2023-06-01 08:05:00"), "1", "A", "member"),
            ("b", t("2023-06-02 08:00:00"), t("2023-06-02 07:00:00"), "1", "A", "member"),
            (None, t("2023-06-03 08:00:00"), None, None, None, "casual")]
    out = run_models(spark, raw_df(rows), database="rides_figures", root=str(tmp_path / "wh"))
    assert out["stg_load"]["counts"] == {"rows_in": 3, "negative_duration": 1, "no_start_or_end": 1,
                                         "no_ride_id": 1, "no_start_station": 1}
    # a second run: rows before the mark are counted, though not loaded
    out = run_models(spark, raw_df(rows), database="rides_figures", root=str(tmp_path / "wh"), with_stats=False)
    assert out["stg_load"]["counts"]["rows_in"] == 3 and out["stg_load"]["months"] == []
    props = {r["key"]: r["value"] for r in spark.sql(
        "SHOW TBLPROPERTIES rides_figures.stg_trips__v1").collect()}
    assert '"max_text": "2023-06-01 08:00:00.000000"' in props["rides.column.start_ts"]


def test_footer_statistics_against_a_scan(spark, tmp_path):
    from rides.sources.footers import column_statistics

    path = str(tmp_path / "t")
    df = spark.range(1000).select(
        F.col("id").alias("n"), (F.col("id") * 1.5 - 7).alias("x"), F.when(F.col("id") % 3 > 0, F.concat(
            F.lit("k"), F.col("id"))).alias("s"), F.lit(None).cast("string").alias("none"),
        F.expr("timestamp_ntz '2023-01-01 00:00:00' + make_dt_interval(id)").alias("ts"),
        F.expr("date_add(date '2023-01-01', cast(id as int))").alias("d"))
    df.repartition(5).write.parquet(path)
    got = {r.column_name: r for r in column_statistics(spark, {"t": [path]}).collect()}
    scan = df.agg(*(f(c).alias(f"{f.__name__}_{c}") for c in df.columns for f in (F.min, F.max))).first()
    assert {c: (r.row_count, r.null_count) for c, r in got.items()} == {
        "n": (1000, 0), "x": (1000, 0), "s": (1000, 334), "none": (1000, 1000), "ts": (1000, 0), "d": (1000, 0)}
    assert (got["x"].min_number, got["n"].max_number) == (scan.min_x, 999.0)
    assert (got["s"].min_text, got["s"].max_text, got["none"].min_text) == (scan.min_s, scan.max_s, None)
    assert got["ts"].max_text.startswith(str(scan.max_ts)) and got["d"].min_text == "2023-01-01"


def test_driver_opens_no_archive(spark, tmp_path, monkeypatch):
    """Opening an archive fails in the driver; tasks have their own module."""
    import zipfile

    from rides.sources import archive, files

    with zipfile.ZipFile(tmp_path / "inner.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("b.csv", ",".join(RAW_NAMES) + "\n" + _line(2) + "\n" + _line(3, lat="x") + "\n")
    src = tmp_path / "zips"
    src.mkdir()
    with zipfile.ZipFile(src / "all.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", ",".join(RAW_NAMES) + "\n" + _line(1) + "\n")
        z.write(tmp_path / "inner.zip", "month.zip")
        z.writestr("__MACOSX/._a.csv", "x")

    def closed(path):
        raise AssertionError(f"the driver opened {path}")

    monkeypatch.setattr(files, "open_path", closed)
    report = archive.ingest_archives(spark, str(src), str(tmp_path / "raw"), mode="replace",
                                     rejects=str(tmp_path / "rejects"))
    assert [m["rows_added"] for m in report["members"]] == [1, 1] and report["counts"]["rows_rejected"] == 1
    assert [why for _, _, why in report["skipped"]] == ["hidden folder"]
    assert sorted(r.ride_id for r in spark.read.parquet(str(tmp_path / "raw")).collect()) == ["1", "2"]
    assert spark.read.parquet(str(tmp_path / "rejects")).first().reasons == ["bad start_lat"]
