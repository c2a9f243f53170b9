"""CSV, zip and Parquet sources on hand-written files."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from rides.schema import RAW_NAMES
from rides.sources.archive import read_trips_zip
from rides.sources.csv import ingest, read_trips_csv
from rides.sources.files import NoUsableFiles, admit
from rides.sources.parquet import read_trips_by_month, write_trips_by_month

HEADER = ",".join(RAW_NAMES)


def row(rid, start="2023-06-01 08:00:00", end="2023-06-01 08:10:00", member="member"):
    vals = {"ride_id": rid, "rideable_type": "classic_bike", "started_at": start, "ended_at": end,
            "start_station_name": "A", "start_station_id": "1", "end_station_name": "B",
            "end_station_id": "2", "start_lat": "40.6", "start_lng": "-74.0",
            "end_lat": "40.7", "end_lng": "-73.9", "member_casual": member}
    return vals


def csv_text(rows, cols=RAW_NAMES):
    lines = [",".join(cols)] + [",".join(r.get(c, "") for c in cols) for r in rows]
    return "\n".join(lines) + "\n"


def test_reordered_headers_are_read_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(csv_text([row("r1")]))
    (tmp_path / "b.csv").write_text(csv_text([row("r2", member="casual")], list(reversed(RAW_NAMES))))
    got = {r.ride_id: r for r in read_trips_csv(spark, str(tmp_path)).collect()}
    assert got["r2"].member_casual == "casual" and got["r2"].start_lat == 40.6
    assert got["r1"].end_lng == -73.9 and str(got["r1"].started_at) == "2023-06-01 08:00:00"


def test_extra_and_missing_columns(spark, tmp_path):
    cols = [c for c in RAW_NAMES if c != "rideable_type"] + ["note"]
    r = row("r1")
    r["note"] = "hello"
    (tmp_path / "x.csv").write_text(csv_text([r], cols))
    (tmp_path / "y.csv").write_text(csv_text([row("r2")]))
    got = {x.ride_id: x for x in read_trips_csv(spark, str(tmp_path)).collect()}
    assert got["r1"].rideable_type is None and got["r2"].rideable_type == "classic_bike"
    assert "note" not in read_trips_csv(spark, str(tmp_path)).columns


def test_admission_skips_junk(spark, tmp_path):
    (tmp_path / "good.csv").write_text(csv_text([row("r1")]))
    (tmp_path / "._good.csv").write_text("junk")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "__MACOSX").mkdir()
    (tmp_path / "__MACOSX" / "good.csv").write_text("junk")
    adm = admit(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[-1] for p in adm.paths] == ["good.csv"]
    assert sorted((s[0].rsplit("/", 2)[-2:][1], s[2]) for s in adm.skipped) == [
        ("._good.csv", "resource fork"), ("empty.csv", "empty"), ("good.csv", "hidden folder")]
    assert read_trips_csv(spark, str(tmp_path)).count() == 1


def test_nothing_usable_raises(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(NoUsableFiles):
        admit(spark, str(tmp_path))


def test_two_files_of_one_month_lose_no_rows(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "202306-trips_1.csv").write_text(csv_text([row("a"), row("b")]))
    (src / "202306-trips_2.csv").write_text(csv_text([row("c")]))
    target = str(tmp_path / "raw")
    report = ingest(spark, str(src), target)
    assert report["rows"] == 3 and len(report["files"]) == 2
    back = spark.read.parquet(target)
    assert back.count() == 3
    assert [r.trip_month for r in back.select("trip_month").distinct().collect()] == ["2023-06"]


def test_two_row_csv_ingest_counts_two(spark, tmp_path):
    """A two-row CSV loads as two rows (columns it lacks become NULL)."""
    (tmp_path / "test.csv").write_text("col1,col2\n1,2\n3,4\n")
    raw = read_trips_csv(spark, str(tmp_path))
    assert raw.count() == 2
    assert raw.where(F.col("ride_id").isNull()).count() == 2   # no trip columns in the file


def _zip_bytes(members: dict[str, bytes], compression=zipfile.ZIP_DEFLATED) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return buf.getvalue()


def test_one_csv_zip(spark, tmp_path):
    (tmp_path / "test.zip").write_bytes(_zip_bytes({"test.csv": csv_text([row("r1"), row("r2")]).encode()}))
    df = read_trips_zip(spark, str(tmp_path / "test.zip"))
    assert sorted(r.ride_id for r in df.collect()) == ["r1", "r2"]
    assert df.first().filename.endswith("test.zip/test.csv")


def test_nested_zip(spark, tmp_path):
    inner1 = _zip_bytes({"202301-a.csv": csv_text([row("a1"), row("a2")]).encode(),
                         "._202301-a.csv": b"junk"})
    inner2 = _zip_bytes({"202302-b.csv": csv_text([row("b1")], list(reversed(RAW_NAMES))).encode()})
    outer = _zip_bytes({"202301.zip": inner1, "202302.zip": inner2,
                        "top.csv": csv_text([row("t1")]).encode(),
                        "__MACOSX/._top.csv": b"junk", "empty.csv": b""})
    (tmp_path / "all.zip").write_bytes(outer)
    df = read_trips_zip(spark, str(tmp_path))
    got = {r.ride_id: r for r in df.collect()}
    assert sorted(got) == ["a1", "a2", "b1", "t1"]
    assert got["b1"].member_casual == "member" and got["b1"].end_lat == 40.7
    assert df.rdd.getNumPartitions() == 3


def test_parquet_month_partitions_roundtrip(spark, tmp_path, raw_df):
    raw = raw_df([("a", "2023-06-01 08:00:00", "2023-06-01 08:10:00", "1", "A", "member"),
                  ("b", "2023-07-01 08:00:00", "2023-07-01 08:10:00", "1", "A", "member")])
    path = str(tmp_path / "t")
    write_trips_by_month(raw, path, source_col="started_at")
    back = read_trips_by_month(spark, path, raw.schema)
    assert back.count() == 2
    pruned = back.where(F.col("trip_month") == "2023-07")
    assert "PartitionFilters: [isnotnull(trip_month" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 1


def test_empty_raw_and_month_from_name(spark):
    from rides.sources.csv import empty_raw, month_from_file_name

    e = empty_raw(spark)
    assert e.count() == 0 and e.columns[-1] == "filename" and len(e.columns) == len(RAW_NAMES) + 1
    df = spark.createDataFrame([("file:/x/202301-trips_1.csv",), ("file:/x/._a.csv",)],
                               "filename string")
    assert [r[0] for r in df.select(month_from_file_name()).collect()] == ["202301", None]


def test_streamed_nested_archives_roundtrip(spark, tmp_path, raw_df):
    from rides.sources.archive import write_trips_zip

    rows = [(f"r{i}", f"2023-06-{1 + i % 28:02d} 08:00:00", f"2023-06-{1 + i % 28:02d} 08:30:00",
             str(i % 4), f"S{i % 4}", "member" if i % 2 else "casual") for i in range(300)]
    raw = raw_df(rows)
    out = str(tmp_path / "zips")
    write_trips_zip(raw.repartition(3, "ride_id"), out)
    names = sorted(p.name for p in (tmp_path / "zips").iterdir())
    assert names == ["archive-00000.zip", "archive-00001.zip", "archive-00002.zip"]
    back = read_trips_zip(spark, out)
    assert back.rdd.getNumPartitions() == 3
    assert back.count() == 300
    assert back.select("ride_id", "member_casual").exceptAll(raw.select("ride_id", "member_casual")).count() == 0


def test_zip_extra_columns_are_ignored_not_inferred(spark, tmp_path):
    cols = RAW_NAMES[:5] + ["weird"] + RAW_NAMES[5:]
    rows = []
    for i in range(3):
        r = row(f"r{i}")
        r["weird"] = "1" if i < 2 else "not-a-number"
        rows.append(r)
    (tmp_path / "x.zip").write_bytes(_zip_bytes({"x.csv": csv_text(rows, cols).encode()}))
    got = read_trips_zip(spark, str(tmp_path / "x.zip")).collect()
    assert sorted(r.ride_id for r in got) == ["r0", "r1", "r2"]


def test_archive_ingest_reports_rows_per_member(spark, tmp_path):
    from rides.sources.archive import ingest_archives

    inner1 = _zip_bytes({"202301-a.csv": csv_text([row("a1", "2023-01-05 08:00:00", "2023-01-05 08:09:00"),
                                                   row("a2", "2023-01-06 08:00:00", "2023-01-06 08:09:00")]).encode()})
    inner2 = _zip_bytes({"202302-b.csv": csv_text([row("b1", "2023-02-05 08:00:00", "2023-02-05 08:09:00")]).encode()})
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "y.zip").write_bytes(_zip_bytes({"202301.zip": inner1, "202302.zip": inner2}))
    report = ingest_archives(spark, str(tmp_path / "src"), str(tmp_path / "raw"))
    assert report["rows"] == 3
    assert sorted((m["member"].rsplit("/", 1)[-1], m["rows_added"]) for m in report["members"]) == [
        ("202301-a.csv", 2), ("202302-b.csv", 1)]
    back = spark.read.parquet(str(tmp_path / "raw"))
    assert sorted(r.trip_month for r in back.select("trip_month").distinct().collect()) == ["2023-01", "2023-02"]


ODD = {"r1": ("NA", "NULL"), "r2": ('A "B" C', "null"), "r3": ("x, y", "n/a"), "r4": ("", "#N/A"), "r5": ("é", "NaN")}


def odd_csv(cols=None):
    import csv

    cols = cols or RAW_NAMES
    out = io.StringIO()
    w = csv.writer(out)
    w.writerow(cols)
    for rid, (name, sid) in ODD.items():
        r = row(rid) | {"start_station_name": name, "start_station_id": sid}
        w.writerow([r.get(c.strip(), "extra") for c in cols])
    return out.getvalue()


def test_both_readers_share_one_dialect(spark, tmp_path):
    """Null words are text, quotes are doubled, names hold blanks and percent
    signs, header names are stripped and a header may be long."""
    cols = [f" {RAW_NAMES[0]} ", *RAW_NAMES[1:-1], *[f"note{i:05d}" for i in range(9000)], RAW_NAMES[-1]]
    want = sorted((k, n or None, s) for k, (n, s) in ODD.items())
    for i, text in enumerate((odd_csv(), odd_csv(cols))):
        src, zips = tmp_path / f"in {i}", tmp_path / f"zip {i}"
        src.mkdir()
        zips.mkdir()
        (src / "a b%20[1].csv").write_text(text)
        (zips / "c d%.zip").write_bytes(_zip_bytes({"e f.csv": text.encode()}))
        for df in (read_trips_csv(spark, str(src)), read_trips_zip(spark, str(zips))):
            got = df.collect()
            assert sorted((r.ride_id, r.start_station_name, r.start_station_id) for r in got) == want
            assert {r.member_casual for r in got} == {"member"}
        assert read_trips_csv(spark, str(src)).first().filename.endswith("in %d/a b%%20[1].csv" % i)
        report = ingest(spark, str(src), str(tmp_path / f"raw{i}"))
        assert [f["rows_added"] for f in report["files"]] == [5]


def test_loads_append_or_replace_and_report_themselves(spark, tmp_path):
    src, target = tmp_path / "src", str(tmp_path / "raw")
    src.mkdir()
    (src / "a.csv").write_text(csv_text([row("r1")]))
    for mode, rows in (("append", 1), ("append", 2), ("replace", 1)):
        report = ingest(spark, str(src), target, mode=mode)
        assert report["rows"] == 1 and [f["rows_added"] for f in report["files"]] == [1]
        assert spark.read.parquet(target).count() == rows


def test_archive_report_names_every_member_and_skip(spark, tmp_path):
    from rides.sources.archive import ingest_archives

    members = {f"m{i:03d}.csv": csv_text([row(f"r{i}")]).encode() for i in range(310)}
    members |= {"x.csv": csv_text([row("x1"), row("x2")]).encode(), "readme.txt": b"no", "__MACOSX/._x.csv": b"no",
                "x.csv.zip": _zip_bytes({"x.csv": csv_text([row("n1")]).encode(), "empty.csv": b""})}
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "all.zip").write_bytes(_zip_bytes(members))
    report = ingest_archives(spark, str(tmp_path / "src"), str(tmp_path / "raw"))
    counts = {m["member"].split("all.zip/")[1]: m["rows_added"] for m in report["members"]}
    assert len(counts) == 312 and counts["x.csv"] == 2 and counts["x.csv.zip/x.csv"] == 1
    assert report["rows"] == 313 and all(n == 1 for m, n in counts.items() if m.startswith("m"))
    assert sorted((p.split("all.zip/")[1], why) for p, _, why in report["skipped"]) == [
        ("__MACOSX/._x.csv", "hidden folder"), ("readme.txt", "not a csv"), ("x.csv.zip/empty.csv", "empty")]


def test_archives_without_a_usable_member_raise(spark, tmp_path):
    from rides.sources.archive import ingest_archives

    (tmp_path / "no.zip").write_bytes(_zip_bytes({"readme.txt": b"no", "empty.csv": b""}))
    with pytest.raises(NoUsableFiles):
        ingest_archives(spark, str(tmp_path), str(tmp_path / "raw"))


def test_a_hot_month_is_split_and_small_months_share_a_task(spark, tmp_path, raw_df):
    from rides.sources.parquet import by_month

    plan = by_month(raw_df([("a", "2023-06-01 08:00:00", "2023-06-01 08:10:00", "1", "A", "member")]),
                    "started_at")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    hot = spark.range(400_000).selectExpr("cast(id as string) as ride_id", "timestamp_ntz'2023-06-01 00:00:00' as start_ts",
                                          "md5(cast(id as string)) as pad")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        write_trips_by_month(hot, str(tmp_path / "hot"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(list((tmp_path / "hot" / "trip_month=2023-06").glob("*.parquet"))) > 1
