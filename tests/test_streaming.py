"""File-arrival loading on Structured Streaming."""

from rides.schema import RAW_NAMES
from rides.sources.parquet import read_trips_by_month
from rides.streaming import start_trip_stream


def _csv(rows, cols=RAW_NAMES):
    out = [",".join(cols)]
    for rid, start, end, member in rows:
        vals = {"ride_id": rid, "rideable_type": "classic_bike", "started_at": start,
                "ended_at": end, "start_station_name": "A", "start_station_id": "1",
                "end_station_name": "B", "end_station_id": "2", "start_lat": "40.6",
                "start_lng": "-74.0", "end_lat": "40.7", "end_lng": "-73.9",
                "member_casual": member}
        out.append(",".join(vals[c] for c in cols))
    return "\n".join(out) + "\n"


def test_waves_late_rows_replacements_and_restart(spark, tmp_path):
    from rides.plans.staging import stg_trips
    from rides.schema import RAW_WITH_FILE

    landing, table, ckpt = tmp_path / "landing", str(tmp_path / "table"), str(tmp_path / "ckpt")
    landing.mkdir()
    (landing / "w1.csv").write_text(_csv([("a", "2023-06-01 08:00:00", "2023-06-01 08:10:00", "member"),
                                          ("b", "2023-06-02 08:00:00", "2023-06-02 08:10:00", "member")]))
    start_trip_stream(spark, str(landing), table, ckpt, available_now=True).awaitTermination()
    # second wave: a late row (before the mark), a new row and a ride that arrives again
    (landing / "w2.csv").write_text(_csv(
        [("late", "2023-05-30 08:00:00", "2023-05-30 08:10:00", "casual"),
         ("c", "2023-06-03 08:00:00", "2023-06-03 08:10:00", "casual"),
         ("a", "2023-07-01 08:00:00", "2023-07-01 08:10:00", "casual")],
        list(reversed(RAW_NAMES))))
    start_trip_stream(spark, str(landing), table, ckpt, available_now=True).awaitTermination()
    schema = stg_trips(spark.createDataFrame([], RAW_WITH_FILE)).schema
    got = {r.ride_id: r for r in read_trips_by_month(spark, table, schema).collect()}
    assert sorted(got) == ["a", "b", "c", "late"]
    assert got["a"].member_casual == "casual" and str(got["a"].start_ts) == "2023-07-01 08:00:00"
    # a restart on the same checkpoint sees no new files and changes nothing
    start_trip_stream(spark, str(landing), table, ckpt, available_now=True).awaitTermination()
    assert read_trips_by_month(spark, table, schema).count() == 4


def test_outcome_does_not_depend_on_the_batches(spark, tmp_path):
    """Newest trips first, a ride in two files: one file a trigger gives what
    one trigger for all gives."""
    import os

    from rides.plans.staging import stg_trips
    from rides.schema import RAW_WITH_FILE

    landing = tmp_path / "landing"
    landing.mkdir()
    for i, month in enumerate((9, 8, 7, 6)):
        rows = [(f"m{month}", f"2023-0{month}-05 08:00:00", f"2023-0{month}-05 08:10:00", "member"),
                ("again", f"2023-0{month}-06 08:00:00", f"2023-0{month}-06 08:10:00", "casual")]
        (landing / f"f{i}.csv").write_text(_csv(rows))
        os.utime(landing / f"f{i}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
    schema = stg_trips(spark.createDataFrame([], RAW_WITH_FILE)).schema
    seen = []
    for n in (1, 2, 1000):
        table = str(tmp_path / f"table{n}")
        start_trip_stream(spark, str(landing), table, str(tmp_path / f"ckpt{n}"), max_files_per_trigger=n,
                          available_now=True).awaitTermination()
        seen.append(sorted((r.ride_id, str(r.start_ts)) for r in read_trips_by_month(spark, table, schema).collect()))
    assert seen[0] == seen[1] == seen[2]
    assert [r for r, _ in seen[0]] == ["again", "m6", "m7", "m8", "m9"] and seen[0][0][1] == "2023-06-06 08:00:00"
