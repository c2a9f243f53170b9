"""High-water-mark loads with upsert on ride_id."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from rides.operators.incremental import IncrementalTable, upsert
from rides.plans.staging import stg_trips


def stg(raw_df, rows):
    return stg_trips(raw_df(rows))


def T(s):
    return dt.datetime.fromisoformat(s)


def trip(rid, start, minutes=10, member="member"):
    s = T(start)
    return (rid, s, s + dt.timedelta(minutes=minutes), "1", "A", member)


def test_upsert_mark_late_rows_and_replacement(spark, raw_df):
    target = stg(raw_df, [trip("a", "2023-05-10 08:00:00"), trip("b", "2023-06-01 08:00:00")])
    batch = stg(raw_df, [
        trip("eq", "2023-06-01 08:00:00"),          # equal to the mark: skipped
        trip("late", "2023-05-20 08:00:00"),        # late: skipped
        trip("new", "2023-06-02 08:00:00"),
        trip("a", "2023-07-01 08:00:00", member="casual"),   # ride_id arrives again, later month
    ])
    out = {r.ride_id: r for r in upsert(target, batch).collect()}
    assert sorted(out) == ["a", "b", "new"]
    assert out["a"].member_casual == "casual" and out["a"].start_ts == T("2023-07-01 08:00:00")


def test_lookback_reloads_late_rows_idempotently(spark, raw_df):
    target = stg(raw_df, [trip("a", "2023-06-01 08:00:00")])
    batch = stg(raw_df, [trip("a", "2023-06-01 08:00:00"), trip("late", "2023-05-31 20:00:00")])
    out = upsert(target, batch, lookback=dt.timedelta(days=1)).collect()
    assert sorted(r.ride_id for r in out) == ["a", "late"]


def test_empty_target_loads_everything(spark, raw_df):
    target = stg(raw_df, [trip("x", "2023-06-01 08:00:00")]).where(F.lit(False))
    batch = stg(raw_df, [trip("a", "2023-06-01 08:00:00"), trip("b", "2023-06-02 08:00:00")])
    assert upsert(target, batch).count() == 2


def test_duplicates_within_a_batch_are_kept(spark, raw_df):
    target = stg(raw_df, [trip("a", "2023-06-01 08:00:00")])
    batch = stg(raw_df, [trip("d", "2023-06-02 08:00:00"), trip("d", "2023-06-03 08:00:00")])
    assert upsert(target, batch).where(F.col("ride_id") == "d").count() == 2


def test_table_rewrites_touched_months_only(spark, raw_df, tmp_path):
    path = str(tmp_path / "stg")
    table = IncrementalTable(spark, path)
    first = stg(raw_df, [trip("a", "2023-05-10 08:00:00"), trip("b", "2023-06-01 08:00:00"),
                         trip("c", "2023-04-01 08:00:00")])
    assert table.load(first)["mode"] == "full"
    schema = first.schema
    april = table.version()["months"]["2023-04"]
    batch = stg(raw_df, [trip("a", "2023-07-01 08:00:00", member="casual"),
                         trip("n", "2023-06-05 08:00:00")])
    summary = table.load(batch)
    assert summary["months"] == ["2023-05", "2023-06", "2023-07"]
    back = {r.ride_id: r for r in table.read(schema).collect()}
    assert sorted(back) == ["a", "b", "c", "n"] and back["a"].member_casual == "casual"
    # May lost its only row to July and is no month of the version; April was not rewritten
    assert sorted(table.version()["months"]) == ["2023-04", "2023-06", "2023-07"]
    assert table.version()["months"]["2023-04"] == april
    # loading the same batch again changes nothing
    assert table.load(batch)["months"] == []
    assert table.read(schema).count() == 4
    # full refresh replaces everything
    table.load(first, full_refresh=True)
    assert sorted(r.ride_id for r in table.read(schema).collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("stop_at", ["write_trips_by_month", "after_one_month", "filters", "manifest",
                                     "pointer", "delete_dir"])
def test_load_stopped_half_way_changes_nothing_and_is_done_by_the_next(spark, raw_df, tmp_path, monkeypatch,
                                                                       stop_at):
    """Stop the load before, within or after the writes: the table is whole, as
    before or (once the pointer is written) as after; the next load finishes."""
    from rides.operators import key_filter as KF
    from rides.sources import parquet as PQ

    table = IncrementalTable(spark, str(tmp_path / "stg"))
    first = stg(raw_df, [trip("a", "2023-05-10 08:00:00"), trip("b", "2023-06-01 08:00:00"),
                         trip("c", "2023-06-02 08:00:00")])
    table.load(first)
    batch = stg(raw_df, [trip("a", "2023-07-01 08:00:00", member="casual"),
                         trip("june", "2023-06-20 08:00:00"), trip("late", "2023-06-01 09:00:00")])

    def stopped(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        write, text = PQ.write_trips_by_month, PQ.write_text
        if stop_at == "after_one_month":
            def some(df, *args, **kwargs):      # only the newest month gets written
                write(df.where("start_ts >= '2023-07-01'"), *args, **kwargs)
                stopped()
            m.setattr(PQ, "write_trips_by_month", some)
        elif stop_at == "filters":
            m.setattr(KF, "build_filters", stopped)
        elif stop_at in ("manifest", "pointer"):
            part = "_versions" if stop_at == "manifest" else "_current"
            m.setattr(PQ, "write_text", lambda p, t: stopped() if part in p else text(p, t))
        else:
            m.setattr(PQ, stop_at, stopped)
        with pytest.raises(RuntimeError):
            table.load(batch)
    there = sorted(r.ride_id for r in table.read(first.schema).collect())
    assert there == (["a", "b", "c", "june"] if stop_at == "delete_dir" else ["a", "b", "c"])
    table.load(batch)                                   # same batch again
    rows = {r.ride_id: r for r in table.read(first.schema).collect()}
    assert sorted(rows) == ["a", "b", "c", "june"] and rows["a"].member_casual == "casual"
    assert table.read(first.schema).count() == 4
    assert table.load(batch)["months"] == []
    table.vacuum(keep=1)
    left = {p.name.split("=")[1] for p in (tmp_path / "stg").iterdir() if p.name.startswith("snap=")}
    assert left == set(table.version()["months"].values())
    assert table.read(first.schema).count() == 4


def test_stopped_full_load_is_not_taken_for_a_table(spark, raw_df, tmp_path, monkeypatch):
    from rides.sources import parquet as PQ

    table = IncrementalTable(spark, str(tmp_path / "stg"))
    first = stg(raw_df, [trip("a", "2023-05-10 08:00:00"), trip("b", "2023-06-01 08:00:00")])
    real = PQ.write_trips_by_month

    def some(df, *args, **kwargs):
        real(df.where("ride_id = 'b'"), *args, **kwargs)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(PQ, "write_trips_by_month", some)
    with pytest.raises(RuntimeError):
        table.load(first)
    monkeypatch.setattr(PQ, "write_trips_by_month", real)
    table.load(first)
    assert sorted(r.ride_id for r in table.read(first.schema).collect()) == ["a", "b"]


def test_batch_of_new_keys_reads_no_old_month(spark, raw_df, tmp_path):
    """The old months' files are spoilt: a load that opened one would fail."""
    table = IncrementalTable(spark, str(tmp_path / "stg"))
    old = stg(raw_df, [trip(f"k{i}", f"2023-0{1 + i % 4}-10 08:00:00") for i in range(400)])
    table.load(old)
    files = [p for p in (tmp_path / "stg").glob("snap=*/trip_month=*/*.parquet")]
    kept = {p: p.read_bytes() for p in files}
    for p in files:
        p.write_bytes(b"spoilt")
        (p.parent / f".{p.name}.crc").unlink(missing_ok=True)
    summary = table.load(stg(raw_df, [trip(f"n{i}", "2023-06-01 08:00:00") for i in range(300)]))
    assert summary["months"] == ["2023-06"] and summary["months_read"] == []
    for p, data in kept.items():
        p.write_bytes(data)
    assert table.read(old.schema).count() == 700
    # a key of one old month: that month alone is looked into
    summary = table.load(stg(raw_df, [trip("k2", "2023-07-01 08:00:00")]))
    assert summary["months"] == ["2023-03", "2023-07"] and summary["months_read"] == ["2023-03"]
    assert table.read(old.schema).count() == 700
    assert {r.ride_id for r in table.read(old.schema, ["2023-07"]).collect()} == {"k2"}


def test_reader_stays_on_its_version(spark, raw_df, tmp_path):
    table = IncrementalTable(spark, str(tmp_path / "stg"))
    first = stg(raw_df, [trip("a", "2023-05-10 08:00:00"), trip("b", "2023-06-01 08:00:00")])
    table.load(first)
    reader = table.read(first.schema)
    table.load(stg(raw_df, [trip("a", "2023-07-01 08:00:00")]))
    table.load(stg(raw_df, [trip("z", "2022-01-01 08:00:00")]), full_refresh=True)
    assert sorted(r.ride_id for r in reader.collect()) == ["a", "b"]
    assert [r.ride_id for r in table.read(first.schema).collect()] == ["z"]


def test_last_writer_of_a_batch_and_rows_without_a_key(spark, raw_df, tmp_path):
    from rides.operators.incremental import last_writer

    table = IncrementalTable(spark, str(tmp_path / "stg"))
    rows = [trip("d", "2023-06-02 08:00:00"), trip("d", "2023-06-03 08:00:00"), trip("d", "2023-06-01 08:00:00"),
            trip("tie", "2023-06-02 08:00:00", 10), trip("tie", "2023-06-02 08:00:00", 20),
            trip(None, "2023-06-02 08:00:00"), trip(None, "2023-06-02 08:00:00"), trip("same", "2023-06-05 08:00:00"),
            trip("same", "2023-06-05 08:00:00")]
    batch = stg(raw_df, rows)
    table.load(batch)
    got = sorted((r.ride_id or "", str(r.start_ts), str(r.end_ts)) for r in table.read(batch.schema).collect())
    assert got == [("", "2023-06-02 08:00:00", "2023-06-02 08:10:00")] * 2 + [
        ("d", "2023-06-03 08:00:00", "2023-06-03 08:10:00"),
        ("same", "2023-06-05 08:00:00", "2023-06-05 08:10:00"),
        ("tie", "2023-06-02 08:00:00", "2023-06-02 08:20:00")]
    # rows without a key never match: a second load adds its own
    table.load(stg(raw_df, [trip(None, "2023-06-07 08:00:00"), trip("d", "2023-07-03 08:00:00")]))
    assert table.read(batch.schema).count() == 6
    assert upsert(batch.where("false"), batch, repeated="last").count() == 5
    assert last_writer(batch, "ride_id", ["end_ts"]).columns == batch.columns


def test_replayed_epoch_is_taken_once(spark, raw_df, tmp_path):
    table = IncrementalTable(spark, str(tmp_path / "stg"))
    batch = stg(raw_df, [trip(None, "2023-06-02 08:00:00"), trip("a", "2023-06-02 08:00:00")])
    for epoch in (0, 1, 1, 0):
        table.load(batch, every_row=True, epoch=("q", epoch))
    assert table.read(batch.schema).count() == 3        # two batches' rows without a key, and one of a


def test_folder_of_an_older_release_is_not_taken_for_an_empty_table(spark, raw_df, tmp_path):
    from rides.sources.parquet import write_trips_by_month
    from rides.sources.versions import UnversionedTable

    batch = stg(raw_df, [trip("a", "2023-06-02 08:00:00")])
    write_trips_by_month(batch, str(tmp_path / "stg"))
    table = IncrementalTable(spark, str(tmp_path / "stg"))
    with pytest.raises(UnversionedTable):
        table.load(batch)
    table.load(batch, full_refresh=True)
    assert table.read(batch.schema).count() == 1


def _loaded(table, schema):
    return sorted((r.ride_id or "", str(r.start_ts), str(r.end_ts), r.member_casual)
                  for r in table.read(schema).collect())


def test_repeated_keys_are_told_apart_by_key_and_order_alone(spark, raw_df, tmp_path, monkeypatch):
    """No whole row is shuffled by its key, in the batch or in the months, unless
    a tie remains; with too many rows to mark the outcome is the same."""
    from rides.operators import incremental as I, row_marks as M

    first = stg(raw_df, [trip(f"k{i}", f"2023-0{1 + i % 4}-10 08:00:00") for i in range(40)]
                + [trip(None, "2023-02-10 08:00:00")] * 3)
    again = stg(raw_df, [trip(f"k{i}", f"2023-0{1 + (i + j) % 5}-1{j} 09:00:00", member="casual")
                         for i in range(30) for j in (0, 2, 1)]
                + [trip(None, "2023-02-10 08:00:00"), trip(None, "2023-05-10 08:00:00")])
    ties = stg(raw_df, [trip("t", "2023-06-02 08:00:00", m) for m in (10, 30, 20)]
               + [trip("t", "2023-06-01 08:00:00", 90), trip("u", "2023-06-02 08:00:00"),
                  trip("u", "2023-07-02 08:00:00"), trip("k39", "2023-06-02 08:00:00")])
    seen = []
    for most in (M.MOST_ROWS, 0):
        table = IncrementalTable(spark, str(tmp_path / f"stg{most}"))
        with monkeypatch.context() as m:
            m.setattr(M, "MOST_ROWS", most)
            if most:
                for name in ("last_writer", "replaced"):
                    m.setattr(I, name, lambda *a: pytest.fail("whole rows were shuffled by key"))
            table.load(first)
            table.load(again, every_row=True)
        with monkeypatch.context() as m:
            m.setattr(M, "MOST_ROWS", most)
            table.load(ties, every_row=True)
        seen.append(_loaded(table, first.schema))
    assert seen[0] == seen[1]
    want = [("", "2023-02-10 08:00:00")] * 4 + [("", "2023-05-10 08:00:00")]
    want += [(f"k{i}", str(max(T(f"2023-0{1 + (i + j) % 5}-1{j} 09:00:00") for j in (0, 1, 2)))) for i in range(30)]
    want += [(f"k{i}", f"2023-0{1 + i % 4}-10 08:00:00") for i in range(30, 39)]
    want += [("k39", "2023-06-02 08:00:00"), ("t", "2023-06-02 08:00:00"), ("u", "2023-07-02 08:00:00")]
    assert [(k, s) for k, s, _, _ in seen[0]] == sorted(want)
    assert [e for k, _, e, _ in seen[0] if k == "t"] == ["2023-06-02 08:30:00"]


def test_marked_rows_are_left_out_of_several_blocks_and_files(spark, tmp_path):
    from rides.operators import row_marks as M

    path, n = str(tmp_path / "rows"), 2 * M.BLOCK_ROWS + 1000
    spark.range(2 * n, numPartitions=2).write.parquet(path)
    rows = spark.read.schema("id long").parquet(path)
    gone = f"id % 7 = 3 or id between {M.BLOCK_ROWS - 5} and {M.BLOCK_ROWS + 5} or id = {2 * n - 1}"
    left = M.without(rows, M.marks(M.placed(rows, "id").where(gone)))
    assert left.columns == ["id"]
    assert left.exceptAll(spark.range(2 * n).where(f"not ({gone})")).isEmpty()
    assert left.count() == spark.range(2 * n).where(f"not ({gone})").count()
    assert M.without(rows, M.marks(M.placed(rows, "id").where("false"))).count() == 2 * n


def test_rows_without_a_key_are_not_shuffled_by_it(spark, raw_df, tmp_path):
    """They would all meet in one task."""
    table = IncrementalTable(spark, str(tmp_path / "stg"))
    first = stg(raw_df, [trip(None, "2023-05-10 08:00:00")] * 50 + [trip("a", "2023-05-11 08:00:00")])
    table.load(first)
    kept = table._kept(first, first.schema, table.version(), ["2023-05"], str(tmp_path / "staging"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(ride_id" not in plan and "LeftAnti" not in plan
    assert kept.count() == 50
