"""Each declared check finds exactly one planted violation."""

import datetime as dt

from rides.operators import quality as Q
from rides.plans import checks as C
from rides.plans.build import build


def test_quality_checks_each_find_one_violation(spark):
    df = spark.createDataFrame(
        [(1, "a", "member", 5, 1), (2, "a", "casual", -1, 2), (None, "b", "other", 3, 1),
         (4, None, None, 2, None)],
        "id int, k string, rider string, n int, flag int")
    parent = spark.createDataFrame([("a",)], "k string")
    got = Q.union_all([
        Q.not_null(df, "t", ["id", "k"]),
        Q.unique(df, "t", "k"),
        Q.accepted_values(df, "t", "rider", ["member", "casual"]),
        Q.values_in_set(df, "t", "flag", [0, 1]),
        Q.relationships(df, "t", "k", parent, "k"),
        Q.expression_is_false(df, "t", "n", "n < 0"),
    ]).collect()
    assert sorted((r.check_name, r.column_name, r.violations) for r in got) == [
        ("accepted_values", "rider", 1), ("nonnegative", "n", 1), ("not_null", "id", 1),
        ("not_null", "k", 1), ("relationships", "k", 1), ("unique", "k", 1),
        ("values_in_set", "flag", 1)]


def test_freshness_levels(spark):
    src = spark.createDataFrame([(dt.datetime(2023, 6, 1, 12),)], "ended_at timestamp_ntz")
    status = lambda as_of: Q.freshness(src, "t", "ended_at", as_of).first().status
    assert status("2023-06-02 11:00:00") == "pass"
    assert status("2023-06-02 13:00:00") == "warn"
    assert status("2023-06-03 13:00:00") == "error"


def test_declared_suite_counts_and_clean_models(spark, raw_df):
    base = dt.datetime(2023, 6, 5, 8)
    rows = [(f"r{i}", base + dt.timedelta(hours=i), base + dt.timedelta(hours=i, minutes=9),
             str(i % 3), f"S{i % 3}", "member" if i % 2 else "casual") for i in range(30)]
    m = build(raw_df(rows))
    out = C.run_all(m).collect()
    kinds = {}
    for r in out:
        kinds[r.check_name] = kinds.get(r.check_name, 0) + 1
    assert kinds == {"not_null": 31, "unique": 6, "accepted_values": 3, "values_in_set": 2,
                     "relationships": 2, "nonnegative": 2}
    assert all(r.violations == 0 for r in out)


def test_unique_with_key_counts_both(spark):
    df = spark.createDataFrame([("k1", "a"), ("k1", "a"), ("k2", "b"), ("k3", None), ("k3", None), (None, None), (None, None)],
                               "trip_sk string, ride_id string")
    got = {r.column_name: r.violations for r in Q.unique_with_key(df, "t", "trip_sk", "ride_id").collect()}
    assert got == {"trip_sk": 2, "ride_id": 1}
    got = {r.column_name: r.violations for r in Q.unique_with_key(df.limit(0), "t", "trip_sk", "ride_id").collect()}
    assert got == {"trip_sk": 0, "ride_id": 0}
