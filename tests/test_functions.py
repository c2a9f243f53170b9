import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from rides import functions as RF
from rides.functions.numeric import round_half_away


def one(spark, col, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(col.alias("v")).first()["v"]


PTS = "a double, b double, c double, d double"


def test_haversine_known_pair(spark):
    d = one(spark, RF.haversine_km("a", "b", "c", "d"), PTS, (40.6, -74.0, 40.7, -73.9))
    assert d == pytest.approx(13.957642696, abs=1e-9)


def test_haversine_same_point_and_null(spark):
    assert one(spark, RF.haversine_km("a", "b", "c", "d"), PTS, (40.6, -74.0, 40.6, -74.0)) == 0.0
    assert one(spark, RF.haversine_km("a", "b", "c", "d"), PTS, (40.6, -74.0, None, -74.0)) is None


def test_helpers_reject_column_objects():
    with pytest.raises(TypeError):
        RF.haversine_km(F.col("a"), "b", "c", "d")


def test_haversine_sql_function_matches(spark):
    from rides.functions.geo import haversine_sql_function

    haversine_sql_function(spark)
    v = spark.sql("select haversine_km(40.6, -74.0, 40.7, -73.9) as v").first()["v"]
    assert v == pytest.approx(13.957642696, abs=1e-9)


def test_surrogate_key(spark):
    from rides.functions.keys import NULL_PART

    assert one(spark, RF.surrogate_key("'abc'")) == hashlib.md5(b"abc").hexdigest()
    assert one(spark, RF.surrogate_key("cast(null as string)")) == \
        hashlib.md5(NULL_PART.encode()).hexdigest()
    assert one(spark, RF.surrogate_key("'a'", "7")) == hashlib.md5(b"a-7").hexdigest()


def test_weekday_sunday_is_zero_and_full_names(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1, 10), ), (dt.datetime(2023, 1, 7, 10), ),
                                (dt.datetime(2023, 1, 2, 10), )], "ts timestamp_ntz")
    from rides.functions.calendar import trip_date_sql, weekday_num_sql

    rows = df.select(RF.weekday_num("ts").alias("n"), RF.weekday_name(trip_date_sql("ts")).alias("w"),
                     RF.weekday_type(weekday_num_sql("ts")).alias("t")).collect()
    assert [(r.n, r.w, r.t) for r in rows] == [
        (0, "Sunday", "weekend"), (6, "Saturday", "weekend"), (1, "Monday", "weekday")]


def test_iso_week_of_new_year(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),)], "d date")
    assert df.select(F.weekofyear("d")).first()[0] == 52


def test_seasons_and_time_of_day(spark):
    df = spark.range(0, 24).select(F.col("id").alias("h"))
    cats = {r.h: r.c for r in df.select("h", RF.time_of_day("h").alias("c")).collect()}
    assert [h for h, c in cats.items() if c == "Rush Hour"] == [7, 8, 9, 16, 17, 18]
    assert [h for h, c in cats.items() if c == "Late Night"] == [0, 1, 2, 3, 4, 5, 22, 23]
    m = spark.range(0, 14).select(F.col("id").alias("m"))
    seasons = {r.m: r.s for r in m.select("m", RF.season("m").alias("s")).collect()}
    assert seasons[12] == seasons[1] == seasons[2] == "Winter"
    assert seasons[3] == "Spring" and seasons[6] == "Summer" and seasons[9] == "Fall"
    assert seasons[0] is None and seasons[13] is None


def test_duration_minutes_fractional(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 5, 1, 8, 0, 0), dt.datetime(2023, 5, 1, 8, 1, 30, 500000))],
                               "s timestamp_ntz, e timestamp_ntz")
    assert df.select(RF.duration_minutes("s", "e")).first()[0] == pytest.approx(90.5 / 60)


def test_round_half_away_matches_sql_engine_round(spark):
    """Equal doubles round equally in Spark and DuckDB, ties included."""
    import duckdb

    vals = [10.015, 0.125, -2.5, 1.005, 2.675, 1.0000005, 12.3456785, -0.0000005, 7 / 3]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for places in (1, 2, 6):
        got = [r[0] for r in df.select(round_half_away("x", places)).collect()]
        con = duckdb.connect()
        want = [con.execute(f"select round({v!r}::double, {places})").fetchone()[0] for v in vals]
        assert got == want, places
