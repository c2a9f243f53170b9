"""Operators against brute-force Python on random small inputs."""

import datetime as dt
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from rides.functions.calendar import minutes_from_micros_sql
from rides.operators.monthly import month_over_month
from rides.operators.percentiles import exact_stats
from rides.operators.ranking import rank_within
from rides.operators.rolling import rolling_stats

SETTINGS = dict(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 7200)), min_size=1, max_size=60))
def test_percentiles_match_linear_interpolation(spark, rows):
    df = spark.createDataFrame([(g, s * 1_000_000) for g, s in rows], "g long, us long")
    out = exact_stats(df, ["g"], "us", minutes_from_micros_sql,
                      {"p50": 0.5, "p25": 0.25, "p75": 0.75}, count_name="n", mean_name="mean")
    got = {r.g: r for r in out.collect()}
    for g in {g for g, _ in rows}:
        mins = np.array([s / 60 for gg, s in rows if gg == g])
        r = got[g]
        assert r.n == len(mins)
        assert r.mean == pytest.approx(mins.mean(), rel=1e-12)
        for name, q in (("p50", 50), ("p25", 25), ("p75", 75)):
            assert getattr(r, name) == pytest.approx(np.percentile(mins, q), rel=1e-12, abs=1e-12)


def _brute_rolling(values, n):
    out = []
    for i in range(len(values)):
        w = values[max(0, i - n + 1): i + 1]
        out.append(sum(w) / len(w))
    return out


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(1, 50)), min_size=1, max_size=45,
                unique_by=lambda t: t[0]))
def test_rolling_frames_count_rows_not_days(spark, rows):
    rows = sorted(rows)
    base = dt.date(2023, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(days=d), v) for d, v in rows],
                               "d date, v long")
    out = [r for r in rolling_stats(df, "d", "v", {"a7": 7, "a30": 30}, {"s30": 30})
           .orderBy("d").collect()]
    vals = [v for _, v in rows]
    for r, a7, a30, i in zip(out, _brute_rolling(vals, 7), _brute_rolling(vals, 30), range(len(vals))):
        assert r.a7 == pytest.approx(a7) and r.a30 == pytest.approx(a30)
        w = vals[max(0, i - 29): i + 1]
        mu = sum(w) / len(w)
        assert r.s30 == pytest.approx(math.sqrt(sum((x - mu) ** 2 for x in w) / len(w)), abs=1e-9)


@settings(**SETTINGS)
@given(st.dictionaries(st.integers(0, 30), st.integers(1, 500), min_size=1, max_size=20))
def test_month_over_month_uses_previous_observed_month(spark, months):
    rows = [(dt.date(2020 + m // 12, m % 12 + 1, 1 + (k % 27)), v // 3 + k)
            for m, v in months.items() for k in range(3)]
    df = spark.createDataFrame(rows, "d date, v long")
    got = [(r.month_start, r.month_total, r.prev_month_total, r.mom_percent_change)
           for r in month_over_month(df, "d", "v").orderBy("month_start").collect()]
    totals = {}
    for d, v in rows:
        key = d.replace(day=1)
        totals[key] = totals.get(key, 0) + v
    prev = None
    for (m, total, p, pct), key in zip(got, sorted(totals)):
        assert (m, total, p) == (key, totals[key], prev)
        assert pct == (None if prev is None else pytest.approx((total - prev) * 100.0 / prev))
        prev = total


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["Mon", "Tue"]), st.integers(0, 6)), min_size=1,
                max_size=30))
def test_rank_has_ties_and_gaps(spark, rows):
    data = [(w, f"s{i}", n) for i, (w, n) in enumerate(rows)]
    df = spark.createDataFrame(data, "w string, s string, n long")
    got = {r.s: r.r for r in rank_within(df, ["w"], "n", name="r").collect()}
    for w, s, n in data:
        assert got[s] == 1 + sum(1 for ww, _, nn in data if ww == w and nn > n)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.permutations(["ride_id", "member_casual", "start_station_id", "start_lat"]),
                min_size=1, max_size=3),
       st.data())
def test_csv_columns_are_read_by_name(spark, tmp_path_factory, layouts, data):
    from rides.sources.csv import read_trips_csv

    d = tmp_path_factory.mktemp("csv")
    expected = {}
    for i, cols in enumerate(layouts):
        keep = data.draw(st.integers(1, len(cols)))
        cols = list(cols[:keep]) if "ride_id" in cols[:keep] else ["ride_id"] + list(cols[:keep])
        lines = [",".join(cols)]
        for j in range(3):
            rec = {"ride_id": f"f{i}r{j}", "member_casual": "member" if j % 2 else "casual",
                   "start_station_id": str(10 * i + j), "start_lat": str(40.0 + i + j / 10)}
            lines.append(",".join(rec[c] for c in cols))
            expected[rec["ride_id"]] = {c: rec[c] for c in cols}
        (d / f"file{i}.csv").write_text("\n".join(lines) + "\n")
    got = {r.ride_id: r for r in read_trips_csv(spark, str(d)).collect()}
    assert set(got) == set(expected)
    for rid, rec in expected.items():
        r = got[rid]
        assert r.member_casual == rec.get("member_casual")
        assert r.start_station_id == rec.get("start_station_id")
        assert r.start_lat == (float(rec["start_lat"]) if "start_lat" in rec else None)


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.floats(-80, 80), st.floats(-179, 179), st.floats(-80, 80),
                          st.floats(-179, 179)), min_size=1, max_size=20))
def test_haversine_matches_plain_python(spark, pts):
    from rides.functions.geo import EARTH_RADIUS_KM, haversine_km

    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    for (lat1, lon1, lat2, lon2), g in zip(pts, got):
        h = (math.sin(math.radians((lat2 - lat1) / 2)) ** 2
             + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2))
             * math.sin(math.radians((lon2 - lon1) / 2)) ** 2)
        if h > 1.0:                       # rounding just past 1: ASIN gives NaN in SQL
            assert math.isnan(g)
            continue
        want = 2 * EARTH_RADIUS_KM * math.asin(math.sqrt(h))
        assert g == pytest.approx(want, rel=1e-9, abs=1e-6)
