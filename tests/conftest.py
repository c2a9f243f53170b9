import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rides.session import get_session

    s = get_session("local[4]", app="rides-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def raw_df(spark):
    """Build raw trips from tuples: (ride_id, start, end, station_id, station_name,
    member_casual[, start_lat, start_lng, end_lat, end_lng])."""
    import datetime as dt

    from rides.schema import RAW_WITH_FILE

    def ts(v):
        return dt.datetime.fromisoformat(v) if isinstance(v, str) else v

    def make(rows):
        out = []
        for r in rows:
            rid, s, e, sid, sname, mc = r[:6]
            lat1, lng1, lat2, lng2 = (list(r[6:10]) + [40.6, -74.0, 40.6, -74.0])[:4] \
                if len(r) > 6 else (40.6, -74.0, 40.6, -74.0)
            out.append((rid, "classic_bike", ts(s), ts(e), sname, sid, sname, sid,
                        lat1, lng1, lat2, lng2, mc, "fixture.csv"))
        return spark.createDataFrame(out, RAW_WITH_FILE)

    return make
