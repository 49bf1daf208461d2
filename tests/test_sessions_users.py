import datetime as dt

from pyspark.sql import functions as F

from clickmarts.config import MartConfig
from clickmarts.operators.users import users_rollup
from clickmarts.plans.events_mart import events_mart
from clickmarts.plans.sessions_mart import sessions_mart
from tests.builders import BASE_MICROS, kv, raw_df

DAY = 86400.0


def _sid(user, gsid):
    import hashlib
    return hashlib.md5(f"{user}-{gsid}".encode()).hexdigest()


def _sessions(spark, raw_schema, rows, cfg=MartConfig()):
    return sessions_mart(events_mart(raw_df(spark, raw_schema, rows), cfg), cfg)


def test_session_rules(spark, raw_schema):
    rows = [
        # session 1: two session_start rows at the same instant; the non-direct one wins
        dict(bundle=1, t=0, gsid=1, name="session_start", url="https://ex.com/a"),
        dict(bundle=2, t=0, gsid=1, name="session_start", url="https://ex.com/b?utm_source=x&utm_medium=cpc"),
        dict(bundle=3, t=5, gsid=1, name="page_view", url="https://ex.com/a",
             params=[kv("session_engaged", s="1"), kv("engagement_time_msec", i=1500)]),
        dict(bundle=4, t=65.5, gsid=1, name="page_view", url="https://ex.com/c",
             params=[kv("engagement_time_msec", i=500)]),
        # session 2: no session_start -> no output row
        dict(bundle=5, t=100000, gsid=2, name="page_view", url="https://ex.com/a"),
        # session 3: start only, no engagement parameter, no page view
        dict(bundle=6, t=200000, gsid=3, name="session_start", url="https://ex.com/z"),
    ]
    s = _sessions(spark, raw_schema, rows)
    got = {r.id: r for r in s.collect()}
    assert set(got) == {_sid("u1", 1), _sid("u1", 3)}
    s1, s3 = got[_sid("u1", 1)], got[_sid("u1", 3)]
    assert s1.landing_page == "ex.com/b/" and s1.last_source == "x" and s1.last_medium == "cpc"
    assert (s1.page_views, s1.is_engaged, s1.is_bounce, s1.engaged_seconds) == (2, 1, 0, 2.0)
    assert s1.duration_seconds == 65 and s1.event_count == 4
    assert (s3.page_views, s3.is_engaged, s3.is_bounce) == (None, None, None)
    assert len(s.columns) == 123


def test_last_non_direct_lookback(spark, raw_schema):
    def rows(gap_days):
        return [
            dict(bundle=1, t=0, gsid=1, name="session_start", url="https://ex.com/?utm_source=ads&utm_medium=cpc"),
            dict(bundle=2, t=gap_days * DAY, gsid=2, name="session_start", url="https://ex.com/"),
        ]
    for gap, expect in ((90, "ads"), (91, "(direct)")):
        s = _sessions(spark, raw_schema, rows(gap), MartConfig(last_non_direct_lookback=90))
        later = s.where(F.col("id") == _sid("u1", 2)).first()
        assert later.last_source == "(direct)"
        assert later.last_non_direct_source == expect, gap
        assert later.last_non_direct_source_medium == ("ads / cpc" if expect == "ads" else "(direct) / (none)")


def test_one_row_per_session_and_user(spark):
    from clickmarts.catalog import r_sessions
    s = r_sessions(spark, "/root/testdata/sf0.001")
    n, d = s.agg(F.count("*"), F.count_distinct("id")).first()
    assert n == d and n > 0
    u = users_rollup(s)
    n, d = u.agg(F.count("*"), F.count_distinct("id")).first()
    assert n == d and n > 0


def test_users_fanout_multiplies_sums(spark, raw_schema):
    rows = []
    b = 0
    for g, pv in ((1, 1), (2, 2), (3, 3)):
        b += 1
        rows.append(dict(bundle=b, t=g * 10000, gsid=g, name="session_start", url="https://ex.com/"))
        for j in range(pv):
            b += 1
            rows.append(dict(bundle=b, t=g * 10000 + j + 1, gsid=g, name="page_view", url="https://ex.com/p"))
    s = _sessions(spark, raw_schema, rows)
    dedup = users_rollup(s).first()
    ref = users_rollup(s, fanout="reference").first()
    assert dedup.page_views == 6 and ref.page_views == 18
    assert dedup.sessions == ref.sessions == 3
    assert dedup.first_session_start_at_utc == ref.first_session_start_at_utc == \
        dt.datetime.fromtimestamp((BASE_MICROS + 10000 * 1_000_000) / 1e6, dt.UTC).replace(tzinfo=None)
