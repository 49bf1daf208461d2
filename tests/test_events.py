from pyspark.sql import functions as F

from clickmarts.config import MartConfig
from clickmarts.plans.events_mart import events_mart, prepare_events
from tests.builders import kv, raw_df


def _by_bundle(df, *cols):
    return {r.event_bundle_sequence_id: tuple(r[c] for c in cols)
            for r in df.select("event_bundle_sequence_id", *cols).collect()}


def test_channel_branches_and_three_valued_logic(spark, raw_schema):
    rows = [
        dict(bundle=1, url="https://ex.com/?gclid=G1&utm_source=s"),                        # (a) cpc
        dict(bundle=2, url="https://ex.com/?wbraid=W"),                                      # (a) via wbraid
        dict(bundle=3, url="https://ex.com/?utm_source=news&utm_medium=email"),             # (b)
        dict(bundle=4, url="https://ex.com/?utm_source=p&utm_medium=referral",
             ignore_referrer="true", referrer="https://r.org/x"),                           # ignored referral -> (d)
        dict(bundle=5, url="https://ex.com/?utm_source=p", ignore_referrer="true",
             referrer="https://r.org/x"),                                                   # NULL medium: 3VL -> not (b), (c) blocked -> (d)
        dict(bundle=6, url="https://ex.com/", referrer="https://ref.site.org:8443/y?z=1"),  # (c) referral
        dict(bundle=7, url="https://ex.com/"),                                              # (d) direct
        dict(bundle=8, url="https://ex.com/", sts_source="(not set)", cts={"manual_source": "mail"}),  # slug ignored
    ]
    df = prepare_events(raw_df(spark, raw_schema, rows))
    got = _by_bundle(df.select("event_bundle_sequence_id",
                               F.col("event_traffic_source.source").alias("s"),
                               F.col("event_traffic_source.medium").alias("m"),
                               F.col("event_traffic_source.campaign").alias("c")), "s", "m", "c")
    assert got[1] == ("google", "cpc", "(not set)")
    assert got[2] == ("google", "cpc", "(not set)")
    assert got[3] == ("news", "email", "(not set)")
    assert got[4] == ("(direct)", "(none)", "(not set)")
    assert got[5] == ("(direct)", "(none)", "(not set)")
    assert got[6] == ("ref.site.org", "referral", "(not set)")
    assert got[7] == ("(direct)", "(none)", "(not set)")
    assert got[8] == ("mail", "(not set)", "(not set)")


def test_null_user_gets_distinct_deterministic_ids(spark, raw_schema):
    rows = [dict(bundle=i, user=None, t=float(i), url="https://ex.com/") for i in range(3)]
    a = prepare_events(raw_df(spark, raw_schema, rows)).select("user_pseudo_id", "has_null_user_pseudo_id")
    b = prepare_events(raw_df(spark, raw_schema, rows)).select("user_pseudo_id")
    ids = sorted(r[0] for r in a.collect())
    assert len(set(ids)) == 3 and all(i.startswith("anon-") for i in ids)
    assert ids == sorted(r[0] for r in b.collect())
    assert all(r[1] for r in a.collect())


def test_session_id_backfill_window(spark, raw_schema):
    rows = [
        dict(bundle=1, t=0, gsid=111), dict(bundle=2, t=1700),           # 1700 s after a known id -> 111
        dict(bundle=3, t=5000), dict(bundle=4, t=6700, gsid=222),        # looks forward 1700 s -> 222
        dict(bundle=5, t=20000),                                         # nothing within 1800 s -> own second
        dict(bundle=6, t=30000, gsid=333), dict(bundle=7, t=30000.5, gsid=444),
        dict(bundle=8, t=31000),                                         # same-second tie: last by rank -> 444
        dict(bundle=9, t=40000, gsid=555), dict(bundle=10, t=41800.9),   # exactly 1800 whole seconds -> 555
        dict(bundle=11, t=50000, gsid=666), dict(bundle=12, t=51801),    # 1801 s -> own second
    ]
    ev = events_mart(raw_df(spark, raw_schema, rows)).withColumn(
        "b", F.col("event_bundle_sequence_id"))
    got = {r.b: r.ga_session_id for r in ev.select("b", "ga_session_id").collect()}
    own = lambda t: int(str(1_704_067_200_000_000 + int(t * 1e6))[:10])
    assert got[2] == 111 and got[3] == 222 and got[5] == own(20000)
    assert got[8] == 444 and got[10] == 555 and got[12] == own(51801)


def test_navigation_and_sequence(spark, raw_schema):
    rows = [
        dict(bundle=1, t=0, gsid=9, name="session_start", url="https://ex.com/s"),
        dict(bundle=2, t=1, gsid=9, name="page_view", url="https://ex.com/a"),
        dict(bundle=3, t=2, gsid=9, name="scroll", url="https://ex.com/a"),
        dict(bundle=4, t=3, gsid=9, name="page_view", url="https://ex.com/b", host=None),
        dict(bundle=5, t=9.7, gsid=9, name="page_view", url="https://ex.com/c"),
    ]
    ev = events_mart(raw_df(spark, raw_schema, rows))
    got = _by_bundle(ev, "event_sequence", "page_sequence", "is_entrance", "is_exit",
                     "previous_page_path", "next_page_path", "next_next_page_path", "seconds_on_page")
    assert got[1] == (None, None, None, None, None, None, None, None)   # session_start: no sequence
    assert got[2] == (1, 1, True, False, "Entrance", "Exit", "ex.com/c/", 2)   # next path NULL -> 'Exit'
    assert got[3][:2] == (2, None)
    assert got[4] == (3, 2, False, False, "ex.com/a/", "ex.com/c/", "Exit", 6)
    # the previous page has a NULL path (no hostname): reads 'Entrance' like a missing one
    assert got[5] == (4, 3, False, True, "Entrance", "Exit", "Exit", None)


def test_event_ids_unique_and_scope(spark):
    from clickmarts.catalog import r_events
    for scope in ("scan", "instant"):
        ev = r_events(spark, "/root/testdata/sf0.001", MartConfig(id_scope=scope))
        n, d = ev.agg(F.count("*"), F.count_distinct("id")).first()
        assert n == d == 1000


def test_events_mart_column_order(spark, raw_schema):
    from clickmarts.operators.events import EVENT_COLUMNS
    ev = events_mart(raw_df(spark, raw_schema, [dict(bundle=1, url="https://ex.com/")]))
    assert tuple(ev.columns) == EVENT_COLUMNS and len(EVENT_COLUMNS) == 86
