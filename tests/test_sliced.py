"""The time-sliced (skew-robust) windows give exactly the per-user results."""

from pyspark.sql import functions as F

from clickmarts.config import MartConfig
from clickmarts.operators.users import users_rollup
from clickmarts.plans.events_mart import events_mart
from clickmarts.plans.sessions_mart import sessions_mart
from tests.builders import raw_df

H = 3600.0


def _edge_rows():
    """One busy user whose sessions and page views straddle many slice edges."""
    rows, b = [], 0
    spec = [
        # (t, gsid or None, name)
        (0, 1, "session_start"), (10, 1, "page_view"), (H - 1, 1, "page_view"),      # end of slice 0
        (H + 5, 1, "scroll"),                                                       # slice 1: no page view
        (3 * H + 2, 1, "page_view"),                                                # slice 3: single page view
        (3 * H + 3, None, "page_view"),                                             # NULL id, filled from 1s before
        (4 * H - 900, None, "user_engagement"),                                     # NULL id, filled forward (slice edge)
        (4 * H + 800, 2, "session_start"), (4 * H + 801, 2, "page_view"),
        (6 * H + 0.5, 2, "page_view"), (6 * H + 0.5, 2, "first_visit"),             # same instant
        (9 * H, None, "page_view"),                                                 # nothing near: own second
        (9 * H + 1700, 3, "page_view"), (9 * H + 1700, 3, "session_start"),
        (10 * H + 3, 3, "page_view"), (10 * H + 4, 3, "page_view"), (11 * H, 3, "page_view"),
    ]
    for t, g, name in spec:
        b += 1
        rows.append(dict(bundle=b, t=t, gsid=g, name=name, url=f"https://ex.com/p{b}",
                         host=None if b == 9 else "ex.com",
                         referrer="https://r.org/" if b % 4 == 0 else None))
    # a second user with a single event
    rows.append(dict(bundle=100, t=50, gsid=7, name="session_start", user="u2", url="https://ex.com/x"))
    return rows


def _rows(df):
    cols = sorted(c for c in df.columns if not isinstance(df.schema[c].dataType, (
        __import__("pyspark.sql.types", fromlist=["ArrayType"]).ArrayType,
        __import__("pyspark.sql.types", fromlist=["StructType"]).StructType)))
    return sorted(tuple(r) for r in df.select(*cols).collect()), cols


def test_sliced_events_equal_user_layout(spark, raw_schema):
    raw = raw_df(spark, raw_schema, _edge_rows())
    small = dict(slice_seconds=3600)
    a = events_mart(raw, MartConfig(window_layout="user"))
    b = events_mart(raw, MartConfig(window_layout="sliced", **small))
    ra, ca = _rows(a)
    rb, cb = _rows(b)
    assert ca == cb and ra == rb
    got = {r.event_bundle_sequence_id: r for r in b.collect()}
    assert got[6].ga_session_id == 1 and got[7].ga_session_id == 2
    assert got[5].page_sequence == 3 and got[5].prev_prev_page_path == "ex.com/p2/"
    assert got[6].page_sequence == 4 and got[6].previous_page_event_id == got[5].id


def test_sliced_sessions_and_auto_threshold(spark, raw_schema):
    raw = raw_df(spark, raw_schema, _edge_rows())
    user = MartConfig(window_layout="user")
    auto_low = MartConfig(window_layout="auto", skew_threshold_rows=5, session_slice_seconds=3600)
    s_user = sessions_mart(events_mart(raw, user), user)
    s_auto = sessions_mart(events_mart(raw, auto_low), auto_low)
    assert _rows(s_user) == _rows(s_auto)
    assert _rows(users_rollup(s_user)) == _rows(users_rollup(s_auto))


def test_sliced_fixture_matches(spark):
    from clickmarts.catalog import r_events
    cols = ["id", "session_id", "event_sequence", "page_sequence", "previous_page_event_id",
            "next_next_page_path", "is_exit"]
    a = r_events(spark, "/root/testdata/sf0.001", MartConfig(window_layout="user")).select(*cols)
    b = r_events(spark, "/root/testdata/sf0.001", MartConfig(window_layout="sliced")).select(*cols)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_one_user_with_a_third_of_all_rows(spark):
    """A bot owning ~1/3 of the events: all layouts agree, and the split layout
    sends only the bot through the sliced windows."""
    from clickmarts.catalog import r_raw
    from clickmarts.operators import sliced
    raw = r_raw(spark, "/root/testdata/sf0.001").withColumn(
        "user_pseudo_id",
        F.when(F.col("event_bundle_sequence_id") % 3 == 0, F.lit("bot")).otherwise(F.col("user_pseudo_id")))
    n_bot = raw.where(F.col("user_pseudo_id") == "bot").count()
    assert n_bot * 3 >= raw.count() - 3
    # the bot's events spread over many (user, hour) slices
    slices = raw.where(F.col("user_pseudo_id") == "bot").select(
        sliced.slice_of(F.col("event_timestamp"), 3600).alias("s")).distinct().count()
    assert slices > 100
    cols = ["id", "session_id", "ga_session_id", "event_sequence", "page_sequence",
            "previous_page_event_id", "prev_prev_page_path", "next_next_page_path", "is_exit",
            "seconds_on_page"]
    out = {}
    for name, cfg in (("user", MartConfig(window_layout="user")),
                      ("split", MartConfig(window_layout="auto", skew_threshold_rows=100)),
                      ("sliced", MartConfig(window_layout="sliced"))):
        ev = events_mart(raw, cfg)
        s = sessions_mart(ev, cfg)
        out[name] = (sorted(map(tuple, ev.select(*cols).collect())),
                     sorted(map(tuple, s.select("id", "last_non_direct_source", "page_views",
                                                "event_count").collect())))
    assert out["user"] == out["split"] == out["sliced"]
    layout, _, hot = sliced.plan_layout(raw, "auto", "user_pseudo_id", 100)
    assert layout == "split" and [r[0] for r in hot.collect()] == ["bot"]


def test_a_counted_maximum_holds_for_its_own_frame_only(spark, raw_schema):
    """A union with, or a table holding, a user with more rows is counted anew."""
    from clickmarts.operators.sliced import known_max_rows
    from clickmarts.sources.sinks import scratch_path
    cfg = MartConfig(skew_threshold_rows=5)
    few = events_mart(raw_df(spark, raw_schema, [dict(t=i, user="u") for i in range(3)]), cfg)
    many = events_mart(raw_df(spark, raw_schema, [dict(t=i, user="bot", gsid=i) for i in range(9)]), MartConfig(window_layout="user"))
    assert known_max_rows(few) == 3 and known_max_rows(few.unionByName(many)) is None
    path = scratch_path(spark, "t-bound")
    few.write.parquet(path)
    assert known_max_rows(spark.read.parquet(path)) is None and known_max_rows(few.where("true")) is None
