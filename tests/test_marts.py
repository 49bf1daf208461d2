"""Batches and refreshes through all marts, and live sessions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tests.builders import kv, raw_row

from clickmarts.config import MartConfig
from clickmarts.operators.products import products_mart
from clickmarts.plans.events_mart import events_mart
from clickmarts.plans.marts import Marts
from clickmarts.plans.sessions_mart import sessions_mart
from clickmarts.sources.shards import tag_shard
from clickmarts.sources.sinks import scratch_path

DAY = 86400
CFG = MartConfig(window_layout="user", last_non_direct_lookback=3)


def visit(user, day, hour=12, **more):
    """A session_start, a page view and a purchase with an item on one day."""
    t = day * DAY + hour * 3600
    item = {"item_id": f"i{day}"}
    base = dict(user=user, gsid=1704067200 + t, params=[kv("session_engaged", i=1), kv("engagement_time_msec", s="7", i=7)])
    return [dict(name="session_start", t=t, url="https://ex.com/a?x=1", **base, **more),
            dict(name="page_view", t=t + 1, url="https://ex.com/b", **base, **more),
            dict(name="purchase", t=t + 2, items=[item], **base, **more)]


def rows(df):
    keys = sorted(c for c, t in df.dtypes if not t.startswith(("array", "struct")))
    return sorted(map(repr, df.select(*keys).collect()))


@pytest.fixture
def shop(spark, raw_schema):
    """(add rows, marts): raw rows that have landed so far, and the marts over them."""
    landed = []
    item = next(f.dataType.elementType for f in raw_schema.fields if f.name == "items")

    def make(r):
        r = dict(r)
        r["items"] = [{f.name: i.get(f.name) for f in item.fields} for i in r.get("items") or []]
        return raw_row(raw_schema, **r)

    def frame(some):
        return spark.createDataFrame([make(r) for r in some], raw_schema)

    marts = Marts(spark, scratch_path(spark, "t-marts"), lambda: frame(landed), CFG)
    return landed, frame, marts


def full(frame, landed, cfg):
    events = events_mart(tag_shard(frame(landed)), cfg)
    return {"events": events, "sessions": sessions_mart(events, cfg), "products": products_mart(events)}


def check(marts, frame, landed):
    for name, want in full(frame, landed, marts.cfg).items():
        assert rows(getattr(marts, name).read()) == rows(want), name


def test_batches_through_all_marts_exactly_once(shop, monkeypatch):
    landed, frame, marts = shop
    batches = [visit("u1", 0, sts_source="ads", sts_medium="x") + visit("u2", 0),
               visit("u1", 2) + visit("u3", 2, sts_source="mail"),
               visit("u1", 1, sts_source="late", sts_medium="y") + visit("u2", 4)]  # day 1 comes late
    for i, some in enumerate(batches):
        landed += some
        marts.apply_batch(frame(some), i)
        check(marts, frame, landed)
    versions = {t: getattr(marts, t).versions() for t in ("events", "sessions", "products")}
    for i, some in enumerate(batches):
        marts.apply_batch(frame(some), i)  # replayed: nothing new
    assert versions == {t: getattr(marts, t).versions() for t in versions}
    assert marts.together() == {"events": 3, "sessions": 3, "products": 3}
    assert [(e["batch"], e["state"]) for e in marts.ledger()] == [(0, "done"), (1, "done"), (2, "done")]

    # The driver dies between the events and the sessions of a batch; its replay catches up.
    more = visit("u2", 5, sts_source="again")
    landed += more
    monkeypatch.setattr(marts, "follow", lambda: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        marts.apply_batch(frame(more), 3)
    assert marts.ledger()[-1]["state"] == "events" and marts.together()["events"] == 3
    monkeypatch.undo()
    marts.apply_batch(frame(more), 3)
    assert marts.events.versions() == [1, 2, 3, 4] and marts.ledger()[-1]["state"] == "done"
    check(marts, frame, landed)


def test_late_data_rewrites_only_the_days_it_changes(shop):
    """An old session becomes non-direct: a later session of the user within the lookback
    changes, one beyond it and other users' days do not."""
    landed, frame, marts = shop
    landed += [r for d in range(0, 12) for r in visit(f"other{d}", d)]
    landed += visit("u1", 1) + visit("u1", 3) + visit("u1", 9)
    marts.build()
    before = marts.sessions.manifest()
    late = visit("u1", 1, hour=2, sts_source="news", sts_medium="mail")
    landed += late
    marts.apply_batch(frame(late), 0)
    check(marts, frame, landed)
    assert [d[-2:] for d in marts.sessions.manifest().changed] == ["02", "04"]  # days 1 and 3
    kept = {d: f for d, f in before.days.items() if d not in marts.sessions.manifest().changed}
    assert all(marts.sessions.manifest().days[d] == f for d, f in kept.items())


def test_refresh_and_a_day_that_loses_its_rows(shop):
    landed, frame, marts = shop
    landed += visit("u1", 0) + visit("u1", 4) + visit("u2", 5)
    marts.refresh()
    check(marts, frame, landed)
    del landed[3:6]  # day 4 was exported by mistake
    marts.refresh()
    check(marts, frame, landed)
    assert "2024-01-05" not in marts.sessions.manifest().days
    version = marts.sessions.versions()
    marts.follow()
    assert marts.sessions.versions() == version


def _live(spark, raw, **more):
    from clickmarts.catalog import _run_live_sessions
    return {r["session_id"]: r for r in _run_live_sessions(spark, raw, **more).collect()}


def test_live_sessions_are_those_of_the_batch_and_2050_swallows_none(spark, raw_schema):
    """Back-filled ids over slice edges; a client clock in 2050 must not close later users' slices."""
    rows_ = []
    for d in range(6):
        t = d * DAY + 10 * 3600 + 1750  # around the edge of a middle hour (half past)
        rows_ += [dict(user=f"u{d % 2}", t=t, name="session_start"), dict(user=f"u{d % 2}", t=t + 60, gsid=1000 + d),
                  dict(user=f"u{d % 2}", t=t + 1800, name="scroll"), dict(user=f"u{d % 2}", t=t + 3700, name="scroll")]
    rows_ += [dict(user="bot", t=600.0 * i, gsid=77 if i % 5 == 0 else None) for i in range(6 * 144)]
    rows_.append(dict(user="clock", t=26 * 365.25 * DAY, suffix="20240102", gsid=5))
    rows_.append(dict(user="end", t=9 * DAY, gsid=6))  # the day that closes all slices before it
    raw = spark.createDataFrame([raw_row(raw_schema, **r) for r in rows_], raw_schema)
    got = _live(spark, raw, files_per_trigger=1)
    batch = events_mart(tag_shard(raw), MartConfig(id_scope="instant", window_layout="user")).where("user_pseudo_id <> 'end'")
    want = {r["session_id"]: r for r in batch.groupBy("session_id", "user_pseudo_id").agg(
        F.count("*").alias("events"), F.max("event_timestamp_utc").alias("last")).collect()}
    assert {k: (r["user_pseudo_id"], r["events"]) for k, r in got.items()} == {
        k: (r["user_pseudo_id"], r["events"]) for k, r in want.items()}
    clock = next(r for r in got.values() if r["user_pseudo_id"] == "clock")
    assert clock["last_event_at_utc"] > dt.datetime(2049, 1, 1)
