"""Rollups from written tables, numbered anonymous events, one-pass URL parts."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.builders import kv, raw_df, raw_row

from clickmarts.config import MartConfig
from clickmarts.functions.urls import URL_PART_PATTERNS, url_part, url_parts
from clickmarts.operators.users import users_rollup
from clickmarts.plans.events_mart import events_mart
from clickmarts.plans.sessions_mart import sessions_mart
from clickmarts.sources.fixtures import raw_events
from clickmarts.sources.shards import tag_shard
from clickmarts.sources.sinks import scratch_path

SF = "/root/testdata/sf0.001"
FUSED, NARROW = MartConfig(window_layout="user"), MartConfig(window_layout="user", rollup="narrow")


@pytest.fixture(scope="module")
def written(spark):
    path = scratch_path(spark, "t-rollup-events")
    events_mart(tag_shard(raw_events(spark, SF)), FUSED).write.parquet(path)
    return spark.read.parquet(path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_sessions_from_a_written_table(spark, written):
    narrow = sessions_mart(written, NARROW)
    assert _rows(narrow) == _rows(sessions_mart(written, FUSED))
    doubled = written.union(written)  # every event twice: counted once
    assert _rows(sessions_mart(doubled, NARROW).select("id", "event_count")) == _rows(narrow.select("id", "event_count"))


def _exchanges(df):
    """Aggregates below each hash exchange of the plan, by the line of the exchange."""
    lines = _plan(df).split("\n")
    return [(line, lines[i + 1]) for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]


def test_one_wide_exchange_of_reduced_rows(spark, written):
    found = _exchanges(sessions_mart(written, NARROW))
    wide = [below for _, below in found if "min_by" in below or "minby" in below.lower()]
    assert len(wide) == 1 and "partial_min_by" in wide[0] and "composite" not in wide[0]
    # The others carry distinct keys, their counts, and session rows by user.
    keys = [re.search(r"hashpartitioning\(([^)]*)\)", line)[1] for line, _ in found]
    names = sorted(tuple(re.sub(r"#\d+L?", "", k).split(", ")[:-1]) for k in keys)
    pair = ("user_pseudo_id", "session_id")
    assert len(names) == 4 and names.count(pair) == 2 and ("user_pseudo_id",) in names, names


def test_users_from_written_sessions_take_one_exchange(spark, written):
    path = scratch_path(spark, "t-rollup-sessions")
    sessions_mart(written, NARROW).write.parquet(path)
    sessions = spark.read.parquet(path)
    users = users_rollup(sessions)
    assert len(re.findall("Exchange hashpartitioning", _plan(users))) == 1
    # Sums of doubles depend on the order of the rows.
    exact = lambda df: _rows(df.withColumn("total_engaged_seconds", F.round("total_engaged_seconds", 6)))
    assert exact(users) == exact(users_rollup(sessions, unique_sessions=False))
    twice = users_rollup(sessions.union(sessions), unique_sessions=False)
    assert _rows(twice.select("id", "sessions")) == _rows(users.select("id", "sessions"))


def test_equal_anonymous_events_are_numbered(spark, raw_schema):
    rows = [dict(user=None, t=5, bundle=1, gsid=7), dict(user=None, t=5, bundle=1, gsid=7),
            dict(user=None, t=5, bundle=1, gsid=7, params=[kv("x", s="y")]), dict(user=None, t=6, bundle=1), dict(user="u", t=5)]
    cfg = MartConfig(window_layout="user", number_anonymous=True)
    seen = set()
    for order in (rows, rows[::-1]):
        df = raw_df(spark, raw_schema, order).repartition(3)
        mart = events_mart(df, cfg)
        got = {(r["user_pseudo_id"], r["id"], r["session_id"], len(r["event_params"])) for r in mart.collect()}
        assert len(got) == 5 and len({g[0] for g in got}) == 5 and len({g[1] for g in got}) == 5
        assert sum(g[0].endswith("-2") for g in got) == sum(g[0].endswith("-3") for g in got) == 1
        seen.add(frozenset(got))
        plain = {r["user_pseudo_id"] for r in events_mart(df, MartConfig(window_layout="user")).collect()}
        assert plain == {g[0] for g in got if not re.search("-[23]$", g[0])}
    assert len(seen) == 1


def test_ranks_of_rows_that_differ_in_content_only(spark, raw_schema):
    """Same user, time, name and bundle: the same row gets the same id on every run."""
    rows = [dict(t=1, bundle=1, gsid=3, params=[kv("n", i=i)]) for i in range(6)]
    ids = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        for scope in ("instant", "scan"):
            mart = events_mart(raw_df(spark, raw_schema, order).repartition(4), MartConfig(window_layout="user", id_scope=scope))
            ids.add(frozenset((r["id"], next(p["value"]["int_value"] for p in r["event_params"] if p["key"] == "n"))
                              for r in mart.collect()))
    assert len(ids) == 1 and len(next(iter(ids))) == 6


def test_lenient_engagement(spark, raw_schema):
    rows = [dict(t=1, params=[kv("engagement_time_msec", s="12x")]), dict(t=2, params=[kv("engagement_time_msec", s="1500")])]
    mart = events_mart(raw_df(spark, raw_schema, rows), MartConfig(window_layout="user", strict_engagement=False))
    assert sorted((r["engagement_time_sec"] for r in mart.collect()), key=str) == [1.5, None]


URLS = ["https://www.ex.com:8443/a/b?x=1&y=2#frag", "https://ex.com", "ex.com/p/", "", None, "android-app://com.foo/x",
        "https://ex.com/p?", "http://u@h/p", "//cdn.x/y", "/only/path", "https://ex.com/a\nb?c\nd#e\nf", "https://ex.com#", "::", "?",
        "a:b:c:1/2", "https://é.com/ü?ß#ö", "https://ex.com:80", "mailto:a@b.c", " http://x.y/z", "http://x.y/$1\\$2?$3#$4"]


def test_all_parts_of_one_match(spark):
    alphabet = st.text(alphabet="ahx:/?#@ .1é\n$\\&=", max_size=24)
    made = []

    @settings(max_examples=400, deadline=None, database=None)
    @given(alphabet)
    def collect(url):
        made.append(url)
    collect()
    df = spark.createDataFrame([(u,) for u in URLS + sorted(set(made))], "url string")
    one = url_parts(F.col("url"))
    rows = df.select("url", *[one[p].alias(p) for p in URL_PART_PATTERNS],
                     *[url_part(F.col("url"), p).alias(f"own_{p}") for p in URL_PART_PATTERNS]).collect()
    assert len(rows) > 300
    for r in rows:
        assert all(r[p] == r[f"own_{p}"] for p in URL_PART_PATTERNS), r


def test_one_pattern_for_all_parts_in_the_plan(spark, raw_schema):
    mart = events_mart(raw_df(spark, raw_schema, [dict(t=1, url="https://a.b/c?d=e#f")]), FUSED)
    row = raw_row(raw_schema, t=1, url="https://a.b/c?d=e#f")
    assert row["event_name"] == "page_view" and mart.first()["page_query"] == "d=e"
    assert not any(p in _plan(mart) for k, p in URL_PART_PATTERNS.items() if k in ("path", "query", "fragment", "port"))
