import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from clickmarts.functions.keys import surrogate_key
from clickmarts.functions.params import param, param_numeric, value_as_string
from clickmarts.functions.timeparts import date_from_micros, duration_seconds, hour_from_micros
from clickmarts.functions.urls import (URL_PART_PATTERNS, decode_common_escapes, trailing_slash,
                                       url_param, url_part)
from clickmarts.oracle import part as sql_part

UNIT_URLS = ["https://www.ex.com:8443/a/b?x=1&y=2#frag", "https://ex.com", "ex.com/p/", "",
             "android-app://com.foo/x", "https://ex.com/p?", "http://u@h/p", "//cdn.x/y", "/only/path"]


def test_url_param_unanchored_and_not_decoded(spark):
    df = spark.createDataFrame([("https://a.b/?utm_campaign_id=7&x=%20y",), ("https://a.b/?campaign_id=&q",),
                                (None,)], "u string")
    got = df.select(url_param("u", "campaign_id").alias("c"), url_param("u", "x").alias("x")).collect()
    assert got[0].c == "7"          # matches inside utm_campaign_id
    assert got[0].x == "%20y"       # not decoded
    assert got[1].c is None         # empty value -> NULL
    assert got[2].c is None


@pytest.mark.parametrize("part_name", sorted(URL_PART_PATTERNS))
def test_url_parts_agree_with_sql_engine(spark, part_name):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(UNIT_URLS)], "i int, u string")
    got = {r.i: r.v for r in df.select("i", url_part(F.col("u"), part_name).alias("v")).collect()}
    con = duckdb.connect()
    con.execute("create table t as select * from (values " +
                ",".join(f"({i}, '{u}')" for i, u in enumerate(UNIT_URLS)) + ") v(i, u)")
    want = dict(con.execute(f"select i, {sql_part(part_name, 'u')} from t").fetchall())
    assert got == want


def test_url_parts_examples(spark):
    df = spark.createDataFrame([(UNIT_URLS[0],), ("",)], "u string")
    r = df.select(*[url_part(F.col("u"), p).alias(p) for p in URL_PART_PATTERNS]).collect()
    assert (r[0].protocol, r[0].hostname, r[0].port, r[0].path, r[0].query, r[0].fragment) == \
        ("https", "www.ex.com", "8443", "/a/b", "x=1&y=2", "frag")
    assert all(v is None for v in r[1])  # no match at all -> NULL, not ''


def test_trailing_slash(spark):
    df = spark.createDataFrame([(None,), ("/a",), ("/a/",), ("",)], "p string")
    assert [r.v for r in df.select(trailing_slash("p").alias("v")).collect()] == ["/", "/a/", "/a/", "/"]


def test_decode_common_escapes_order(spark):
    df = spark.createDataFrame([("a%2Fb%3Fc%252B%2541",)], "s string")
    # %25 is decoded mid-chain: %252B -> %2B -> '+', while %2541 -> %41 stays.
    assert df.select(decode_common_escapes("s").alias("v")).first().v == "a/b?c+%41"


def test_surrogate_key_matches_md5(spark):
    df = spark.createDataFrame([("u1", 5), (None, None)], "a string, b long")
    got = [r.k for r in df.select(surrogate_key("a", "b").alias("k")).collect()]
    assert got[0] == hashlib.md5(b"u1-5").hexdigest()
    assert got[1] == hashlib.md5(b"_null_-_null_").hexdigest()


def test_param_lookup_slots_and_missing(spark, raw_schema):
    from tests.builders import kv, raw_df
    df = raw_df(spark, raw_schema, [
        dict(params=[kv("a", s="x"), kv("n", i=3), kv("f", f=1.5), kv("d", d=2.5)]),
        dict(params=[]),
    ])
    ep = F.col("event_params")
    rows = df.select(param(ep, "a").alias("a"), param(ep, "n", "int_value").alias("n"),
                     param(ep, "zz").alias("zz"), param_numeric(ep, "n").alias("pn"),
                     param_numeric(ep, "f").alias("pf"), param_numeric(ep, "d").alias("pd")).collect()
    assert tuple(rows[0]) == ("x", 3, None, 3.0, 1.5, None)   # double slot never read
    assert tuple(rows[1]) == (None, None, None, None, None, None)


def test_value_as_string_priority(spark):
    df = spark.createDataFrame([(None, 4, None, None), (None, None, None, 2.5), (None, None, None, None)],
                               "string_value string, int_value long, float_value double, double_value double")
    out = df.select(value_as_string(F.struct(*df.columns), "(not set)").alias("v")).collect()
    assert [r.v for r in out] == ["4", "2.5", "(not set)"]


def test_time_parts_independent_of_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1_704_153_599_999_999,)], "m long")  # 2024-01-01 23:59:59.999999 UTC
        r = df.select(hour_from_micros("m").alias("h"), date_from_micros("m").alias("d")).first()
        assert r.h == 23 and str(r.d) == "2024-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_duration_seconds_floor_and_null(spark):
    df = spark.createDataFrame([(0, 2_500_000), (5_000_000, 1_000_000), (0, None)], "a long, b long")
    ts = df.select(F.timestamp_micros("a").alias("a"), F.timestamp_micros("b").alias("b"))
    assert [r.d for r in ts.select(duration_seconds("a", "b").alias("d")).collect()] == [2, 0, 0]
