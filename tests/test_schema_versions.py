"""Merging of schemas and shards of different versions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmarts.sources.fixtures import raw_events, raw_orders
from clickmarts.sources.schema import conform, merge_schemas, merge_types, raw_schema, read_evolved, read_versions
from clickmarts.sources.sinks import scratch_path

SF = "/root/testdata/sf0.001"


def ddl(text):
    return T.StructType.fromDDL(text)


def test_merge_is_recursive_and_widens_field_by_field(spark):
    a = ddl("x int, r struct<a:int,b:array<struct<k:string,n:int>>>, m map<string,float>, d decimal(5,2), v void")
    b = ddl("r struct<b:array<struct<n:bigint,z:date>>,c:string>, X bigint, m map<string,double>, d decimal(9,4), v string, new boolean")
    assert merge_schemas([a, b]) == ddl(
        "x bigint, r struct<a:int,b:array<struct<k:string,n:bigint,z:date>>,c:string>, m map<string,double>, d decimal(9,4), "
        "v string, new boolean")
    with pytest.raises(TypeError, match=r"r\.b\[\]\.n: int and string"):
        merge_schemas([a, ddl("r struct<b:array<struct<n:string>>>")])
    with pytest.raises(TypeError):
        merge_types(T.LongType(), T.DoubleType(), "n")  # would lose digits


def test_conform_fills_and_widens(spark):
    have = spark.createDataFrame([(1, (2, [("k", 3)]), {"a": 1.5}), (None, None, None), (4, (None, [None]), {})],
                                 "x int, r struct<a:int,b:array<struct<k:string,n:int>>>, m map<string,float>")
    want = ddl("new date, m map<string,double>, r struct<a:bigint,b:array<struct<n:bigint,k:string,z:date>>,c:string>, x bigint")
    out = conform(have, want)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in want]
    rows = sorted(out.collect(), key=lambda r: (r["x"] is None, r["x"]))
    assert rows[0]["r"]["b"][0].asDict() == {"n": 3, "k": "k", "z": None} and rows[0]["m"] == {"a": 1.5} and rows[0]["new"] is None
    assert rows[1]["r"]["b"] == [None] and rows[1]["r"]["a"] is None and rows[2]["r"] is None and rows[2]["m"] is None


def test_raw_schema_holds_the_fixtures(spark):
    want = raw_schema()
    for raw in (raw_events(spark, SF), raw_orders(spark, SF)):
        own = T.StructType([f for f in raw.schema.fields if f.name in want.names])
        assert set(own.names) == set(want.names)
        assert merge_schemas([want, own]).simpleString() == merge_schemas([want]).simpleString()


def test_shards_of_three_versions(spark):
    path = scratch_path(spark, "t-versions")
    shards = [("20240101", "event_name string, event_timestamp int", [("a", 1)]),
              ("20240102", "event_name string, event_timestamp int", [("b", 2)]),
              ("20240103", "event_name string, event_timestamp bigint, device struct<category:string>", [("c", 2**40, ("tablet",))]),
              ("intraday_20240104", "event_timestamp bigint, extra string, device struct<web_info:struct<hostname:string>>",
               [(4, "not read", (("h",),))])]
    for suffix, schema, rows in shards:
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/table_suffix={suffix}")
    assert [v.shards for v in read_versions(spark, path)] == [("20240101", "20240102"), ("20240103",), ("intraday_20240104",)]
    df = read_evolved(spark, path)
    assert df.columns == [*raw_schema().names, "table_suffix"]
    got = {r["table_suffix"]: r for r in df.collect()}
    assert got["20240101"]["event_timestamp"] == 1 and got["20240101"]["device"] is None
    assert got["20240103"]["device"]["category"] == "tablet" and got["20240103"]["device"]["web_info"] is None
    assert got["intraday_20240104"]["device"]["web_info"]["hostname"] == "h" and got["intraday_20240104"]["event_name"] is None
    assert got["20240103"]["event_timestamp"] == 2**40 and got["20240101"]["collected_traffic_source"] is None
    recent = read_evolved(spark, path, first_day=dt.date(2024, 1, 3))
    assert sorted(r[0] for r in recent.select("table_suffix").collect()) == ["20240103", "intraday_20240104"]
    pruned = df.where(F.col("table_suffix") == "20240103").select("event_name")
    assert [r[0] for r in pruned.collect()] == ["c"]
    assert read_evolved(spark, scratch_path(spark, "t-no-shards")).count() == 0
