"""What a build has on disk at once: products cross once, whole tables are dealt by slices of days."""

import datetime as dt
import glob
import re

from pyspark.sql import functions as F

from clickmarts import catalog_tables
from clickmarts.config import MartConfig
from clickmarts.operators.products import PRODUCT_COLUMNS, by_day_and_event, products_mart
from clickmarts.plans.events_mart import events_mart
from clickmarts.sources import snapshots
from clickmarts.sources.fixtures import raw_orders
from clickmarts.sources.shards import tag_shard
from clickmarts.sources.sinks import scratch_path
from clickmarts.sources.snapshots import MartTable

DAYS = [dt.date(2024, 1, d) for d in range(1, 21)]


def _counted(rows):
    return sorted(map(str, rows.collect()))


def _orders(spark) -> str:
    """Orders of three days a month with up to three lines each, and parts."""
    sf = scratch_path(spark, "t-sf")
    orders = [(i, i % 7, "FOP"[i % 3], 10.0 * i, dt.datetime(2024, 1 + i % 5, 1 + i % 3)) for i in range(120)]
    lines = [(i, (i * k) % 9, float(k)) for i in range(120) for k in range(i % 4)]
    parts = [(i, f"part {i}", f"brand {i}", f"type {i}", 1.25 * i) for i in range(9)]
    for name, rows, kind in (("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"),
                             ("lineitem", lines, "l_orderkey long, l_partkey long, l_quantity double"),
                             ("part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double")):
        spark.createDataFrame(rows, kind).write.parquet(f"{sf}/{name}.parquet")
    return sf


def test_products_cross_once_as_events(spark):
    """One exchange, of events; rows that repeat are still one, days and ids may be NULL."""
    cfg = MartConfig(id_scope="instant", window_layout="user")
    path = scratch_path(spark, "t-events")
    events_mart(tag_shard(raw_orders(spark, _orders(spark))), cfg).write.parquet(path)
    events = spark.read.parquet(path)
    events = events.withColumn("items", F.concat("items", F.slice("items", 1, 1))).union(events.limit(50))
    events = events.withColumn("date_tz", F.when(F.dayofmonth("date_tz") != 3, F.col("date_tz")))
    events = events.withColumn("id", F.when(F.col("event_bundle_sequence_id") % 13 != 0, F.col("id")))
    odd = scratch_path(spark, "t-odd-events")
    events.write.parquet(odd)
    events = spark.read.parquet(odd)
    mart = products_mart(by_day_and_event(events))
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange ", plan)) == 1 and "rangepartitioning(date_tz" in plan, plan[:3000]
    want = products_mart(events)
    assert mart.columns == want.columns and set(PRODUCT_COLUMNS) == set(mart.columns)
    assert _counted(mart) == _counted(want)
    table = MartTable(spark, scratch_path(spark, "t-products"))
    table.commit(mart, layout="dealt")
    assert _counted(table.read().select(*mart.columns)) == _counted(want)


def test_whole_tables_are_written_in_slices_of_days(spark, monkeypatch):
    rows = [(i, DAYS[i * i % 20] if i % 9 else None, [(1.5 * i, None)]) for i in range(200)]
    df = spark.createDataFrame(rows, "n int, date_tz date, r array<struct<x:double,y:string>>").repartition(4).withColumn("v", F.lit(None))
    sizes, write = [], MartTable._write_days
    monkeypatch.setattr(MartTable, "_write_days", lambda t, d, path: sizes.append(d.count()) or write(t, d, path))
    root = scratch_path(spark, "t-sliced").removeprefix("file:")
    table = MartTable(spark, root)
    made = table.stage(df, 1, "sliced")
    assert sum(sizes) == 200 and max(sizes) < 150 and len(sizes) > 2
    assert made[1] == sorted({str(d) if d else snapshots.NULL_DAY for _, d, _ in rows})
    got = spark.read.parquet(f"{root}/{made[0]}")
    assert _counted(got.select("n", "date_tz", "r")) == _counted(df.drop("v"))
    assert not glob.glob(f"{root.rpartition('/')[0]}/clickmarts-staged-*")
    folder, days = table.stage(df.limit(0), 2, "sliced")
    assert days == []


def test_landing_frees_its_shuffles(spark, monkeypatch):
    freed = []
    monkeypatch.setattr(catalog_tables, "free_shuffles", lambda s: freed.append(s))
    path = scratch_path(spark, "t-landed")
    catalog_tables._land(spark.createDataFrame([(1, "20240101"), (2, "20240102")], "n int, table_suffix string"), path)
    assert freed == [spark] and spark.read.parquet(path).count() == 2
