from pyspark.sql import functions as F

from clickmarts.operators.event_params import event_params_mart
from clickmarts.operators.products import products_mart
from clickmarts.plans.events_mart import events_mart
from tests.builders import kv, raw_df


def _item(item_id, name="n", brand=None, qty=1):
    from clickmarts.sources.fixtures import ITEM_STRING_FIELDS
    d = {f: None for f in ITEM_STRING_FIELDS}
    d.update(item_id=item_id, item_name=name, item_brand=brand)
    d.update(item_revenue_in_usd=None, quantity=qty, price_in_usd=1.0, price=1.0)
    return d


def test_products_filter_unnest_distinct(spark, raw_schema):
    rows = [
        dict(bundle=1, t=0, name="purchase", items=[_item("a"), _item("a"), _item("b", brand="B")]),
        dict(bundle=2, t=1, name="page_view", items=[_item("c")]),       # not an ecommerce event
        dict(bundle=3, t=2, name="add_to_cart", items=[]),               # empty items vanish
    ]
    p = products_mart(events_mart(raw_df(spark, raw_schema, rows)))
    got = sorted((r.item_id, r.item_brand, r.item_variant) for r in p.collect())
    assert got == [("a", "(not set)", "(not set)"), ("b", "B", "(not set)")]
    assert len(p.columns) == 44


def test_event_params_long_form(spark, raw_schema):
    rows = [dict(bundle=1, t=0, params=[kv("a", s="x"), kv("n", i=7), kv("d", d=2.5), kv("e")]),
            dict(bundle=2, t=1, params=[])]
    ep = event_params_mart(events_mart(raw_df(spark, raw_schema, rows)))
    got = {r.key: r.event_parameter_value for r in ep.collect()}
    assert got == {"a": "x", "n": "7", "d": "2.5", "e": "(not set)"}
    assert ep.where(F.col("id") != F.concat("event_id", "key")).count() == 0


def test_huge_order_is_one_event(spark):
    import datetime as dt

    from clickmarts.sources.fixtures import raw_orders
    from clickmarts.sources.sinks import scratch_path
    base = scratch_path(spark, "t-orders")
    spark.createDataFrame([(1, 7, "F", 10.0, dt.datetime(1995, 1, 1), "1-URGENT"),
                           (2, 8, "O", 5.0, dt.datetime(1995, 1, 2), "2-HIGH"),
                           (3, 8, "F", 6.0, dt.datetime(1995, 1, 2), "2-HIGH")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{base}/orders.parquet")
    lines = [(1, p, 1.0 + p) for p in range(450)] + [(2, 3, 30.0)] + [(3, 3, 30.0)] * 450
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double") \
        .write.parquet(f"{base}/lineitem.parquet")
    spark.createDataFrame([(p, f"n{p}", "B", "T", 1.0) for p in range(450)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double") \
        .write.parquet(f"{base}/part.parquet")
    o = raw_orders(spark, base)
    sizes = sorted((r.b, r.n) for r in o.select(F.col("event_bundle_sequence_id").alias("b"),
                                                F.size("items").alias("n")).collect())
    assert sizes == [(1, 450), (2, 1), (3, 450)]
