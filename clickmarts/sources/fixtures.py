"""GA-shaped inputs derived from the driver's tables (FIXTURES.md R and O).

``raw_events``: one export row per ``events`` row, joined to a page by
position, with nested records and key/value parameters.  ``raw_orders``: one
commerce event per order with its lines as ``items``.  Both keep the table
suffix column, so ``tag_shard`` applies as on a real export.
"""

from __future__ import annotations

from typing import Callable, Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmarts.functions.timeparts import floor_div
from clickmarts.operators.indexing import dense_index

VALUE_TYPE = T.StructType([
    T.StructField("string_value", T.StringType()),
    T.StructField("int_value", T.LongType()),
    T.StructField("float_value", T.DoubleType()),
    T.StructField("double_value", T.DoubleType()),
])
PARAM_TYPE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", VALUE_TYPE)])
ITEM_STRING_FIELDS = (
    "item_id", "item_name", "item_brand", "item_variant", "item_category", "item_category2",
    "item_category3", "item_category4", "item_category5", "coupon", "affiliation",
    "location_id", "item_list_id", "item_list_name", "item_list_index", "promotion_id",
    "promotion_name", "creative_name", "creative_slot",
)
ITEM_TYPE = T.StructType(
    [T.StructField(f, T.StringType()) for f in ITEM_STRING_FIELDS]
    + [T.StructField("item_revenue_in_usd", T.DoubleType()), T.StructField("quantity", T.LongType()),
       T.StructField("price_in_usd", T.DoubleType()), T.StructField("price", T.DoubleType())])
CTS_FIELDS = ("manual_source", "manual_medium", "manual_campaign_name", "manual_campaign_id",
              "manual_content", "manual_term", "manual_creative_format", "manual_marketing_tactic",
              "manual_source_platform", "gclid", "dclid", "srsltid")
MANUAL_CAMPAIGN_FIELDS = ("source", "medium", "campaign_name", "campaign_id", "content", "term",
                          "creative_format", "marketing_tactic", "source_platform")
GOOGLE_ADS_CAMPAIGN_FIELDS = ("campaign_name", "campaign_id", "customer_id", "account_name",
                              "ad_group_id", "ad_group_name")
DEVICE_FIELDS = ("category", "mobile_brand_name", "mobile_model_name", "mobile_os_hardware_model",
                 "mobile_marketing_name", "operating_system", "operating_system_version",
                 "language", "is_limited_ad_tracking", "advertising_id", "vendor_id", "browser",
                 "browser_version")
ECOMMERCE_FIELDS = (("total_item_quantity", "long"), ("purchase_revenue_in_usd", "double"),
                    ("purchase_revenue", "double"), ("refund_value_in_usd", "double"),
                    ("refund_value", "double"), ("shipping_value_in_usd", "double"),
                    ("shipping_value", "double"), ("tax_value_in_usd", "double"),
                    ("tax_value", "double"), ("unique_items", "long"), ("transaction_id", "string"))

INTRADAY_FROM_MICROS = 1_706_572_800_000_000  # 2024-01-30 00:00:00 UTC
SESSION_BUCKET_MICROS = 259_200_000_000       # 3 days
SESSION_NUMBER_OFFSET = 6573


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def _kv(key: str, string_value=None, int_value=None, double_value=None, present=None) -> Column:
    value = F.struct(
        (string_value if string_value is not None else _null("string")).cast("string").alias("string_value"),
        (int_value if int_value is not None else _null("long")).cast("long").alias("int_value"),
        _null("double").alias("float_value"),
        (double_value if double_value is not None else _null("double")).cast("double").alias("double_value"),
    )
    entry = F.struct(F.lit(key).alias("key"), value.alias("value"))
    return entry if present is None else F.when(present, entry)


def _params(*entries: Column) -> Column:
    return F.filter(F.array(*entries), lambda p: p.isNotNull())


def _epoch_micros(ts: str) -> Column:
    """Micros since epoch of a TIMESTAMP_NTZ column (no session-zone dependence)."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def _struct_of_nulls(fields, **values) -> Column:
    return F.struct(*[(values.get(f, _null("string"))).alias(f) for f in fields])


def _empty_items() -> Column:
    return F.array().cast(T.ArrayType(ITEM_TYPE))


def _ecommerce(**values) -> Column:
    return F.struct(*[values.get(f, _null(t)).cast(t).alias(f) for f, t in ECOMMERCE_FIELDS])


def _common_tail() -> dict:
    return {
        "user_first_touch_timestamp": _null("long"),
        "user_ltv": F.struct(_null("double").alias("revenue"), _null("string").alias("currency")),
        "event_dimensions": F.struct(_null("string").alias("hostname")),
        "app_info": F.struct(_null("string").alias("id")),
    }


def whole_shards(rows: DataFrame) -> DataFrame:
    """Rows dealt and sorted by shard, so that each shard is written as one file."""
    return rows.repartition("table_suffix").sortWithinPartitions("table_suffix")


def even_shards(rows: DataFrame) -> DataFrame:
    """Rows dealt and sorted by shard, in as many files a shard as its size asks for."""
    return rows.hint("rebalance", "table_suffix").sortWithinPartitions("table_suffix")


def raw_events(spark: SparkSession, sf_dir: str, lay: Optional[Callable[[DataFrame], DataFrame]] = None) -> DataFrame:
    """R: GA-shaped export rows built from ``events`` + ``pages`` (+ nation/region).

    ``lay`` deals the rows for a write by shard, while they are still narrow."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    # One aggregate (a few scalars to the driver): the join key is event_id mod
    # the page count, and when page ids are exactly 0..n-1 a page's position
    # is its id, so the distributed positional index is only built otherwise.
    n_pages, n_ids, lo, hi = pages.agg(
        F.count(F.lit(1)), F.count_distinct("page_id"), F.min("page_id"), F.max("page_id")).first()
    if n_pages and n_ids == n_pages and lo == 0 and hi == n_pages - 1:
        pg = pages.withColumn("rn", F.col("page_id"))
    else:
        pg = dense_index(pages, "page_id", "rn")
    b = events.select(
        "event_id", F.col("user_id").alias("uid"), F.col("value").alias("v"), "event_type",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        _epoch_micros("ts").alias("event_timestamp"),
        F.date_format("ts", "yyyyMMdd").alias("_day"),
        (F.col("event_id") % F.lit(n_pages)).alias("prn"),
    )
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("_nk"), "n_name", "r_name")
    suffix = F.concat(F.when(F.col("event_timestamp") >= F.lit(INTRADAY_FROM_MICROS), F.lit("intraday_")).otherwise(F.lit("")),
                      F.col("_day"))
    j = (b.join(pg, b.prn == pg.rn)
          .join(geo, (F.col("uid") % F.lit(25)) == F.col("_nk"), "left").withColumn("table_suffix", suffix))
    j = lay(j) if lay else j

    k, uid, v, url, ets = F.col("k"), F.col("uid"), F.col("v"), F.col("url"), F.col("event_timestamp")
    event_name = (F.when(F.col("event_type") == "view", "page_view")
                  .when(F.col("event_type") == "signup", "session_start")
                  .when(F.col("event_type") == "click", "select_item")
                  .when(F.col("event_type") == "purchase", "purchase")
                  .otherwise("user_engagement"))
    k_s, eid_s = k.cast("string"), F.col("event_id").cast("string")
    extra = (F.when(k % 8 == 1, F.concat(F.lit("&utm_source=news&utm_medium=email&utm_campaign=c"), k_s))
             .when(k % 8 == 2, F.concat(F.lit("&gclid=g"), eid_s))
             .when(k % 8 == 3, F.concat(F.lit("&wbraid=w"), eid_s))
             .when(k % 8 == 4, F.lit("&utm_source=partner&utm_medium=referral"))
             .when(k % 8 == 5, F.concat(F.lit("&fbclid=f"), eid_s, F.lit("&g_acid="), k_s,
                                        F.lit("&g_mid=m1&g_hid=h1")))
             .otherwise(F.lit("")))
    page_location = F.concat(
        F.regexp_replace(url, "#.*$", ""),
        F.when(url.contains("?"), F.lit("&")).otherwise(F.lit("?")),
        F.lit("k="), k_s, extra,
        F.when(k % 3 == 0, F.lit("#top")).otherwise(F.lit("")))
    referrer = F.when(k % 5 == 0, F.concat(F.lit("https://ref"), (k % 7).cast("string"),
                                           F.lit(".example.org:8443/x?y=1")))
    session_bucket = floor_div(ets, SESSION_BUCKET_MICROS)
    msec = F.floor(v * 100).cast("long")
    host = F.when(k % 17 != 0, F.regexp_extract(url, "^[a-z]+://([^/?#:]+)", 1))
    business_unit = F.concat(F.lit("site-"), (uid % 2).cast("string"))
    is_purchase = event_name == F.lit("purchase")
    sts_source = F.when(k % 6 == 0, F.lit("(not set)")).when(k % 6 == 1, F.lit("ads"))
    sts_medium = F.when(k % 6 == 0, F.lit("(not set)"))

    cols = {
        "event_name": event_name,
        "event_timestamp": ets,
        "event_params": _params(
            _kv("page_location", string_value=page_location),
            _kv("page_title", string_value=F.concat(F.lit("Page "), F.col("page_id").cast("string"))),
            _kv("page_referrer", string_value=referrer, present=referrer.isNotNull()),
            _kv("referrer", string_value=referrer, present=referrer.isNotNull()),
            _kv("ignore_referrer", string_value=F.lit("true"), present=(k % 4 == 0)),
            _kv("ga_session_id", int_value=session_bucket * F.lit(259200), present=(k % 10 != 0)),
            _kv("ga_session_number", int_value=session_bucket - F.lit(SESSION_NUMBER_OFFSET),
                present=(k % 10 != 0)),
            _kv("engagement_time_msec", string_value=msec.cast("string"), int_value=msec),
            _kv("session_engaged", string_value=F.lit("1"), present=(k % 3 == 0)),
            _kv("session_engaged", int_value=F.lit(1), present=(k % 3 == 1)),
            _kv("value", double_value=v),
        ),
        "event_previous_timestamp": _null("long"),
        "event_value_in_usd": F.when(is_purchase, v),
        "event_bundle_sequence_id": F.col("event_id"),
        "event_server_timestamp_offset": k,
        "user_id": F.when(uid % 4 == 0, F.concat(F.lit("c"), uid.cast("string"))),
        "user_pseudo_id": F.when(k != 99, F.concat(F.lit("u"), uid.cast("string"))),
        "privacy_info": F.struct(
            F.lit("Yes").alias("analytics_storage"),
            F.when(k % 2 == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("ads_storage"),
            F.lit("No").alias("uses_transient_token")),
        "user_properties": F.array(_kv("segment", string_value=F.concat(F.lit("s"), (uid % 3).cast("string")))),
        "device": F.struct(
            *[c.alias(f) for f, c in zip(DEVICE_FIELDS, [
                F.when(uid % 3 == 0, "desktop").when(uid % 3 == 1, "mobile").otherwise("tablet"),
                F.when(uid % 3 != 0, F.concat(F.lit("brand-"), (uid % 5).cast("string"))),
                _null("string"), _null("string"), _null("string"),
                F.when(uid % 4 == 0, "Windows").when(uid % 4 == 1, "Android")
                 .when(uid % 4 == 2, "iOS").otherwise("Macintosh"),
                _null("string"), F.lit("en-us"), F.lit("No"), _null("string"), _null("string"),
                F.when(k % 2 == 1, F.lit("Chrome")), F.when(k % 2 == 1, F.lit("120.0")),
            ])],
            F.struct(F.lit("Safari").alias("browser"), F.lit("17.1").alias("browser_version"),
                     host.alias("hostname")).alias("web_info")),
        "geo": F.struct(
            F.col("r_name").alias("continent"), F.col("n_name").alias("country"),
            F.concat(F.lit("region-"), (uid % 7).cast("string")).alias("region"),
            _null("string").alias("city"), F.lit("(not set)").alias("metro"),
            _null("string").alias("sub_continent")),
        "traffic_source": F.struct(F.lit("google").alias("source"), F.lit("organic").alias("medium"),
                                   F.lit("(organic)").alias("name")),
        "collected_traffic_source": _struct_of_nulls(
            CTS_FIELDS, manual_source=F.when(k % 9 == 0, F.lit("newsletter"))),
        "session_traffic_source_last_click": F.struct(
            _struct_of_nulls(MANUAL_CAMPAIGN_FIELDS, source=sts_source, medium=sts_medium)
            .alias("manual_campaign"),
            _struct_of_nulls(GOOGLE_ADS_CAMPAIGN_FIELDS).alias("google_ads_campaign")),
        "stream_id": business_unit,
        "platform": F.lit("WEB"),
        "ecommerce": _ecommerce(
            total_item_quantity=F.when(is_purchase, F.lit(1)),
            purchase_revenue_in_usd=F.when(is_purchase, v),
            purchase_revenue=F.when(is_purchase, v),
            unique_items=F.when(is_purchase, F.lit(1)),
            transaction_id=F.when(is_purchase, F.concat(F.lit("T"), eid_s))),
        "items": _empty_items(),
        "business_unit": business_unit,
        "table_suffix": F.col("table_suffix"),
    }
    cols.update(_common_tail())
    return j.select(*[c.alias(n) for n, c in cols.items()])


ORDER_EVENT_NAMES = (("F", "purchase"), ("O", "add_to_cart"), ("P", "page_view"))


def raw_orders(spark: SparkSession, sf_dir: str, lay: Optional[Callable[[DataFrame], DataFrame]] = None,
               suffix: Optional[Column] = None) -> DataFrame:
    """O: one commerce event per order; its lines (joined to ``part``) as ``items``.

    Lines are grouped per order into the nested ``items`` array, the layout
    the export itself uses; orders without lines get an empty array.  An order
    is one event, whatever its number of lines: an event is one nested row of
    the export, and splitting it would repeat its revenue.  ``suffix`` replaces the
    shard's (the day of ``o_orderdate``); ``lay`` is as in :func:`raw_events`.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_quantity")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    qty = F.ceil(F.col("l_quantity") / F.lit(25)).cast("long")
    # Lines are shuffled and grouped with their own values only; the item's fields come after.
    line = F.struct("l_partkey", "p_name", "p_brand", "p_type", "p_retailprice", qty.alias("quantity"))

    def item(p: Column) -> Column:
        return F.struct(*[
            (p["l_partkey"].cast("string") if f == "item_id"
             else p["p_name"] if f == "item_name"
             else F.when(p["l_partkey"] % 11 != 0, p["p_brand"]) if f == "item_brand"
             else p["p_type"] if f == "item_category"
             else _null("string")).alias(f) for f in ITEM_STRING_FIELDS
        ], _null("double").alias("item_revenue_in_usd"), p["quantity"].alias("quantity"),
            p["p_retailprice"].alias("price_in_usd"), p["p_retailprice"].alias("price"))

    joined = lineitem.join(part, lineitem.l_partkey == part.p_partkey)
    lines = joined.groupBy("l_orderkey").agg(
        F.collect_list(line).alias("_lines"), F.sum(qty).alias("_qty"), F.count(F.lit(1)).alias("_n"))
    shard = F.date_format("o_orderdate", "yyyyMMdd") if suffix is None else suffix
    o = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").withColumn("table_suffix", shard)
    o = lay(o) if lay else o

    status = F.col("o_orderstatus")
    event_name = F.lit(None).cast("string")
    for code, name in reversed(ORDER_EVENT_NAMES):
        event_name = F.when(status == code, F.lit(name)).otherwise(event_name)
    ets = _epoch_micros("o_orderdate") + F.col("o_orderkey")
    cols = {
        "event_name": event_name,
        "event_timestamp": ets,
        "event_params": F.array().cast(T.ArrayType(PARAM_TYPE)),
        "event_previous_timestamp": _null("long"),
        "event_value_in_usd": F.col("o_totalprice"),
        "event_bundle_sequence_id": F.col("o_orderkey"),
        "event_server_timestamp_offset": _null("long"),
        "user_id": _null("string"),
        "user_pseudo_id": F.concat(F.lit("u"), F.col("o_custkey").cast("string")),
        "privacy_info": _struct_of_nulls(("analytics_storage", "ads_storage", "uses_transient_token")),
        "user_properties": F.array().cast(T.ArrayType(PARAM_TYPE)),
        "device": F.struct(*[_null("string").alias(f) for f in DEVICE_FIELDS],
                           _struct_of_nulls(("browser", "browser_version", "hostname")).alias("web_info")),
        "geo": _struct_of_nulls(("continent", "country", "region", "city", "metro", "sub_continent")),
        "traffic_source": _struct_of_nulls(("source", "medium", "name")),
        "collected_traffic_source": _struct_of_nulls(CTS_FIELDS),
        "session_traffic_source_last_click": F.struct(
            _struct_of_nulls(MANUAL_CAMPAIGN_FIELDS).alias("manual_campaign"),
            _struct_of_nulls(GOOGLE_ADS_CAMPAIGN_FIELDS).alias("google_ads_campaign")),
        "stream_id": F.lit("shop-web"),
        "platform": F.lit("WEB"),
        "ecommerce": _ecommerce(
            total_item_quantity=F.col("_qty"),
            purchase_revenue_in_usd=F.col("o_totalprice"),
            purchase_revenue=F.col("o_totalprice"),
            unique_items=F.col("_n"),
            transaction_id=F.col("o_orderkey").cast("string")),
        "items": F.coalesce(F.transform("_lines", item), _empty_items()),
        "business_unit": F.lit("shop"),
        "table_suffix": F.col("table_suffix"),
    }
    cols.update(_common_tail())
    return o.select(*[c.alias(n) for n, c in cols.items()])
