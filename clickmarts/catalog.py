"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

The marts are built from the driver's tables through the GA-shaped fixtures
(``R`` = events + pages, ``O`` = orders + lineitem + part, ``G`` = pages).
Query outputs are flat: struct fields become ``<struct>_<field>`` columns and
nested arrays are left out (they are checked through the exploding marts).
"""

from __future__ import annotations

from typing import Callable, Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmarts.config import MartConfig
from clickmarts.plans.events_mart import events_mart
from clickmarts.session import configure
from clickmarts.sources import files
from clickmarts.sources.fixtures import raw_events, raw_orders, whole_shards
from clickmarts.sources.shards import tag_shard

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: Dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def flat(df: DataFrame) -> DataFrame:
    """Expand struct columns one level into ``<struct>_<field>``; drop arrays and maps."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col(f.name)[s.name].alias(f"{f.name}_{s.name}") for s in f.dataType.fields]
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            continue
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# -- shared inputs ----------------------------------------------------------

def r_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return tag_shard(raw_events(spark, sf_dir))


def o_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return tag_shard(raw_orders(spark, sf_dir))


def r_events(spark: SparkSession, sf_dir: str, cfg: MartConfig = MartConfig()) -> DataFrame:
    return events_mart(r_raw(spark, sf_dir), cfg)


def o_events(spark: SparkSession, sf_dir: str, cfg: MartConfig = MartConfig()) -> DataFrame:
    return events_mart(o_raw(spark, sf_dir), cfg)


# -- marts (M1-M5) ------------------------------------------------------------

@register("events_mart")
def q_events_mart(spark, sf_dir):
    return flat(r_events(spark, sf_dir))


def r_sessions(spark, sf_dir, cfg: MartConfig = MartConfig()):
    from clickmarts.plans.sessions_mart import sessions_mart
    return sessions_mart(r_events(spark, sf_dir, cfg), cfg)


@register("sessions_mart")
def q_sessions_mart(spark, sf_dir):
    return r_sessions(spark, sf_dir)


def _users(spark, sf_dir, fanout):
    from clickmarts.operators.users import users_rollup
    u = users_rollup(r_sessions(spark, sf_dir), fanout=fanout)
    return u.withColumn("total_engaged_seconds", F.round("total_engaged_seconds", 6))


@register("users_mart")
def q_users_mart(spark, sf_dir):
    return _users(spark, sf_dir, "dedup")


@register("users_rollup_fanout")
def q_users_rollup_fanout(spark, sf_dir):
    return _users(spark, sf_dir, "reference")


@register("products_mart")
def q_products_mart(spark, sf_dir):
    from clickmarts.operators.products import products_mart
    return products_mart(o_events(spark, sf_dir))


@register("event_params_mart")
def q_event_params_mart(spark, sf_dir):
    from clickmarts.operators.event_params import event_params_mart
    return event_params_mart(r_events(spark, sf_dir))


# -- sources and sinks (S1-S7) ------------------------------------------------

REVIEW_TODAY = "2024-01-20"


@register("src_union_properties")
def q_src_union_properties(spark, sf_dir):
    """Two properties (the fixture's business units) read apart and unioned back."""
    from clickmarts.sources.shards import union_frames
    configure(spark)
    raw = raw_events(spark, sf_dir)
    names = ("site-0", "site-1")
    frames = [(n, raw.where(F.col("business_unit") == n).drop("business_unit")) for n in names]
    return union_frames(frames).select("business_unit", "event_bundle_sequence_id", "event_name",
                                       "event_timestamp")


def _write_shards(spark, sf_dir) -> str:
    from clickmarts.sources.sinks import scratch_path
    configure(spark)
    path = scratch_path(spark, "shards")
    raw_events(spark, sf_dir).drop("business_unit").write.partitionBy("table_suffix").parquet(path)
    return path


@register("src_shard_projection")
def q_src_shard_projection(spark, sf_dir):
    """Wildcard scan of a shard directory with the raw column projection."""
    from clickmarts.sources.shards import read_shards
    df = read_shards(spark, _write_shards(spark, sf_dir))
    return df.select("event_bundle_sequence_id", "event_name", "user_pseudo_id", "table_suffix")


@register("src_shard_tags")
def q_src_shard_tags(spark, sf_dir):
    return r_raw(spark, sf_dir).select("event_bundle_sequence_id", "is_streaming", "date_tz")


@register("src_preview_bound")
def q_src_preview_bound(spark, sf_dir):
    """Preview bound with an injected 'today' (default 7 days)."""
    import datetime as dt
    from clickmarts.sources.shards import preview_bound, read_shards
    df = read_shards(spark, _write_shards(spark, sf_dir))
    bounded = preview_bound(df, dt.date.fromisoformat(REVIEW_TODAY))
    return bounded.select("event_bundle_sequence_id", "table_suffix")


@register("src_incremental_bound")
def q_src_incremental_bound(spark, sf_dir):
    """Incremental bound from the max partition of a previously written mart."""
    from clickmarts.sources.shards import incremental_bound, max_partition, read_shards
    from clickmarts.sources.sinks import read_partitions, scratch_path, write_partitions
    shards = _write_shards(spark, sf_dir)
    target = scratch_path(spark, "target")
    write_partitions(r_raw(spark, sf_dir).select("event_bundle_sequence_id", "date_tz"), target)
    max_day = max_partition(read_partitions(spark, target))
    bounded = incremental_bound(read_shards(spark, shards), max_day, 3)
    return bounded.select("event_bundle_sequence_id", "table_suffix")


@register("sink_partition_overwrite")
def q_sink_partition_overwrite(spark, sf_dir):
    """Full write (version 1), then the last 3 days rewritten (version 2)."""
    from clickmarts.sources.sinks import read_partitions, scratch_path, write_partitions
    ev = r_events(spark, sf_dir).select("id", "date_tz")
    path = scratch_path(spark, "overwrite")
    write_partitions(ev.withColumn("version", F.lit(1)), path)
    last = read_partitions(spark, path).agg(F.max("date_tz")).first()[0]
    recent = ev.where(F.col("date_tz") >= F.date_sub(F.lit(last), 3))
    write_partitions(recent.withColumn("version", F.lit(2)), path)
    return read_partitions(spark, path).select("id", "date_tz", "version")


@register("sink_schema_sync")
def q_sink_schema_sync(spark, sf_dir):
    """Old partitions with (id, event_name), refreshed ones with (id, page_path):
    read back with the new column set."""
    from clickmarts.sources.sinks import read_partitions, read_synced, scratch_path, write_partitions
    ev = r_events(spark, sf_dir)
    path = scratch_path(spark, "schema")
    write_partitions(ev.select("id", "event_name", "date_tz"), path)
    last = read_partitions(spark, path).agg(F.max("date_tz")).first()[0]
    recent = ev.where(F.col("date_tz") >= F.date_sub(F.lit(last), 3))
    write_partitions(recent.select("id", "page_path", "date_tz"), path)
    return read_synced(spark, path, ["id", "page_path", "date_tz"])


# -- row-local event steps (P1-P14, F1-F16) ------------------------------------

def r_wide(spark, sf_dir) -> DataFrame:
    """Raw events after P1-P10, before flattening (keeps every helper column)."""
    from clickmarts.operators import attribution as attr
    from clickmarts.operators.events import fill_user_id
    df = attr.extract_params(fill_user_id(r_raw(spark, sf_dir)))
    df = attr.resolve_traffic_fields(df, extended=True)
    df = attr.add_templates(df)
    return attr.resolve_channel(df)


@register("fill_user_id")
def q_fill_user_id(spark, sf_dir):
    return r_wide(spark, sf_dir).select("event_bundle_sequence_id", "user_pseudo_id",
                                        "has_null_user_pseudo_id")


@register("attribution_fields")
def q_attribution_fields(spark, sf_dir):
    return r_wide(spark, sf_dir).select("event_bundle_sequence_id", "source", "medium", "campaign",
                                        "campaign_id", "content", "term")


@register("attribution_fields_ext")
def q_attribution_fields_ext(spark, sf_dir):
    return r_wide(spark, sf_dir).select("event_bundle_sequence_id", "creative_format",
                                        "marketing_tactic", "source_platform")


@register("first_traffic_source")
def q_first_traffic_source(spark, sf_dir):
    return r_wide(spark, sf_dir).select("event_bundle_sequence_id", "first_traffic_source_source",
                                        "first_traffic_source_medium", "first_traffic_source_campaign")


@register("gclid_resolution")
def q_gclid_resolution(spark, sf_dir):
    return r_wide(spark, sf_dir).select("event_bundle_sequence_id", "gclid")


def _struct_query(name: str, struct: str):
    @register(name)
    def q(spark, sf_dir):
        return flat(r_events(spark, sf_dir).select("id", struct))
    return q


_struct_query("tmpl_google_ads", "event_traffic_source_template_google_ads")
_struct_query("tmpl_pmax", "event_traffic_source_template_google_pmax_shopping")
_struct_query("tmpl_hotel", "event_traffic_source_template_google_hotel")
_struct_query("click_ids", "event_traffic_source_click_ids")
_struct_query("channel_override", "event_traffic_source")

FLATTENED_RECORD_COLUMNS = (
    "privacy_info_analytics_storage", "privacy_info_ads_storage", "privacy_info_uses_transient_token",
    "device_category", "device_brand", "device_operating_system", "device_language",
    "device_browser", "device_browser_version", "geo_continent", "geo_country", "geo_region",
    "geo_metro", "ecommerce_purchase_revenue", "ecommerce_transaction_id", "app_info_id")


@register("flatten_records")
def q_flatten_records(spark, sf_dir):
    return r_events(spark, sf_dir).select("id", *FLATTENED_RECORD_COLUMNS)


@register("default_dimensions")
def q_default_dimensions(spark, sf_dir):
    from clickmarts.operators.sessions import DEFAULTED_DIMENSIONS, default_dimensions
    d = default_dimensions(r_events(spark, sf_dir))
    return d.select("id", *[o for o, _ in DEFAULTED_DIMENSIONS], "session_number", "user_type")


@register("filter_event_names")
def q_filter_event_names(spark, sf_dir):
    from clickmarts.config import SEQUENCE_EXCLUDED_EVENTS
    ev = r_events(spark, sf_dir)
    return ev.where(~F.col("event_name").isin(*SEQUENCE_EXCLUDED_EVENTS)).select("id", "event_name")


@register("param_lookup")
def q_param_lookup(spark, sf_dir):
    from clickmarts.functions.params import param
    ep = F.col("event_params")
    return r_raw(spark, sf_dir).select(
        "event_bundle_sequence_id",
        param(ep, "page_location").alias("page_location"),
        param(ep, "ga_session_id", "int_value").alias("ga_session_id"),
        param(ep, "engagement_time_msec").alias("engagement_time_msec"),
        param(ep, "session_engaged").alias("session_engaged_text"),
        param(ep, "session_engaged", "int_value").alias("session_engaged_int"),
        param(ep, "value", "double_value").alias("value"),
        param(ep, "no_such_key").alias("missing"))


@register("param_lookup_numeric")
def q_param_lookup_numeric(spark, sf_dir):
    from clickmarts.functions.params import param_numeric
    ep = F.col("event_params")
    return r_raw(spark, sf_dir).select(
        "event_bundle_sequence_id",
        param_numeric(ep, "engagement_time_msec").alias("engagement_time_msec"),
        param_numeric(ep, "ga_session_number").alias("ga_session_number"),
        param_numeric(ep, "value").alias("value"))


def g_pages(spark, sf_dir) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")


@register("url_param")
def q_url_param(spark, sf_dir):
    from clickmarts.functions.urls import url_param
    u = F.col("url")
    return g_pages(spark, sf_dir).select(
        "page_id", url_param(u, "page").alias("page"), url_param(u, "ref").alias("ref"),
        url_param(u, "utm_source").alias("utm_source"), url_param(u, "source").alias("source"))


@register("page_url_parts")
def q_page_url_parts(spark, sf_dir):
    from clickmarts.functions.urls import url_part
    u = F.col("url")
    return g_pages(spark, sf_dir).select(
        "page_id", *[url_part(u, p).alias(f"page_{p}")
                     for p in ("protocol", "hostname", "port", "path", "query", "fragment")])


@register("referrer_hostname")
def q_referrer_hostname(spark, sf_dir):
    return r_wide(spark, sf_dir).select("event_bundle_sequence_id", "referrer", "referrer_hostname")


@register("trailing_slash")
def q_trailing_slash(spark, sf_dir):
    from clickmarts.functions.urls import trailing_slash, url_part
    return g_pages(spark, sf_dir).select(
        "page_id", trailing_slash(url_part(F.col("url"), "path")).alias("path"),
        trailing_slash(F.lit(None).cast("string")).alias("null_path"))


@register("clean_page_path")
def q_clean_page_path(spark, sf_dir):
    from clickmarts.functions.urls import clean_page_path, url_part
    u = F.col("url")
    return g_pages(spark, sf_dir).select(
        "page_id", F.concat(url_part(u, "hostname"), clean_page_path(url_part(u, "path"))).alias("page_path"),
        F.concat(url_part(u, "hostname"), clean_page_path(url_part(u, "path"), F.lower))
        .alias("page_path_custom"))


@register("common_url_decode")
def q_common_url_decode(spark, sf_dir):
    """Pages' URLs percent-encoded (/ ? = &, plus a double-encoded '+') and decoded."""
    from clickmarts.functions.urls import decode_common_escapes
    u = F.col("url")
    encoded = F.concat(F.replace(F.replace(F.replace(F.replace(u, F.lit("/"), F.lit("%2F")),
                                                     F.lit("?"), F.lit("%3F")),
                                           F.lit("="), F.lit("%3D")), F.lit("&"), F.lit("%26")),
                       F.lit("%252B"))
    return g_pages(spark, sf_dir).select("page_id", encoded.alias("encoded"),
                                         decode_common_escapes(encoded).alias("decoded"))


@register("surrogate_key")
def q_surrogate_key(spark, sf_dir):
    from clickmarts.functions.keys import surrogate_key
    ev = r_events(spark, sf_dir)
    return ev.select("id", "session_id",
                     surrogate_key("event_name", "page_port", "ga_session_id").alias("key3"))


@register("event_time_parts")
def q_event_time_parts(spark, sf_dir):
    from clickmarts.functions.timeparts import date_of
    ev = r_events(spark, sf_dir)
    return ev.select("id", "event_timestamp_utc", "event_hour_of_day_utc",
                     date_of(F.col("event_timestamp_utc")).alias("event_date_utc"))


@register("engagement_seconds")
def q_engagement_seconds(spark, sf_dir):
    return r_events(spark, sf_dir).select("id", "engagement_time_sec")


@register("param_value_string")
def q_param_value_string(spark, sf_dir):
    from clickmarts.operators.event_params import event_params_mart
    return event_params_mart(r_events(spark, sf_dir)).select("id", "key", "event_parameter_value")


@register("explode_params")
def q_explode_params(spark, sf_dir):
    from clickmarts.operators.event_params import explode_params
    return explode_params(r_events(spark, sf_dir)).select("event_id", F.col("p.key").alias("key"))


# -- event windows (W1-W4, J1) --------------------------------------------------

def r_ranked(spark, sf_dir, id_scope="scan") -> DataFrame:
    from clickmarts.operators.events import rank_events
    from clickmarts.plans.events_mart import prepare_events
    return rank_events(prepare_events(r_raw(spark, sf_dir)), id_scope)


@register("event_rank")
def q_event_rank(spark, sf_dir):
    return r_ranked(spark, sf_dir).select("event_bundle_sequence_id", "user_pseudo_id",
                                          F.col("_row_num").alias("row_num"), "event_id")


@register("event_rank_instant")
def q_event_rank_instant(spark, sf_dir):
    return r_ranked(spark, sf_dir, "instant").select(
        "event_bundle_sequence_id", "user_pseudo_id", F.col("_row_num").alias("row_num"), "event_id")


@register("session_id_backfill")
def q_session_id_backfill(spark, sf_dir):
    from clickmarts.operators.events import add_session_key, backfill_session_id
    df = add_session_key(backfill_session_id(r_ranked(spark, sf_dir)))
    return df.select("event_bundle_sequence_id", "ga_session_id", "session_id")


NAV_COLUMNS = ("seconds_on_page", "is_entrance", "is_exit", "page_sequence", "previous_page_path",
               "previous_page_event_id", "previous_page_ts_utc", "prev_prev_page_path",
               "next_page_path", "next_page_event_id", "next_page_ts_utc", "next_next_page_path")


@register("page_navigation")
def q_page_navigation(spark, sf_dir):
    ev = r_events(spark, sf_dir)
    return ev.where(F.col("event_name") == "page_view").select("id", "page_path", *NAV_COLUMNS)


@register("event_sequence")
def q_event_sequence(spark, sf_dir):
    return r_events(spark, sf_dir).select("id", "event_name", "event_sequence")


@register("join_sequences")
def q_join_sequences(spark, sf_dir):
    return r_events(spark, sf_dir).select("id", "event_sequence", "page_sequence",
                                          "previous_page_event_id", "next_page_event_id")


# -- session steps (W5-W7, A1-A4, J2, J3, F11, F15) -----------------------------

def r_rolled(spark, sf_dir) -> DataFrame:
    from clickmarts.operators.sessions import default_dimensions, last_non_direct, session_rollup
    return last_non_direct(session_rollup(default_dimensions(r_events(spark, sf_dir))))


@register("first_session_start")
def q_first_session_start(spark, sf_dir):
    r = r_rolled(spark, sf_dir).where(F.col("start").isNotNull())
    return r.select("session_id", F.col("start.session_start_at_utc").alias("session_start_at_utc"),
                    F.col("start.landing_page").alias("landing_page"),
                    F.col("start.event_traffic_source.medium").alias("medium"),
                    F.col("start.session_number").alias("session_number"))


@register("session_attribution")
def q_session_attribution(spark, sf_dir):
    r = r_rolled(spark, sf_dir)
    return r.select("session_id", F.col("attr.session_start_at_utc").alias("session_start_at_utc"),
                    F.col("attr.landing_page").alias("landing_page"),
                    F.col("attr.event_traffic_source.source").alias("source"),
                    F.col("attr.event_traffic_source.medium").alias("medium"))


@register("last_non_direct")
def q_last_non_direct(spark, sf_dir):
    return r_rolled(spark, sf_dir).select("session_id",
                                          F.col("lnd.id").alias("last_non_direct_session_id"))


@register("session_engagement")
def q_session_engagement(spark, sf_dir):
    return r_rolled(spark, sf_dir).select("session_id", "is_engaged", "engaged_seconds",
                                          "event_count", "session_end_at_utc")


@register("session_page_views")
def q_session_page_views(spark, sf_dir):
    r = r_rolled(spark, sf_dir)
    return r.where(F.col("page_views").isNotNull()).select("session_id", "page_views")


@register("distinct_composite_count")
def q_distinct_composite_count(spark, sf_dir):
    return r_rolled(spark, sf_dir).select("session_id", "event_count")


@register("session_duration")
def q_session_duration(spark, sf_dir):
    return r_sessions(spark, sf_dir).select("id", "session_start_at_utc", "session_end_at_utc",
                                            "duration_seconds")


@register("source_medium")
def q_source_medium(spark, sf_dir):
    return r_sessions(spark, sf_dir).select("id", "last_source_medium",
                                            "last_non_direct_source_medium")


@register("join_session_star")
def q_join_session_star(spark, sf_dir):
    """The sessions star without a lookback bound on the last-non-direct leg."""
    return r_sessions(spark, sf_dir, MartConfig(last_non_direct_lookback=None))


LND_CHECK_COLUMNS = ("last_non_direct_landing_page", "last_non_direct_source",
                     "last_non_direct_medium", "last_non_direct_source_medium",
                     "last_non_direct_campaign", "last_non_direct_gclid",
                     "last_non_direct_google_ads_customer_id", "last_non_direct_fbclid")


@register("join_last_non_direct")
def q_join_last_non_direct(spark, sf_dir):
    """Last-non-direct attribution with a 7-day lookback (the fixture spans 30 days)."""
    s = r_sessions(spark, sf_dir, MartConfig(last_non_direct_lookback=7))
    return s.select("id", *LND_CHECK_COLUMNS)


@register("first_touch")
def q_first_touch(spark, sf_dir):
    return _users(spark, sf_dir, "dedup").select(
        "id", "first_landing_page", "first_source", "first_medium", "first_source_medium",
        "first_gclid", "first_session_start_at_utc")


# -- products steps (P15, J6, A3) -------------------------------------------------

@register("filter_ecommerce")
def q_filter_ecommerce(spark, sf_dir):
    from clickmarts.operators.products import filter_ecommerce
    return filter_ecommerce(o_events(spark, sf_dir)).select("id", "event_name")


@register("explode_items")
def q_explode_items(spark, sf_dir):
    from clickmarts.operators.products import explode_items
    x = explode_items(o_events(spark, sf_dir))
    return x.select(F.col("id").alias("event_id"), F.col("i.item_id").alias("item_id"),
                    F.col("i.item_brand").alias("item_brand"), F.col("i.quantity").alias("quantity"))


@register("distinct_items")
def q_distinct_items(spark, sf_dir):
    from clickmarts.operators.products import distinct_items, explode_items, filter_ecommerce, item_rows
    return distinct_items(item_rows(explode_items(filter_ecommerce(o_events(spark, sf_dir)))))


# -- streaming (T1-T3): rows-only checks ------------------------------------------------

def _land_raw(spark, sf_dir) -> str:
    """Land the R fixture as raw shard files (one directory per table suffix)."""
    from clickmarts.sources.sinks import scratch_path
    configure(spark)
    path = scratch_path(spark, "landing")
    # One file a shard, so that a trigger of so many files is one of so many days at any size.
    raw_events(spark, sf_dir, whole_shards).write.partitionBy("table_suffix").parquet(path)
    files.order_by_day(spark, path)
    return path


def _run_available_now(writer) -> None:
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


@register("stream_prepare")
def q_stream_prepare(spark, sf_dir):
    """The stateless event preparation as a streaming query into parquet."""
    from clickmarts.sources.sinks import scratch_path
    from clickmarts.streaming.refresh import prepare_stream, raw_stream
    landing = _land_raw(spark, sf_dir)
    schema = spark.read.parquet(landing).schema
    out, ckpt = scratch_path(spark, "prepared"), scratch_path(spark, "ckpt")
    prepared = prepare_stream(raw_stream(spark, landing, schema, 8))
    _run_available_now(prepared.writeStream.format("parquet").option("path", out)
                       .option("checkpointLocation", ckpt).outputMode("append"))
    return flat(spark.read.parquet(out)).select(
        "event_bundle_sequence_id", "user_pseudo_id", "ga_session_id", "event_name", "page_url",
        "event_traffic_source_source", "event_traffic_source_medium", "date_tz", "is_streaming")


@register("stream_refresh")
def q_stream_refresh(spark, sf_dir):
    """foreachBatch refresh of the touched days into a day-partitioned events mart."""
    from clickmarts.plans.incremental import stable_ids
    from clickmarts.sources.sinks import read_partitions, scratch_path
    from clickmarts.streaming.refresh import raw_stream, refresh_on_batch
    landing = _land_raw(spark, sf_dir)
    schema = spark.read.parquet(landing).schema
    target, ckpt = scratch_path(spark, "events"), scratch_path(spark, "ckpt")
    fn = refresh_on_batch(lambda: spark.read.schema(schema).parquet(landing), target,
                          stable_ids(), padding_days=3)
    _run_available_now(raw_stream(spark, landing, schema, 8).writeStream
                       .foreachBatch(fn).option("checkpointLocation", ckpt))
    return read_partitions(spark, target).select("id", "session_id", "user_pseudo_id", "event_name",
                                                 "event_sequence", "page_sequence", "date_tz")


def _stream_sessions(spark, sf_dir, delay):
    from clickmarts.sources.sinks import scratch_path
    from clickmarts.streaming.refresh import live_session_metrics, prepare_stream, raw_stream
    landing = _land_raw(spark, sf_dir)
    schema = spark.read.parquet(landing).schema
    out, ckpt = scratch_path(spark, "live"), scratch_path(spark, "ckpt")
    live = live_session_metrics(prepare_stream(raw_stream(spark, landing, schema, 8)), delay)

    def append(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(out)

    _run_available_now(live.writeStream.outputMode("update").foreachBatch(append)
                       .option("checkpointLocation", ckpt))
    rows = spark.read.parquet(out)
    latest = rows.groupBy("session_id", "w").agg(
        F.max_by(F.struct("user_pseudo_id", "events", "page_views", "engaged_seconds",
                          "first_event_at_utc", "last_event_at_utc"), F.col("batch_id")).alias("m"))
    return latest.select("session_id", F.col("w.start").alias("window_start"), "m.*")


def _land_in_order(spark, raw) -> str:
    """Land shard files so that a stream reads them day by day: file times follow the days."""
    from clickmarts.sources.sinks import scratch_path
    path = scratch_path(spark, "landing")
    raw.write.partitionBy("table_suffix").parquet(path)
    files.order_by_day(spark, path)
    return path


def _run_live_sessions(spark, raw, delay: str = "1 day", files_per_trigger: int = 16) -> DataFrame:
    from clickmarts.sources.sinks import scratch_path
    from clickmarts.streaming.refresh import prepare_stream, raw_stream
    from clickmarts.streaming.sessions import activity_slices, live_sessions, write_pieces
    landing, out, ckpt = _land_in_order(spark, raw), scratch_path(spark, "pieces"), scratch_path(spark, "ckpt")
    schema = spark.read.parquet(landing).schema
    slices = activity_slices(prepare_stream(raw_stream(spark, landing, schema, files_per_trigger)), delay)
    _run_available_now(slices.writeStream.outputMode("append").foreachBatch(write_pieces(out))
                       .option("checkpointLocation", ckpt))
    return live_sessions(spark, out)


@register("stream_sessions")
def q_stream_sessions(spark, sf_dir):
    """Sessions of all slices that the watermark, a day behind, has closed; their ids and
    metrics are those of the batch marts."""
    configure(spark)
    return _run_live_sessions(spark, raw_events(spark, sf_dir, whole_shards))


@register("stream_sessions_complete")
def q_stream_sessions_complete(spark, sf_dir):
    """T3 with a watermark delay longer than the fixture's 30-day span: no event
    can be late, so the final state is deterministic and checked in full."""
    return _stream_sessions(spark, sf_dir, "31 days")


# -- skew-robust layout (same results, checked against the same oracle) ---------------

SLICED = MartConfig(window_layout="sliced")


@register("events_mart_sliced")
def q_events_mart_sliced(spark, sf_dir):
    """The events mart with time-sliced windows (the layout used for hot users)."""
    return flat(r_events(spark, sf_dir, SLICED))


@register("sessions_mart_sliced")
def q_sessions_mart_sliced(spark, sf_dir):
    """The sessions mart over sliced events, with the sliced last-non-direct window."""
    return r_sessions(spark, sf_dir, SLICED)


@register("users_rollup")
def q_users_rollup(spark, sf_dir):
    """A5: the user metrics of the rollup (first-touch columns checked in first_touch)."""
    from clickmarts.operators.users import USER_METRICS
    return _users(spark, sf_dir, "dedup").select("id", *USER_METRICS)


@register("src_prefer_daily")
def q_src_prefer_daily(spark, sf_dir):
    """Opt-in de-duplication of a day present both as a daily and an intraday shard.

    The fixture's last day exists only as intraday shards; a daily copy of it
    is added, so without the option that day would be doubled.
    """
    from clickmarts.sources.shards import prefer_daily
    raw = r_raw(spark, sf_dir)
    last = raw.agg(F.max("date_tz")).first()[0]
    daily_copy = raw.where((F.col("date_tz") == F.lit(last)) & (F.col("is_streaming") == "streaming")) \
        .withColumn("is_streaming", F.lit("daily"))
    kept = prefer_daily(raw.unionByName(daily_copy))
    return kept.select("event_bundle_sequence_id", "is_streaming", "date_tz")


SPLIT = MartConfig(window_layout="auto", skew_threshold_rows=10)


@register("events_mart_split")
def q_events_mart_split(spark, sf_dir):
    """'auto' with a threshold of 10 events: heavy users go through the sliced
    windows, the rest (e.g. anonymous one-event users) through per-user ones."""
    return flat(r_events(spark, sf_dir, SPLIT))


@register("sessions_mart_split")
def q_sessions_mart_split(spark, sf_dir):
    """Sessions over split events, with the last-non-direct window split the same way."""
    return r_sessions(spark, sf_dir, SPLIT)


from clickmarts import catalog_tables  # noqa: E402, F401  (registers its queries)
