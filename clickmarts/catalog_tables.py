"""Registered queries over written tables: schema versions, snapshots, refreshes, batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clickmarts.catalog import flat, r_events, register
from clickmarts.config import MartConfig
from clickmarts.plans.marts import Marts
from clickmarts.session import configure, free_shuffles
from clickmarts.sources import files
from clickmarts.sources.fixtures import even_shards, raw_events, raw_orders
from clickmarts.sources.schema import read_evolved
from clickmarts.sources.shards import Property, incremental_bound, read_export, read_shards, tag_property, tag_shard
from clickmarts.sources.sinks import scratch_path, write_partitions
from clickmarts.sources.snapshots import CODEC, MartTable

#: Sessions of the fixture reach over three days.
PADDING = 3
#: The first day on which the fixture's shards have the traffic records.
TRAFFIC_SINCE = "20240111"


def _days(spark, raw) -> list[str]:
    return sorted(r[0] for r in raw.select(F.right("table_suffix", F.lit(8)).alias("d")).distinct().collect())


def _land(raw, path: str) -> None:
    raw.write.mode("append").option("compression", CODEC).partitionBy("table_suffix").parquet(path)
    free_shuffles(raw.sparkSession)


# -- schema versions (S2) -------------------------------------------------------------

def old_shards(raw):
    """Shards as an early export wrote them: no traffic records, no web record of the
    device, narrow numbers."""
    device = F.struct(*[F.col(f"device.{f.name}") for f in raw.schema["device"].dataType.fields if f.name != "web_info"])
    ecommerce = F.struct(*[(F.col(f"ecommerce.{f.name}").cast("int") if f.name == "total_item_quantity" else
                            F.col(f"ecommerce.{f.name}")).alias(f.name) for f in raw.schema["ecommerce"].dataType.fields])
    return raw.drop("collected_traffic_source", "session_traffic_source_last_click", "user_ltv").withColumns({
        "device": device, "ecommerce": ecommerce, "event_server_timestamp_offset": F.col("event_server_timestamp_offset").cast("int")})


@register("src_schema_evolution")
def q_src_schema_evolution(spark, sf_dir):
    """One export whose early shards lack the traffic records and have narrower numbers."""
    from clickmarts.operators import attribution as attr
    from clickmarts.operators.events import fill_user_id
    configure(spark)
    raw, path = raw_events(spark, sf_dir).drop("business_unit"), scratch_path(spark, "evolved")
    day = F.right("table_suffix", F.lit(8))
    _land(old_shards(raw.where(day < TRAFFIC_SINCE)), path)
    _land(raw.where(day >= TRAFFIC_SINCE), path)
    events = tag_property(tag_shard(read_evolved(spark, path)), "site")
    wide = attr.resolve_traffic_fields(attr.extract_params(fill_user_id(events)))
    return wide.select("event_bundle_sequence_id", "source", "medium", F.col("device.web_info.hostname").alias("hostname"),
                       F.col("device.category").alias("device_category"), "event_server_timestamp_offset",
                       F.col("ecommerce.total_item_quantity").alias("total_item_quantity"), "date_tz")


# -- snapshots and the column log (S5, S6, S7) -------------------------------------------

@register("src_newest_day")
def q_src_newest_day(spark, sf_dir):
    """S5 without reading data: the bound comes from the target's folder names."""
    configure(spark)
    raw = raw_events(spark, sf_dir).drop("business_unit")
    shards, target = scratch_path(spark, "shards"), scratch_path(spark, "target")
    _land(raw, shards)
    write_partitions(tag_shard(raw).select("event_bundle_sequence_id", "date_tz"), target)
    return incremental_bound(read_shards(spark, shards), files.newest_day(spark, target), 3).select(
        "event_bundle_sequence_id", "table_suffix")


@register("sink_snapshot_versions")
def q_sink_snapshot_versions(spark, sf_dir):
    """A full version, a refresh that dies before it is published, and one that is."""
    table = MartTable(spark, scratch_path(spark, "snapshots"))
    table.commit(r_events(spark, sf_dir).select("id", "date_tz", F.lit(1).alias("version")))
    last = table.newest_day() - dt.timedelta(days=3)
    recent = table.read(first_day=last)
    table.stage(recent.withColumn("version", F.lit(99)), 2)
    table.commit(recent.withColumn("version", F.lit(2)))
    return table.read(version=1).withColumn("snapshot", F.lit(1)).unionByName(table.read().withColumn("snapshot", F.lit(2)))


@register("sink_column_log")
def q_sink_column_log(spark, sf_dir):
    """Columns added, dropped, widened and brought back by refreshes of fewer and fewer days."""
    table = MartTable(spark, scratch_path(spark, "columns"))
    events = MartTable(spark, scratch_path(spark, "all-columns"))
    events.commit(r_events(spark, sf_dir).select("id", "event_name", "page_path", "event_sequence", "date_tz"))
    ev, newest = events.read(), events.newest_day()
    recent = lambda days: ev.where(F.col("date_tz") >= F.lit(newest - dt.timedelta(days=days)))
    table.commit(ev.select("id", "event_name", F.col("event_sequence").cast("int").alias("event_sequence"), "date_tz"))
    table.commit(recent(3).select("id", "page_path", "event_sequence", "date_tz"))
    table.commit(recent(1).select("id", "page_path", "event_name", "event_sequence", "date_tz"))
    return table.read()


@register("read_export")
def q_read_export(spark, sf_dir):
    """Two properties in folders of their own, read, tagged and united."""
    configure(spark)
    raw, props = raw_events(spark, sf_dir), []
    for name in ("site-0", "site-1"):
        path = scratch_path(spark, name)
        _land(raw.where(F.col("business_unit") == name).drop("business_unit"), path)
        props.append(Property(name, path))
    return read_export(spark, props).select("business_unit", "event_bundle_sequence_id", "event_name", "is_streaming", "date_tz")


# -- refreshes and batches (incremental runs, T1) -------------------------------------------

def _landed_marts(spark, laid, late_days: int, *derived: str) -> Marts:
    """Marts built while the last days had not landed, refreshed once they have.
    ``laid`` makes the raw rows, dealt as its argument says."""
    raw, dealt = laid(None), laid(even_shards)
    landing, days = scratch_path(spark, "landing"), _days(spark, raw)
    day = F.right("table_suffix", F.lit(8))
    schema = raw.schema
    marts = Marts(spark, scratch_path(spark, "marts"), lambda: spark.read.schema(schema).parquet(landing), MartConfig(),
                  PADDING, derived)
    _land(dealt.where(day < days[-late_days]), landing)
    marts.build()
    _land(dealt.where(day >= days[-late_days]), landing)
    marts.rewrite_days([dt.date(int(d[:4]), int(d[4:6]), int(d[6:])) for d in days[-late_days:]])
    marts.refresh()
    return marts


@register("refresh_events")
def q_refresh_events(spark, sf_dir):
    configure(spark)
    marts = _landed_marts(spark, lambda lay: raw_events(spark, sf_dir, lay), 3)
    return marts.events.read().select("id", "session_id", "user_pseudo_id", "event_name", "event_sequence", "page_sequence", "date_tz")


@register("refresh_sessions")
def q_refresh_sessions(spark, sf_dir):
    configure(spark)
    return _landed_marts(spark, lambda lay: raw_events(spark, sf_dir, lay), 2, "sessions").sessions.read()


@register("refresh_products")
def q_refresh_products(spark, sf_dir):
    """Products after late order days.  Orders cover years, so their shards here are those of
    a month's first day; event ids are instant-scoped."""
    configure(spark)
    month = F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("01"))
    products = _landed_marts(spark, lambda lay: raw_orders(spark, sf_dir, lay, month), 2, "products").products.read()
    return products.drop("event_id", "event_specific_item_id", "event_specific_variant_id", "date_tz")


def _batch_marts(spark, sf_dir, *derived: str) -> Marts:
    """Shards that land in three parts, in no order of days, each streamed as it lands; then
    the last batch comes once more."""
    from clickmarts.catalog import _run_available_now
    from clickmarts.streaming.refresh import raw_stream
    configure(spark)
    raw, dealt = raw_events(spark, sf_dir), raw_events(spark, sf_dir, even_shards)
    landing, ckpt, days = scratch_path(spark, "landing"), scratch_path(spark, "ckpt"), _days(spark, raw)
    marts = Marts(spark, scratch_path(spark, "marts"), lambda: spark.read.schema(raw.schema).parquet(landing), MartConfig(),
                  PADDING, derived)
    late = set(days[4:6])
    parts = [[d for d in days[:-5] if d not in late], sorted(late), days[-5:]]
    day = F.right("table_suffix", F.lit(8))
    for part in parts:
        _land(dealt.where(day.isin(*part)), landing)
        _run_available_now(raw_stream(spark, landing, raw.schema, 1000).writeStream.foreachBatch(
            lambda batch, number: marts.apply_batch(batch, number)).option("checkpointLocation", ckpt))
    marts.apply_batch(raw.where(day.isin(*parts[-1])), len(parts) - 1)
    return marts


@register("stream_marts_events")
def q_stream_marts_events(spark, sf_dir):
    """T1 across marts: the events mart after all batches."""
    return flat(_batch_marts(spark, sf_dir).events.read()).select(
        "id", "session_id", "user_pseudo_id", "event_name", "event_sequence", "page_sequence", "date_tz")


@register("stream_marts_sessions")
def q_stream_marts_sessions(spark, sf_dir):
    """T1 across marts: sessions followed every batch through the impact join."""
    return _batch_marts(spark, sf_dir, "sessions").sessions.read()


# -- every traffic source filled (P2-P11) -----------------------------------------------------

def _campaign_events(spark, sf_dir):
    """Row-local part of the events mart over the campaign fixture, with the fields that
    it resolves but does not carry on."""
    from clickmarts.operators import attribution as attr
    from clickmarts.operators.events import fill_user_id
    from clickmarts.sources.campaigns import raw_campaigns
    configure(spark)
    df = attr.extract_params(fill_user_id(tag_shard(raw_campaigns(spark, sf_dir))))
    return attr.resolve_channel(attr.add_templates(attr.resolve_traffic_fields(df, extended=True)))


@register("campaign_traffic_fields")
def q_campaign_traffic_fields(spark, sf_dir):
    """P2-P5 with values in the session record, the collected record, the URL and the parameters."""
    from clickmarts.oracle_campaigns import TRAFFIC
    return _campaign_events(spark, sf_dir).select("event_bundle_sequence_id", *TRAFFIC)


@register("campaign_templates")
def q_campaign_templates(spark, sf_dir):
    """P6-P9 with every URL parameter."""
    from clickmarts.oracle_campaigns import TEMPLATES
    structs = sorted({c for c in _campaign_events(spark, sf_dir).columns if c.startswith(("event_traffic_source_template", "event_traffic_source_click"))})
    return flat(_campaign_events(spark, sf_dir).select("event_bundle_sequence_id", *structs)).select("event_bundle_sequence_id", *TEMPLATES)


@register("campaign_channels")
def q_campaign_channels(spark, sf_dir):
    """P10 over them."""
    return flat(_campaign_events(spark, sf_dir).select("event_bundle_sequence_id", "event_traffic_source"))


@register("campaign_records")
def q_campaign_records(spark, sf_dir):
    """P11 with every record field."""
    from clickmarts.operators.events import flatten_records
    from clickmarts.oracle_campaigns import RECORDS
    df = flatten_records(_campaign_events(spark, sf_dir))
    return df.select("event_bundle_sequence_id", *RECORDS)


# -- the marts in plain SQL (S8) ----------------------------------------------------------------

@register("sql_event_params")
def q_sql_event_params(spark, sf_dir):
    from clickmarts import sql
    sql.register(spark, r_events(spark, sf_dir))
    return spark.sql("SELECT * FROM ga_event_params")


@register("sql_users")
def q_sql_users(spark, sf_dir):
    from clickmarts import sql
    from clickmarts.catalog import r_sessions
    sql.register(spark, r_events(spark, sf_dir), r_sessions(spark, sf_dir))
    return spark.sql("SELECT * EXCEPT (total_engaged_seconds), round(total_engaged_seconds, 6) AS total_engaged_seconds FROM ga_users")


@register("sql_products")
def q_sql_products(spark, sf_dir):
    from clickmarts import sql
    from clickmarts.catalog import o_events
    sql.register(spark, o_events(spark, sf_dir), prefix="shop_")
    return spark.sql("SELECT * FROM shop_products")


@register("sql_functions")
def q_sql_functions(spark, sf_dir):
    """F1-F8 called from SQL over raw events and pages."""
    from clickmarts import sql
    from clickmarts.catalog import r_raw
    sql.register_functions(spark)
    r_raw(spark, sf_dir).createOrReplaceTempView("ga_raw")
    return spark.sql("""
        SELECT event_bundle_sequence_id, ga_param_int(event_params, 'ga_session_id') AS ga_session_id,
               ga_param_numeric(event_params, 'engagement_time_msec') AS engagement_time_msec,
               ga_param_double(event_params, 'value') AS value, url AS page_location,
               ga_url_param(url, 'utm_source') AS utm_source, ga_url_param(url, 'source') AS source,
               ga_url_protocol(url) AS page_protocol, ga_url_port(url) AS page_port, ga_url_query(url) AS page_query,
               ga_url_fragment(url) AS page_fragment, ga_trailing_slash(ga_url_path(url)) AS path,
               ga_url_hostname(ga_param_string(event_params, 'referrer')) AS referrer_hostname,
               ga_decode_common_escapes(replace(url, '/', '%2F')) AS decoded,
               ga_surrogate_key(array(event_name, ga_param_string(event_params, 'no_such_key'))) AS key2
        FROM (SELECT *, ga_param_string(event_params, 'page_location') AS url FROM ga_raw)""")
