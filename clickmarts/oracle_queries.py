"""Oracle SQL per registered query name (DuckDB dialect)."""

from __future__ import annotations

from typing import Dict

from clickmarts.oracle import EVENTS_FLAT, with_r

ORACLE: Dict[str, str] = {}

ORACLE["events_mart"] = with_r(f"SELECT\n  {EVENTS_FLAT}\nFROM ev")

from clickmarts.oracle import (EVENT_PARAMS_SQL, PRODUCTS_SQL, users_sql,  # noqa: E402
                               with_sessions)

ORACLE["sessions_mart"] = with_sessions("SELECT * FROM sm")
ORACLE["users_mart"] = users_sql(fanout=False)
ORACLE["users_rollup_fanout"] = users_sql(fanout=True)
ORACLE["products_mart"] = PRODUCTS_SQL
ORACLE["event_params_mart"] = EVENT_PARAMS_SQL

from clickmarts.oracle import (S_CTES, item_rows_select, part, skey, slash, up,  # noqa: E402
                               with_o, with_r)
from clickmarts.oracle import _events_flat_exprs  # noqa: E402

_EV = dict(_events_flat_exprs())


def _ev_cols(*names: str) -> str:
    return ", ".join(f"{_EV[n]} AS {n}" for n in names)


# -- sources and sinks --------------------------------------------------------
ORACLE["src_union_properties"] = with_r(
    "SELECT business_unit, event_id AS event_bundle_sequence_id, event_name, ets AS event_timestamp FROM rf")
ORACLE["src_shard_projection"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, event_name, raw_user AS user_pseudo_id, table_suffix FROM rf")
ORACLE["src_shard_tags"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, is_streaming, date_tz FROM e5")
ORACLE["src_preview_bound"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, table_suffix FROM rf "
    "WHERE right(table_suffix, 8) BETWEEN '20240113' AND '20240120'")
ORACLE["src_incremental_bound"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, table_suffix FROM rf "
    "WHERE right(table_suffix, 8) >= strftime((SELECT max(date_tz) FROM e5) - INTERVAL 3 DAY, '%Y%m%d')")
ORACLE["sink_partition_overwrite"] = with_r(
    "SELECT id, date_tz, CASE WHEN date_tz >= (SELECT max(date_tz) FROM ev) - INTERVAL 3 DAY "
    "THEN 2 ELSE 1 END AS version FROM ev")
ORACLE["sink_schema_sync"] = with_r(
    "SELECT id, CASE WHEN date_tz >= (SELECT max(date_tz) FROM ev) - INTERVAL 3 DAY "
    "THEN page_path END AS page_path, date_tz FROM ev")

# -- row-local event steps --------------------------------------------------------
ORACLE["fill_user_id"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, user_pseudo_id, has_null_user_pseudo_id FROM e0")
ORACLE["attribution_fields"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, source, medium, campaign, campaign_id, content, term FROM e1")
ORACLE["attribution_fields_ext"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, CAST(NULL AS VARCHAR) AS creative_format, "
    "CAST(NULL AS VARCHAR) AS marketing_tactic, CAST(NULL AS VARCHAR) AS source_platform FROM e1")
ORACLE["first_traffic_source"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, 'google' AS first_traffic_source_source, "
    "'organic' AS first_traffic_source_medium, '(organic)' AS first_traffic_source_campaign FROM rf")
ORACLE["gclid_resolution"] = with_r("SELECT event_id AS event_bundle_sequence_id, gclid FROM e1")


def _struct_sql(prefix: str) -> str:
    names = [n for n in _EV if n.startswith(prefix + "_")]
    return with_r(f"SELECT id, {_ev_cols(*names)} FROM ev")


ORACLE["tmpl_google_ads"] = _struct_sql("event_traffic_source_template_google_ads")
ORACLE["tmpl_pmax"] = _struct_sql("event_traffic_source_template_google_pmax_shopping")
ORACLE["tmpl_hotel"] = _struct_sql("event_traffic_source_template_google_hotel")
ORACLE["click_ids"] = _struct_sql("event_traffic_source_click_ids")
ORACLE["channel_override"] = with_r(
    "SELECT id, " + _ev_cols(*[f"event_traffic_source_{f}" for f in (
        "campaign", "medium", "source", "content", "term", "campaign_id", "referrer", "gclid")]) + " FROM ev")
ORACLE["flatten_records"] = with_r("SELECT id, " + _ev_cols(
    "privacy_info_analytics_storage", "privacy_info_ads_storage", "privacy_info_uses_transient_token",
    "device_category", "device_brand", "device_operating_system", "device_language",
    "device_browser", "device_browser_version", "geo_continent", "geo_country", "geo_region",
    "geo_metro", "ecommerce_purchase_revenue", "ecommerce_transaction_id", "app_info_id") + " FROM ev")
ORACLE["default_dimensions"] = with_r(
    "SELECT id, landing_page_referrer, landing_page_hostname, landing_page, landing_page_query, "
    "device_category, device_brand, device_os, device_os_version, device_browser, device_browser_version, "
    "geo_continent, geo_sub_continent, geo_country, geo_region, geo_city, geo_metro, session_number, user_type "
    "FROM sev", S_CTES)
ORACLE["filter_event_names"] = with_r(
    "SELECT id, event_name FROM ev WHERE event_name NOT IN ('session_start', 'first_visit')")
ORACLE["param_lookup"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, page_location, p_gsid AS ga_session_id, "
    "CAST(p_msec AS VARCHAR) AS engagement_time_msec, p_eng_str AS session_engaged_text, "
    "p_eng_int AS session_engaged_int, v AS value, CAST(NULL AS VARCHAR) AS missing FROM rf")
ORACLE["param_lookup_numeric"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, CAST(p_msec AS DOUBLE) AS engagement_time_msec, "
    "CAST(p_gsnum AS DOUBLE) AS ga_session_number, CAST(NULL AS DOUBLE) AS value FROM rf")

ORACLE["url_param"] = (
    f"SELECT page_id, {up('page', 'url')} AS page, {up('ref', 'url')} AS ref, "
    f"{up('utm_source', 'url')} AS utm_source, {up('source', 'url')} AS source FROM pages")
ORACLE["page_url_parts"] = "SELECT page_id, " + ", ".join(
    f"{part(p, 'url')} AS page_{p}" for p in ("protocol", "hostname", "port", "path", "query", "fragment")
) + " FROM pages"
ORACLE["referrer_hostname"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, p_referrer AS referrer, referrer_hostname FROM e1")
ORACLE["trailing_slash"] = (
    f"SELECT page_id, {slash(part('path', 'url'))} AS path, '/' AS null_path FROM pages")
ORACLE["clean_page_path"] = (
    f"SELECT page_id, {part('hostname', 'url')} || ({slash(part('path', 'url'))}) AS page_path, "
    f"{part('hostname', 'url')} || lower({part('path', 'url')}) AS page_path_custom FROM pages")

_DECODE = [("%7C", "|"), ("%20", " "), ("%21", "!"), ("%2E", "."), ("%2C", ","), ("%2F", "/"),
           ("%3A", ":"), ("%3B", ";"), ("%3F", "?"), ("%40", "@"), ("%23", "#"), ("%24", "$"),
           ("%25", "%"), ("%26", "&"), ("%27", "''"), ("%28", "("), ("%29", ")"), ("%2A", "*"),
           ("%2B", "+"), ("%3D", "="), ("%5B", "["), ("%5D", "]"), ("%7B", "{"), ("%7D", "}"),
           ("%3C", "<"), ("%3E", ">")]


def _decode_sql(x: str) -> str:
    for a, b in _DECODE:
        x = f"replace({x}, '{a}', '{b}')"
    return x


_ENC = ("replace(replace(replace(replace(url, '/', '%2F'), '?', '%3F'), '=', '%3D'), '&', '%26') "
        "|| '%252B'")
ORACLE["common_url_decode"] = (
    f"SELECT page_id, enc AS encoded, {_decode_sql('enc')} AS decoded FROM (SELECT page_id, {_ENC} AS enc FROM pages)")
ORACLE["surrogate_key"] = with_r(
    f"SELECT id, session_id, {skey('event_name', 'page_port', 'ga_session_id')} AS key3 FROM ev")
ORACLE["event_time_parts"] = with_r(
    "SELECT id, event_timestamp_utc, event_hour_of_day_utc, CAST(event_timestamp_utc AS DATE) AS event_date_utc FROM ev")
ORACLE["engagement_seconds"] = with_r("SELECT id, engagement_time_sec FROM ev")

# -- event windows ------------------------------------------------------------------
ORACLE["event_rank"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, user_pseudo_id, row_num, eid AS event_id FROM e4")
ORACLE["event_rank_instant"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, user_pseudo_id, rn2 AS row_num, "
    f"{skey('business_unit', 'user_pseudo_id', 'ets', 'rn2')} AS event_id FROM "
    "(SELECT e3.*, row_number() OVER (PARTITION BY user_pseudo_id, ets ORDER BY event_name, event_id) AS rn2 FROM e3)")
ORACLE["session_id_backfill"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, ga_session_id, session_id FROM e5")
ORACLE["page_navigation"] = with_r(
    "SELECT id, page_path, seconds_on_page, is_entrance, is_exit, page_sequence, previous_page_path, "
    "previous_page_event_id, previous_page_ts_utc, prev_prev_page_path, next_page_path, next_page_event_id, "
    "next_page_ts_utc, next_next_page_path FROM ev WHERE event_name = 'page_view'")
ORACLE["event_sequence"] = with_r("SELECT id, event_name, event_sequence FROM ev")
ORACLE["join_sequences"] = with_r(
    "SELECT id, event_sequence, page_sequence, previous_page_event_id, next_page_event_id FROM ev")

# -- session steps ----------------------------------------------------------------------
ORACLE["first_session_start"] = with_r(
    "SELECT session_id, opening.event_timestamp_utc AS session_start_at_utc, opening.landing_page, "
    "opening.ts_medium AS medium, opening.session_number FROM visits WHERE opening IS NOT NULL", S_CTES)
ORACLE["session_attribution"] = with_r(
    "SELECT session_id, earliest.event_timestamp_utc AS session_start_at_utc, earliest.landing_page, "
    "earliest.ts_source AS source, earliest.ts_medium AS medium FROM visits", S_CTES)
ORACLE["last_non_direct"] = with_r(
    "SELECT session_id, credited_id AS last_non_direct_session_id FROM credit", S_CTES)
ORACLE["session_engagement"] = with_r(
    "SELECT session_id, is_engaged, engaged_seconds, event_count, last_event_at_utc AS session_end_at_utc FROM visits",
    S_CTES)
ORACLE["session_page_views"] = with_r(
    "SELECT session_id, page_views FROM visits WHERE page_views IS NOT NULL", S_CTES)
ORACLE["distinct_composite_count"] = with_r("SELECT session_id, event_count FROM visits", S_CTES)
ORACLE["session_duration"] = with_sessions(
    "SELECT id, session_start_at_utc, session_end_at_utc, duration_seconds FROM sm")
ORACLE["source_medium"] = with_sessions(
    "SELECT id, last_source_medium, last_non_direct_source_medium FROM sm")
ORACLE["join_session_star"] = with_sessions("SELECT * FROM sm", lookback=None)
ORACLE["join_last_non_direct"] = with_sessions(
    "SELECT id, last_non_direct_landing_page, last_non_direct_source, last_non_direct_medium, "
    "last_non_direct_source_medium, last_non_direct_campaign, last_non_direct_gclid, "
    "last_non_direct_google_ads_customer_id, last_non_direct_fbclid FROM sm", lookback=7)
ORACLE["first_touch"] = (
    "SELECT id, first_landing_page, first_source, first_medium, first_source_medium, first_gclid, "
    "first_session_start_at_utc FROM (" + users_sql(False) + ")")

# -- products steps -----------------------------------------------------------------------
ORACLE["filter_ecommerce"] = with_o(
    "SELECT id, event_name FROM oev WHERE event_name IN ('add_payment_info', 'add_shipping_info', "
    "'add_to_cart', 'add_to_wishlist', 'begin_checkout', 'purchase', 'refund', 'remove_from_cart', "
    "'select_item', 'select_promotion', 'view_cart', 'view_item', 'view_item_list', 'view_promotion')")
ORACLE["explode_items"] = with_o(
    "SELECT e.id AS event_id, CAST(ol.l_partkey AS VARCHAR) AS item_id, "
    "CASE WHEN ol.l_partkey % 11 <> 0 THEN ol.p_brand END AS item_brand, ol.qty AS quantity "
    "FROM oev e JOIN ol ON ol.l_orderkey = e.o_orderkey")
ORACLE["distinct_items"] = with_o(item_rows_select(True))
ORACLE["param_value_string"] = EVENT_PARAMS_SQL.replace(
    "SELECT event_id || key AS id, event_id,", "SELECT id, key, event_parameter_value FROM (SELECT event_id || key AS id, event_id,") + ")"
ORACLE["explode_params"] = with_r(
    "SELECT event_id, key FROM epu", "epu AS (" + __import__("clickmarts.oracle", fromlist=["x"]).params_union() + "),\n")

# -- streaming (deterministic ones get a full oracle) ------------------------------------
ORACLE["stream_prepare"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, user_pseudo_id, p_gsid AS ga_session_id, event_name, "
    "page_url, ts_source AS event_traffic_source_source, ts_medium AS event_traffic_source_medium, "
    "date_tz, is_streaming FROM e5")
ORACLE["stream_refresh"] = with_r(
    f"SELECT {skey('business_unit', 'user_pseudo_id', 'ets', 'rn2')} AS id, session_id, user_pseudo_id, "
    "event_name, event_sequence, page_sequence, date_tz FROM "
    "(SELECT ev.*, row_number() OVER (PARTITION BY user_pseudo_id, ets ORDER BY event_name, event_id) AS rn2 FROM ev)")

# The sliced layout must give exactly the default results.
ORACLE["events_mart_sliced"] = ORACLE["events_mart"]
ORACLE["sessions_mart_sliced"] = ORACLE["sessions_mart"]

ORACLE["users_rollup"] = (
    "SELECT id, first_session_at_utc, last_session_at_utc, sessions, page_views, total_session_duration, "
    "total_engaged_seconds, total_events FROM (" + users_sql(False) + ")")
ORACLE["src_prefer_daily"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, "
    "CASE WHEN date_tz = (SELECT max(date_tz) FROM e5) THEN 'daily' ELSE is_streaming END AS is_streaming, "
    "date_tz FROM e5")

ORACLE["stream_sessions_complete"] = with_r(
    f"SELECT {skey('user_pseudo_id', 'g')} AS session_id, make_timestamp((g // 86400) * 86400000000) AS window_start, "
    "user_pseudo_id, count(*) AS events, CAST(count_if(event_name = 'page_view') AS BIGINT) AS page_views, "
    "sum(p_msec) / 1000 AS engaged_seconds, make_timestamp(min(ets)) AS first_event_at_utc, "
    "make_timestamp(max(ets)) AS last_event_at_utc "
    "FROM (SELECT *, coalesce(p_gsid, CAST(left(CAST(ets AS VARCHAR), 10) AS BIGINT)) AS g FROM e0) "
    "GROUP BY ALL")
ORACLE["events_mart_split"] = ORACLE["events_mart"]
ORACLE["sessions_mart_split"] = ORACLE["sessions_mart"]

# -- written tables: schema versions, snapshots, refreshes, batches ------------------------
_NEW = "day >= '20240111'"
ORACLE["src_schema_evolution"] = with_r(
    f"SELECT event_id AS event_bundle_sequence_id, coalesce(CASE WHEN {_NEW} THEN nullif(sts_source, '(not set)') END, "
    f"CASE WHEN {_NEW} THEN cts_source END, {up('utm_source', 'page_location')}) AS source, "
    f"coalesce(CASE WHEN {_NEW} THEN nullif(sts_medium, '(not set)') END, {up('utm_medium', 'page_location')}) AS medium, "
    f"CASE WHEN {_NEW} THEN host END AS hostname, device_category, k AS event_server_timestamp_offset, "
    "CASE WHEN event_name = 'purchase' THEN CAST(1 AS BIGINT) END AS total_item_quantity, date_tz FROM e5")
ORACLE["src_newest_day"] = ORACLE["src_incremental_bound"]
ORACLE["sink_snapshot_versions"] = with_r(
    "SELECT id, date_tz, 1 AS version, 1 AS snapshot FROM ev UNION ALL "
    "SELECT id, date_tz, CASE WHEN date_tz >= (SELECT max(date_tz) FROM ev) - INTERVAL 3 DAY THEN 2 ELSE 1 END, 2 FROM ev")
ORACLE["sink_column_log"] = with_r(
    "SELECT id, CASE WHEN date_tz >= (SELECT max(date_tz) FROM ev) - INTERVAL 3 DAY THEN page_path END AS page_path, "
    "CASE WHEN date_tz >= (SELECT max(date_tz) FROM ev) - INTERVAL 1 DAY THEN event_name END AS event_name, "
    "event_sequence, date_tz FROM ev")
ORACLE["read_export"] = with_r(
    "SELECT business_unit, event_id AS event_bundle_sequence_id, event_name, is_streaming, date_tz FROM e5")
ORACLE["refresh_events"] = ORACLE["stream_refresh"]
ORACLE["stream_marts_events"] = ORACLE["stream_refresh"]
ORACLE["refresh_sessions"] = ORACLE["sessions_mart"]
ORACLE["stream_marts_sessions"] = ORACLE["sessions_mart"]
ORACLE["refresh_products"] = (
    "SELECT * EXCLUDE (event_id, event_specific_item_id, event_specific_variant_id, date_tz) FROM (" + PRODUCTS_SQL + ")")

# Live sessions: the rows whose slice (its middle hour and half an hour on both sides) has
# closed a day before the newest event.
ORACLE["stream_sessions"] = with_r(
    "SELECT session_id, user_pseudo_id, count(*) AS events, CAST(count_if(event_name = 'page_view') AS BIGINT) AS page_views, "
    "sum(p_msec) / 1000 AS engaged_seconds, make_timestamp(min(ets)) AS first_event_at_utc, "
    "make_timestamp(max(ets)) AS last_event_at_utc FROM e5 "
    "WHERE ((ets // 1000000 - 1800) // 3600 * 3600 + 7200) * 1000 <= (SELECT max(ets) FROM e5) // 1000 - 86400000 "
    "GROUP BY session_id, user_pseudo_id")

# -- every traffic source filled ----------------------------------------------------------
from clickmarts import oracle_campaigns  # noqa: E402

ORACLE["campaign_traffic_fields"] = oracle_campaigns.TRAFFIC_SQL
ORACLE["campaign_templates"] = oracle_campaigns.TEMPLATES_SQL
ORACLE["campaign_channels"] = oracle_campaigns.CHANNEL_SQL
ORACLE["campaign_records"] = oracle_campaigns.RECORDS_SQL

# -- the marts in plain SQL -----------------------------------------------------------------
ORACLE["sql_event_params"] = EVENT_PARAMS_SQL
ORACLE["sql_users"] = ORACLE["users_mart"]
ORACLE["sql_products"] = PRODUCTS_SQL
ORACLE["sql_functions"] = with_r(
    "SELECT event_id AS event_bundle_sequence_id, p_gsid AS ga_session_id, CAST(p_msec AS DOUBLE) AS engagement_time_msec, "
    f"v AS value, page_location, {up('utm_source', 'page_location')} AS utm_source, {up('source', 'page_location')} AS source, "
    + ", ".join(f"{part(p, 'page_location')} AS page_{p}" for p in ("protocol", "port", "query", "fragment"))
    + f", {slash(part('path', 'page_location'))} AS path, {part('hostname', 'p_referrer')} AS referrer_hostname, "
    f"{_decode_sql(chr(39).join(['replace(page_location, ', '/', ', ', '%2F', ')']))} AS decoded, "
    f"{skey('event_name', 'CAST(NULL AS VARCHAR)')} AS key2 FROM rf")
