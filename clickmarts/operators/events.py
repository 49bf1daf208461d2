"""Event preparation and the per-user / per-session windows.

Physical shape: every window here is keyed by ``user_pseudo_id`` or by
(user, session).  Hash partitioning on the user satisfies all of them, so the
events mart plans a single exchange of the event rows, and two sorts: by the
user's time (rank and back-fill) and by session (navigation and sequence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmarts.config import SEQUENCE_EXCLUDED_EVENTS, SESSION_LENGTH_SECONDS
from clickmarts.functions.keys import surrogate_key
from clickmarts.functions.timeparts import engagement_seconds, seconds_from_micros
from clickmarts.functions.urls import clean_page_path, url_parts

ANON_PREFIX = "anon-"
DEFAULT_ANON_KEY = ("business_unit", "stream_id", "event_timestamp", "event_name",
                    "event_bundle_sequence_id")


# Columns that tell rows of one user, time, name and bundle apart, if any do.
ROW_CONTENT = ("event_params", "user_properties", "items", "ecommerce", "device", "geo", "privacy_info",
               "event_server_timestamp_offset", "event_value_in_usd", "is_streaming")


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's content with its records and arrays and the kind of its shard: the last
    sort key of ranks, so that rows that differ at all rank the same way on every run.
    Rows that left their records behind bring it along as ``_row_hash``."""
    if "_row_hash" in df.columns:
        return F.col("_row_hash")
    return F.xxhash64(*[F.col(c) for c in ROW_CONTENT if c in df.columns])


def fill_user_id(df: DataFrame, key_cols=DEFAULT_ANON_KEY, numbered: bool = False) -> DataFrame:
    """Replace a NULL ``user_pseudo_id`` by a deterministic id.

    The reference draws a random UUID; a hash of stable row fields gives the
    same "one anonymous user per event" effect but survives task retries and
    re-runs.  Anonymous events therefore never pile up in one window
    partition.

    Events that agree in ``key_cols`` share an id.  With ``numbered`` each is a user of its
    own: those after the first get their number appended, in the order of their content
    (equal rows are interchangeable, so the set of ids is the same on every run).  Only the
    anonymous rows are shuffled for it, by their key.
    """
    if numbered:
        anonymous = df.where(F.col("user_pseudo_id").isNull())
        key = F.concat(F.lit(ANON_PREFIX), surrogate_key(*key_cols))
        number = F.row_number().over(Window.partitionBy("_anon").orderBy("_hash"))
        ids = anonymous.withColumns({"_anon": key, "_hash": row_hash(df)}).withColumn("_number", number)
        own = F.when(F.col("_number") == 1, F.col("_anon")).otherwise(F.concat("_anon", F.lit("-"), F.col("_number").cast("string")))
        filled = ids.withColumns({"has_null_user_pseudo_id": F.lit(True), "user_pseudo_id": own}).drop("_anon", "_hash", "_number")
        known = df.where(F.col("user_pseudo_id").isNotNull()).withColumn("has_null_user_pseudo_id", F.lit(False))
        return known.unionByName(filled)
    return df.withColumns({
        "has_null_user_pseudo_id": F.col("user_pseudo_id").isNull(),
        "user_pseudo_id": F.coalesce(
            F.col("user_pseudo_id"),
            F.concat(F.lit(ANON_PREFIX), surrogate_key(*key_cols))),
    })


# (output column, source expression) of the flattened event (P11), in order.
def _flat_columns():
    d, g, e, p = "device", "geo", "ecommerce", "privacy_info"
    return [
        ("event_name", "event_name"),
        ("event_timestamp_utc", "event_timestamp"),
        ("business_unit", "business_unit"),
        ("event_params", "event_params"),
        ("event_previous_timestamp_utc", "event_previous_timestamp"),
        ("event_value_in_usd", "event_value_in_usd"),
        ("event_bundle_sequence_id", "event_bundle_sequence_id"),
        ("event_server_timestamp_offset", "event_server_timestamp_offset"),
        ("user_id", "user_id"),
        ("user_properties", "user_properties"),
        ("user_pseudo_id", "user_pseudo_id"),
        ("has_null_user_pseudo_id", "has_null_user_pseudo_id"),
        ("ga_session_id", "ga_session_id"),
        ("ga_session_number", "ga_session_number"),
        ("privacy_info_analytics_storage", f"{p}.analytics_storage"),
        ("privacy_info_ads_storage", f"{p}.ads_storage"),
        ("privacy_info_uses_transient_token", f"{p}.uses_transient_token"),
        ("device_category", f"{d}.category"),
        ("device_brand", f"{d}.mobile_brand_name"),
        ("device_mobile_model_name", f"{d}.mobile_model_name"),
        ("device_mobile_os_hardware_model", f"{d}.mobile_os_hardware_model"),
        ("device_mobile_marketing_name", f"{d}.mobile_marketing_name"),
        ("device_operating_system", f"{d}.operating_system"),
        ("device_operating_system_version", f"{d}.operating_system_version"),
        ("device_language", f"{d}.language"),
        ("device_is_limited_ad_tracking", f"{d}.is_limited_ad_tracking"),
        ("device_advertising_id", f"{d}.advertising_id"),
        ("device_vendor_id", f"{d}.vendor_id"),
        ("device_browser", F.coalesce(F.col(f"{d}.browser"), F.col(f"{d}.web_info.browser"))),
        ("device_browser_version", F.coalesce(F.col(f"{d}.browser_version"),
                                              F.col(f"{d}.web_info.browser_version"))),
        ("hostname", f"{d}.web_info.hostname"),
        ("geo_continent", f"{g}.continent"),
        ("geo_country", f"{g}.country"),
        ("geo_region", f"{g}.region"),
        ("geo_city", f"{g}.city"),
        ("geo_metro", f"{g}.metro"),
        ("geo_sub_continent", f"{g}.sub_continent"),
        ("ecommerce_total_item_quantity", f"{e}.total_item_quantity"),
        ("ecommerce_purchase_revenue_in_usd", f"{e}.purchase_revenue_in_usd"),
        ("ecommerce_purchase_revenue", f"{e}.purchase_revenue"),
        ("ecommerce_refund_value_in_usd", f"{e}.refund_value_in_usd"),
        ("ecommerce_refund_value", f"{e}.refund_value"),
        ("ecommerce_shipping_value_in_usd", f"{e}.shipping_value_in_usd"),
        ("ecommerce_shipping_value", f"{e}.shipping_value"),
        ("ecommerce_tax_value_in_usd", f"{e}.tax_value_in_usd"),
        ("ecommerce_tax_value", f"{e}.tax_value"),
        ("ecommerce_unique_items", f"{e}.unique_items"),
        ("ecommerce_transaction_id", f"{e}.transaction_id"),
        ("items", "items"),
        ("stream_id", "stream_id"),
        ("platform", "platform"),
        ("event_traffic_source", "event_traffic_source"),
        ("event_traffic_source_template_google_ads", "event_traffic_source_template_google_ads"),
        ("event_traffic_source_template_google_pmax_shopping",
         "event_traffic_source_template_google_pmax_shopping"),
        ("event_traffic_source_template_google_hotel", "event_traffic_source_template_google_hotel"),
        ("event_traffic_source_click_ids", "event_traffic_source_click_ids"),
        ("app_info_id", "app_info.id"),
        ("page_title", "page_title"),
        ("page_url", "page_url"),
        ("gclid", "gclid"),
        ("page_referrer", "page_referrer"),
        ("referrer", "referrer"),
        ("referrer_hostname", "referrer_hostname"),
        ("ignore_referrer", "ignore_referrer"),
        ("engagement_time_sec", "engagement_time_sec"),
        ("is_streaming", "is_streaming"),
        ("date_tz", "date_tz"),
    ]


def flatten_records(df: DataFrame, strict_engagement: bool = True) -> DataFrame:
    """Rename / flatten nested records to the event column set.

    Nested-field selection lets the parquet reader prune unread struct
    fields.
    """
    df = df.withColumn("engagement_time_sec",
                       engagement_seconds(F.col("_engagement_time_text"), strict_engagement))
    out = []
    for name, src in _flat_columns():
        c = F.col(src) if isinstance(src, str) else src
        out.append(c.alias(name))
    return df.select(*out)


def window_inputs(df: DataFrame) -> DataFrame:
    """Columns the windows read, named as in the mart, added to the raw row.

    The events mart runs its windows on raw rows plus these few columns and
    derives everything else afterwards (:func:`finish_columns`): the shuffle
    and the window sorts then carry the raw record, not the ~60 derived
    attribution fields that depend on the row alone.
    """
    return df.withColumns({
        "event_timestamp_utc": F.col("event_timestamp"),
        "hostname": F.col("device.web_info.hostname"),
    })


def finish_columns(df: DataFrame, strict_engagement: bool = True) -> DataFrame:
    """Select the 86 mart columns from a windowed raw row."""
    from clickmarts.functions.timeparts import hour_from_micros
    computed = {
        "id": F.col("event_id"),
        "event_timestamp_utc": F.col("event_timestamp_utc"),
        "event_hour_of_day_utc": hour_from_micros(F.col("_event_micros")),
        "page": F.col("page_path"),
        "engagement_time_sec": engagement_seconds(F.col("_engagement_time_text"), strict_engagement),
    }
    raw_paths = {name: src for name, src in _flat_columns()}
    out = []
    for name in EVENT_COLUMNS:
        if name in computed:
            c = computed[name]
        elif name in raw_paths and name not in df.columns:
            src = raw_paths[name]
            c = F.col(src) if isinstance(src, str) else src
        else:
            c = F.col(name)
        out.append(c.alias(name))
    return df.select(*out)


def rank_events(df: DataFrame, id_scope: str = "scan") -> DataFrame:
    """Per-user event rank (W1) and the event id built from it.

    ``scan``: ``row_number`` over the user's scanned events ordered by time
    and name (reference).  ``instant``: rank only among events of the same
    user and microsecond, so ids are stable when other days are re-read and
    the window is keyed by (user, instant): no hot-user partition.  (The second
    is a function of the instant.  Rows that already lie by user stay there, and
    the back-fill finds its order.)
    The bundle sequence id and a hash of the content are the last sort keys, so
    ties resolve the same way on every run.
    """
    # By whole second first: the back-fill's window then needs no sort of its own.
    df = df.withColumn("_sec", seconds_from_micros(F.col("event_timestamp_utc")))
    if id_scope == "scan":
        w = Window.partitionBy("user_pseudo_id").orderBy(
            "_sec", "event_timestamp_utc", "event_name", "event_bundle_sequence_id", row_hash(df))
    elif id_scope == "instant":
        w = Window.partitionBy("user_pseudo_id", "_sec", "event_timestamp_utc").orderBy(
            "event_name", "event_bundle_sequence_id", row_hash(df))
    else:
        raise ValueError(f"id_scope must be 'scan' or 'instant', got {id_scope!r}")
    df = df.withColumn("_row_num", F.row_number().over(w).cast("long"))
    return df.withColumn(
        "event_id",
        surrogate_key("stream_id", "user_pseudo_id", "event_timestamp_utc", "_row_num"))


def backfill_session_id(df: DataFrame, seconds: int = SESSION_LENGTH_SECONDS,
                        keys: tuple[str, ...] = ("user_pseudo_id",)) -> DataFrame:
    """Fill a missing ``ga_session_id``.

    Reference: the last non-NULL id among the user's events within +-seconds
    (whole seconds, the frame may look forward), else the event's own epoch
    second (first 10 digits of the micros).

    Plan: the last non-NULL row with second <= s + n is found with a growing
    frame (UNBOUNDED PRECEDING .. n FOLLOWING), which Spark evaluates
    incrementally (O(rows)); it is accepted only if its second is >= s - n.
    This equals the +-n frame because every non-NULL row in the +-n frame has
    second <= s + n, and the last such row lies in the frame iff its second is
    >= s - n.  Ties within a second resolve by time, then the per-user rank.
    ``keys`` are the user, or the user and a slice that holds the whole frame.
    """
    if "_sec" not in df.columns:
        df = df.withColumn("_sec", seconds_from_micros(F.col("event_timestamp_utc")))
    w = (Window.partitionBy(*keys).orderBy("_sec")
         .rangeBetween(Window.unboundedPreceding, seconds))
    has = F.col("ga_session_id").isNotNull()
    cand = F.max_by(F.struct(F.col("_sec").alias("s"), F.col("ga_session_id").alias("v")),
                    F.when(has, F.struct(F.col("_sec"), F.col("event_timestamp_utc"),
                                         F.col("_row_num")))).over(w)
    df = df.withColumn("_cand", cand)
    own_second = F.substring(F.col("event_timestamp_utc").cast("string"), 1, 10).cast("long")
    filled = F.when(F.col("_cand.s") >= F.col("_sec") - F.lit(seconds), F.col("_cand.v"))
    return df.withColumn("ga_session_id", F.coalesce(F.col("ga_session_id"), filled, own_second)) \
             .drop("_cand", "_sec")


def add_session_key(df: DataFrame) -> DataFrame:
    """session_id from (user, ga_session_id); micros -> timestamp."""
    return df.withColumns({
        "session_id": surrogate_key("user_pseudo_id", "ga_session_id"),
        "_event_micros": F.col("event_timestamp_utc"),
        "event_timestamp_utc": F.timestamp_micros(F.col("event_timestamp_utc")),
    })


def with_url_parts(df: DataFrame, url_col: str = "page_url", clean_path=None) -> DataFrame:
    """page_protocol / hostname / port / path / query / fragment.

    ``page_path`` is the record's hostname followed by the cleaned path, so a
    NULL hostname gives a NULL path.
    """
    part = url_parts(F.col(url_col))
    return df.withColumns({
        "page_protocol": part["protocol"],
        "page_hostname": F.col("hostname"),
        "page_port": part["port"],
        "page_path": F.concat(F.col("hostname"), clean_page_path(part["path"], clean_path)),
        "page_query": part["query"],
        "page_fragment": part["fragment"],
    }).drop("hostname")


#: Navigation and sequence share one sort by session; what other rows they pass over is NULL there.
_IN_SESSION = "PARTITION BY user_pseudo_id, ga_session_id ORDER BY event_timestamp_utc, event_id"


def _running(condition: Column) -> Column:
    """How many rows of the session up to this one meet a condition."""
    w = (Window.partitionBy("user_pseudo_id", "ga_session_id").orderBy("event_timestamp_utc", "event_id")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.count_if(condition).over(w)


def page_navigation(df: DataFrame) -> DataFrame:
    """Page-view navigation within (user, session) (W3) without a self join.

    The reference computes the windows over page_view rows only and joins
    them back on the event id.  Here neighbours are looked up over all rows of
    the session, ignoring those that are no page views, which gives the
    page_view rows exactly those values; other rows get NULL.
    Missing neighbours read 'Entrance' / 'Exit' (as does a real NULL path).
    """
    df = df.withColumn("_is_pv", F.coalesce(F.col("event_name") == F.lit("page_view"), F.lit(False)))
    view = "CASE WHEN _is_pv THEN struct(page_path AS path, event_id AS id, event_timestamp_utc AS ts) END"
    near = {f"_{fn}{k}": F.expr(f"{fn}({view}, {k}) IGNORE NULLS OVER ({_IN_SESSION})") for fn in ("lag", "lead") for k in (1, 2)}
    df = df.withColumns({**near, "_seen": _running(F.col("_is_pv"))})
    nav = {
        "seconds_on_page": F.timestamp_diff("SECOND", F.col("event_timestamp_utc"), F.col("_lead1.ts")),
        "is_entrance": F.col("_seen") == F.lit(1),
        "is_exit": F.col("_lead1").isNull(),
        "page_sequence": F.col("_seen").cast("long"),
        "previous_page_path": F.coalesce(F.col("_lag1.path"), F.lit("Entrance")),
        "previous_page_event_id": F.col("_lag1.id"),
        "previous_page_ts_utc": F.col("_lag1.ts"),
        "prev_prev_page_path": F.coalesce(F.col("_lag2.path"), F.lit("Entrance")),
        "next_page_path": F.coalesce(F.col("_lead1.path"), F.lit("Exit")),
        "next_page_event_id": F.col("_lead1.id"),
        "next_page_ts_utc": F.col("_lead1.ts"),
        "next_next_page_path": F.coalesce(F.col("_lead2.path"), F.lit("Exit")),
    }
    return df.withColumns({k: F.when(F.col("_is_pv"), v) for k, v in nav.items()}).drop("_is_pv", "_seen", *near)


def event_sequence(df: DataFrame) -> DataFrame:
    """Position of the event in its session, session_start / first_visit excluded."""
    counted = F.coalesce(~F.col("event_name").isin(*SEQUENCE_EXCLUDED_EVENTS), F.lit(False))
    return df.withColumn("_seq_on", counted).withColumn(
        "event_sequence", F.when(F.col("_seq_on"), _running(F.col("_seq_on")).cast("long"))).drop("_seq_on")


# Output columns of the events mart, in order.
EVENT_COLUMNS = (
    "id", "event_timestamp_utc", "date_tz", "event_hour_of_day_utc", "business_unit",
    "session_id", "ga_session_id", "ga_session_number", "user_id", "user_pseudo_id",
    "event_name", "event_sequence", "event_params", "event_previous_timestamp_utc",
    "event_value_in_usd", "event_bundle_sequence_id", "event_server_timestamp_offset",
    "user_properties", "has_null_user_pseudo_id", "privacy_info_analytics_storage",
    "privacy_info_ads_storage", "privacy_info_uses_transient_token", "device_category",
    "device_brand", "device_mobile_model_name", "device_mobile_os_hardware_model",
    "device_mobile_marketing_name", "device_operating_system",
    "device_operating_system_version", "device_language", "device_is_limited_ad_tracking",
    "device_advertising_id", "device_vendor_id", "device_browser", "device_browser_version",
    "geo_continent", "geo_country", "geo_region", "geo_city", "geo_metro", "geo_sub_continent",
    "ecommerce_total_item_quantity", "ecommerce_purchase_revenue_in_usd",
    "ecommerce_purchase_revenue", "ecommerce_refund_value_in_usd", "ecommerce_refund_value",
    "ecommerce_shipping_value_in_usd", "ecommerce_shipping_value", "ecommerce_tax_value_in_usd",
    "ecommerce_tax_value", "ecommerce_unique_items", "ecommerce_transaction_id", "items",
    "stream_id", "platform", "event_traffic_source", "event_traffic_source_template_google_ads",
    "event_traffic_source_template_google_pmax_shopping",
    "event_traffic_source_template_google_hotel", "event_traffic_source_click_ids",
    "app_info_id", "page_title", "page_url", "referrer", "page_referrer", "page_protocol",
    "page_hostname", "page_port", "page_path", "page_query", "page_fragment", "page",
    "engagement_time_sec", "seconds_on_page", "is_entrance", "is_exit", "page_sequence",
    "previous_page_path", "previous_page_event_id", "previous_page_ts_utc",
    "prev_prev_page_path", "next_page_path", "next_page_event_id", "next_page_ts_utc",
    "next_next_page_path", "is_streaming",
)
