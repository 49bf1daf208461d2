"""Traffic attribution on events.

All fields are plain column expressions over one row: coalesce chains across
the session record, the collected record, URL parameters of ``page_location``
and event parameters, then a four-branch CASE deciding the channel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmarts.config import NOT_SET
from clickmarts.functions.params import param as _param
from clickmarts.functions.params import param_keys
from clickmarts.functions.urls import hostname, url_param

STSLC = "session_traffic_source_last_click"
CTS = "collected_traffic_source"

# ---------------------------------------------------------------------------
# Output field -> URL parameter name, per template struct, in
# the reference's field order.
# ---------------------------------------------------------------------------
GOOGLE_ADS_URL_FIELDS = (
    ("google_ads_matchtype", "g_mt"),
    ("google_ads_ad_id", "g_adid"),
    ("google_ads_extension_id", "g_exid"),
    ("google_ads_device", "g_dev"),
    ("google_ads_device_model", "g_devm"),
    ("google_ads_network", "g_nwk"),
    ("google_ads_location_physical", "g_locp"),
    ("google_ads_location_interest", "g_loci"),
    ("google_ads_placement", "g_pmt"),
    ("google_ads_target", "g_tgt"),
    ("google_ads_adtype", "g_adt"),
    ("google_ads_video_source_id", "g_sid"),
)
PMAX_URL_FIELDS = (
    ("google_ads_merchant_id", "g_mid"),
    ("google_ads_product_channel", "g_pch"),
    ("google_ads_product_id", "g_pid"),
    ("google_ads_product_country", "g_pc"),
    ("google_ads_product_language", "g_pl"),
    ("google_ads_product_partition_id", "g_ppid"),
    ("google_ads_store_code", "g_sc"),
)
HOTEL_URL_FIELDS = (
    ("google_ads_hotelcenter_id", "g_hcid"),
    ("google_ads_hotel_id", "g_hid"),
    ("google_ads_hotel_partition_id", "g_hpid"),
    ("google_ads_hotel_adtype", "g_hatype"),
    ("google_ads_travel_start_day", "g_hstd"),
    ("google_ads_travel_start_month", "g_hstm"),
    ("google_ads_travel_start_year", "g_hsty"),
    ("google_ads_travel_end_day", "g_hend"),
    ("google_ads_travel_end_month", "g_henm"),
    ("google_ads_travel_end_year", "g_heny"),
    ("google_ads_advanced_booking_window", "g_hadv"),
    ("google_ads_date_type", "g_dtp"),
    ("google_ads_number_of_adults", "g_hnum"),
    ("google_ads_price_displayed_total", "g_htot"),
    ("google_ads_price_displayed_tax", "g_htx"),
    ("google_ads_user_currency", "g_hcur"),
    ("google_ads_user_language", "g_hlg"),
    ("google_ads_rate_rule_id", "g_hrtid"),
)
# Click ids read from the URL only (dclid and srsltid also consult the
# collected record and come first in the struct).
CLICK_ID_URL_FIELDS = (
    "msclkid", "fbclid", "gbraid", "wbraid", "li_fat_id", "twclid",
    "rdt_cid", "ttclid", "ScCid", "irclickid",
)

# Field order of the four derived structs (as emitted).
GOOGLE_ADS_FIELDS = (
    "google_ads_customer_id", "google_ads_account_name", "google_ads_ad_group_id",
    "google_ads_ad_group_name",
) + tuple(f for f, _ in GOOGLE_ADS_URL_FIELDS)
PMAX_FIELDS = tuple(f for f, _ in PMAX_URL_FIELDS)
HOTEL_FIELDS = tuple(f for f, _ in HOTEL_URL_FIELDS)
CLICK_ID_FIELDS = ("dclid", "srsltid") + CLICK_ID_URL_FIELDS
TRAFFIC_SOURCE_FIELDS = ("campaign", "medium", "source", "content", "term",
                         "campaign_id", "referrer", "gclid")


def _set(c: Column) -> Column:
    """The literal '(not set)' counts as missing in the session record."""
    return F.nullif(c, F.lit(NOT_SET))


def extract_params(df: DataFrame, events_col: str = "event_params") -> DataFrame:
    """Materialise the event parameters every later step reads (F1, F5, F12 inputs)."""
    ep = F.col(events_col)
    df = df.withColumn("_param_keys", param_keys(ep))
    keys = F.col("_param_keys")

    def param(arr, key, slot="string_value"):
        return _param(arr, key, slot, keys)

    return df.withColumns({
        "page_url": param(ep, "page_location"),
        "page_title": param(ep, "page_title"),
        "page_referrer": param(ep, "page_referrer"),
        "referrer": param(ep, "referrer"),
        "ignore_referrer": F.coalesce(param(ep, "ignore_referrer"), F.lit("false")),
        "ga_session_id": param(ep, "ga_session_id", "int_value"),
        "ga_session_number": param(ep, "ga_session_number", "int_value"),
        "_engagement_time_text": param(ep, "engagement_time_msec"),
        "_p_source": param(ep, "source"),
        "_p_medium": param(ep, "medium"),
        "_p_campaign": param(ep, "campaign"),
        "_p_campaign_id": param(ep, "campaign_id"),
        "_p_content": param(ep, "content"),
        "_p_term": param(ep, "term"),
        "_p_gclid": param(ep, "gclid"),
    }).drop("_param_keys")


def resolve_traffic_fields(df: DataFrame, extended: bool = False) -> DataFrame:
    """Prioritised source / medium / campaign / ... / gclid.

    Expects ``page_url`` and the ``_p_*`` parameter columns of
    :func:`extract_params`.  ``extended`` also emits creative_format,
    marketing_tactic, source_platform and the recorded first traffic source,
    which the reference computes but never outputs.
    """
    mc = f"{STSLC}.manual_campaign"
    gc = f"{STSLC}.google_ads_campaign"
    url = F.col("page_url")
    cols = {
        "source": F.coalesce(_set(F.col(f"{mc}.source")), F.col(f"{CTS}.manual_source"),
                             url_param(url, "utm_source"), F.col("_p_source")),
        "medium": F.coalesce(_set(F.col(f"{mc}.medium")), F.col(f"{CTS}.manual_medium"),
                             url_param(url, "utm_medium"), F.col("_p_medium")),
        "campaign": F.coalesce(_set(F.col(f"{gc}.campaign_name")), _set(F.col(f"{mc}.campaign_name")),
                               F.col(f"{CTS}.manual_campaign_name"), url_param(url, "utm_campaign"),
                               F.col("_p_campaign")),
        "campaign_id": F.coalesce(_set(F.col(f"{gc}.campaign_id")), _set(F.col(f"{mc}.campaign_id")),
                                  F.col(f"{CTS}.manual_campaign_id"), url_param(url, "campaign_id"),
                                  F.col("_p_campaign_id")),
        "content": F.coalesce(_set(F.col(f"{mc}.content")), F.col(f"{CTS}.manual_content"),
                              url_param(url, "utm_content"), F.col("_p_content")),
        "term": F.coalesce(_set(F.col(f"{mc}.term")), F.col(f"{CTS}.manual_term"),
                           url_param(url, "utm_term"), F.col("_p_term")),
        # gclid: collected record, then event parameter, then URL.
        "gclid": F.coalesce(F.col(f"{CTS}.gclid"), F.col("_p_gclid"), url_param(url, "gclid")),
    }
    if extended:
        cols.update({
            "creative_format": F.coalesce(_set(F.col(f"{mc}.creative_format")),
                                          F.col(f"{CTS}.manual_creative_format")),
            "marketing_tactic": F.coalesce(_set(F.col(f"{mc}.marketing_tactic")),
                                           F.col(f"{CTS}.manual_marketing_tactic")),
            "source_platform": F.coalesce(_set(F.col(f"{mc}.source_platform")),
                                          F.col(f"{CTS}.manual_source_platform")),
            "first_traffic_source_source": F.col("traffic_source.source"),
            "first_traffic_source_medium": F.col("traffic_source.medium"),
            "first_traffic_source_campaign": F.col("traffic_source.name"),
        })
    return df.withColumns(cols)


def google_ads_struct(url: Column) -> Column:
    """Google Ads template (P6): 16 fields, 4 from the session record."""
    gc = f"{STSLC}.google_ads_campaign"
    fields = [
        F.coalesce(_set(F.col(f"{gc}.customer_id")), url_param(url, "g_acid")).alias("google_ads_customer_id"),
        _set(F.col(f"{gc}.account_name")).alias("google_ads_account_name"),
        _set(F.col(f"{gc}.ad_group_id")).alias("google_ads_ad_group_id"),
        F.coalesce(_set(F.col(f"{gc}.ad_group_name")), url_param(url, "utm_content")).alias("google_ads_ad_group_name"),
    ] + [url_param(url, p).alias(f) for f, p in GOOGLE_ADS_URL_FIELDS]
    return F.struct(*fields)


def pmax_struct(url: Column) -> Column:
    """PMax / shopping template."""
    return F.struct(*[url_param(url, p).alias(f) for f, p in PMAX_URL_FIELDS])


def hotel_struct(url: Column) -> Column:
    """Hotel template."""
    return F.struct(*[url_param(url, p).alias(f) for f, p in HOTEL_URL_FIELDS])


def click_ids_struct(url: Column) -> Column:
    """Click ids (P9); dclid / srsltid prefer the collected record."""
    fields = [
        F.coalesce(F.col(f"{CTS}.dclid"), url_param(url, "dclid")).alias("dclid"),
        F.coalesce(F.col(f"{CTS}.srsltid"), url_param(url, "srsltid")).alias("srsltid"),
    ] + [url_param(url, p).alias(p) for p in CLICK_ID_URL_FIELDS]
    return F.struct(*fields)


def add_templates(df: DataFrame) -> DataFrame:
    url = F.col("page_url")
    return df.withColumns({
        "event_traffic_source_template_google_ads": google_ads_struct(url),
        "event_traffic_source_template_google_pmax_shopping": pmax_struct(url),
        "event_traffic_source_template_google_hotel": hotel_struct(url),
        "event_traffic_source_click_ids": click_ids_struct(url),
        "referrer_hostname": hostname(F.col("referrer")),
    })


def resolve_channel(df: DataFrame, not_set: str = NOT_SET) -> DataFrame:
    """Channel override (P10) -> ``event_traffic_source`` struct of 8 fields.

    Branches in order: (a) a Google click id (gclid / wbraid / gbraid) ->
    google / cpc; (b) any of source, medium, campaign present and not an
    ignored referral; (c) a referrer that is not ignored -> referral from the
    referrer's host; (d) (direct) / (none).  SQL three-valued logic is kept:
    with medium NULL and ignore_referrer 'true', ``not (medium = 'referral'
    and ...)`` is NULL and branch (b) is not taken.
    """
    ns = F.lit(not_set)
    campaign, medium, source = F.col("campaign"), F.col("medium"), F.col("source")
    content, term, campaign_id = F.col("content"), F.col("term"), F.col("campaign_id")
    referrer, gclid = F.col("referrer"), F.col("gclid")
    ignore = F.col("ignore_referrer") == F.lit("true")
    clicks = F.col("event_traffic_source_click_ids")

    def ts(campaign_, medium_, source_, content_, term_, campaign_id_):
        return F.struct(
            campaign_.alias("campaign"), medium_.alias("medium"), source_.alias("source"),
            content_.alias("content"), term_.alias("term"), campaign_id_.alias("campaign_id"),
            F.coalesce(referrer, ns).alias("referrer"), gclid.alias("gclid"),
        )

    paid = F.coalesce(gclid, clicks["wbraid"], clicks["gbraid"]).isNotNull()
    tagged = F.coalesce(source, medium, campaign).isNotNull() & ~((medium == F.lit("referral")) & ignore)
    referral = referrer.isNotNull() & ~ignore
    channel = (
        F.when(paid, ts(F.coalesce(campaign, ns), F.lit("cpc"), F.lit("google"),
                        F.coalesce(content, ns), F.coalesce(term, ns), F.coalesce(campaign_id, ns)))
        .when(tagged, ts(F.coalesce(campaign, ns), F.coalesce(medium, ns), F.coalesce(source, ns),
                         F.coalesce(content, ns), F.coalesce(term, ns), F.coalesce(campaign_id, ns)))
        .when(referral, ts(ns, F.lit("referral"), F.coalesce(F.col("referrer_hostname"), ns),
                           ns, ns, ns))
        .otherwise(ts(ns, F.lit("(none)"), F.lit("(direct)"), ns, ns, ns))
    )
    return df.withColumn("event_traffic_source", channel)
