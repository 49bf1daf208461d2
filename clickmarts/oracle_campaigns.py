"""DuckDB SQL for the campaign fixture (C): its fields by rule, and attribution over them."""

from __future__ import annotations

from clickmarts.operators.attribution import CLICK_ID_URL_FIELDS, GOOGLE_ADS_URL_FIELDS, HOTEL_URL_FIELDS, PMAX_URL_FIELDS
from clickmarts.oracle import NS, part, up, with_r
from clickmarts.sources.campaigns import GEO_FIELDS, PARAM_NAMES, RULES, TRAFFIC_FIELDS, URL_NAMES, WEB_FIELDS
from clickmarts.sources.fixtures import (CTS_FIELDS, DEVICE_FIELDS, ECOMMERCE_FIELDS, GOOGLE_ADS_CAMPAIGN_FIELDS,
                                         MANUAL_CAMPAIGN_FIELDS)


def field(source: str, place: int, name: str) -> str:
    """A field's value by its rule, as SQL over ``event_id``."""
    period, has, slug, values = RULES[source]
    other = "" if slug is None else f" WHEN {slug} THEN {NS}"
    return (f"CASE (event_id + {place}) % {period} WHEN {has} THEN '{source[0]}-{name}-' || CAST(event_id % {values} AS VARCHAR)"
            f"{other} END")


def _at(source: str, names, name: str, offset: int = 0) -> str:
    return field(source, offset + list(names).index(name), name)


def manual(name: str) -> str:
    return f"nullif({_at('manual', MANUAL_CAMPAIGN_FIELDS, name)}, {NS})"


def google(name: str) -> str:
    return f"nullif({_at('google', GOOGLE_ADS_CAMPAIGN_FIELDS, name)}, {NS})"


def collected(name: str) -> str:
    return _at("collected", CTS_FIELDS, name)


def event_param(name: str) -> str:
    return _at("param", PARAM_NAMES, name)


def first_of(*values: str) -> str:
    return f"coalesce({', '.join(values)})"


_URL = ("'https://shop.example.com/p?e=' || CAST(event_id AS VARCHAR) || " + " || ".join(
    f"coalesce('&{n}=' || {field('url', i, n)}, '')" for i, n in enumerate(URL_NAMES)) + " || '#end'")

#: Output column -> SQL over (event_id, page_url).
TRAFFIC = {
    "source": first_of(manual("source"), collected("manual_source"), up("utm_source"), event_param("source")),
    "medium": first_of(manual("medium"), collected("manual_medium"), up("utm_medium"), event_param("medium")),
    "campaign": first_of(google("campaign_name"), manual("campaign_name"), collected("manual_campaign_name"),
                         up("utm_campaign"), event_param("campaign")),
    "campaign_id": first_of(google("campaign_id"), manual("campaign_id"), collected("manual_campaign_id"),
                            up("campaign_id"), event_param("campaign_id")),
    "content": first_of(manual("content"), collected("manual_content"), up("utm_content"), event_param("content")),
    "term": first_of(manual("term"), collected("manual_term"), up("utm_term"), event_param("term")),
    "gclid": first_of(collected("gclid"), event_param("gclid"), up("gclid")),
    **{n: first_of(manual(n), collected(f"manual_{n}")) for n in ("creative_format", "marketing_tactic", "source_platform")},
    **{f"first_traffic_source_{'campaign' if n == 'name' else n}": field("record", i, n) for i, n in enumerate(TRAFFIC_FIELDS)},
}
_ADS, _CLICKS = "event_traffic_source_template_google_ads_", "event_traffic_source_click_ids_"
TEMPLATES = {
    f"{_ADS}google_ads_customer_id": first_of(google("customer_id"), up("g_acid")),
    f"{_ADS}google_ads_account_name": google("account_name"),
    f"{_ADS}google_ads_ad_group_id": google("ad_group_id"),
    f"{_ADS}google_ads_ad_group_name": first_of(google("ad_group_name"), up("utm_content")),
    **{f"{_ADS}{f}": up(p) for f, p in GOOGLE_ADS_URL_FIELDS},
    **{f"event_traffic_source_template_google_pmax_shopping_{f}": up(p) for f, p in PMAX_URL_FIELDS},
    **{f"event_traffic_source_template_google_hotel_{f}": up(p) for f, p in HOTEL_URL_FIELDS},
    f"{_CLICKS}dclid": first_of(collected("dclid"), up("dclid")),
    f"{_CLICKS}srsltid": first_of(collected("srsltid"), up("srsltid")),
    **{f"{_CLICKS}{p}": up(p) for p in CLICK_ID_URL_FIELDS},
}
_TAGGED = "br IN ('a', 'b')"
CHANNEL = {
    "campaign": f"CASE WHEN {_TAGGED} THEN coalesce(campaign, {NS}) ELSE {NS} END",
    "medium": f"CASE br WHEN 'a' THEN 'cpc' WHEN 'b' THEN coalesce(medium, {NS}) WHEN 'c' THEN 'referral' ELSE '(none)' END",
    "source": f"CASE br WHEN 'a' THEN 'google' WHEN 'b' THEN coalesce(source, {NS}) "
              f"WHEN 'c' THEN coalesce({part('hostname', 'p_referrer')}, {NS}) ELSE '(direct)' END",
    **{n: f"CASE WHEN {_TAGGED} THEN coalesce({n}, {NS}) ELSE {NS} END" for n in ("content", "term", "campaign_id")},
    "referrer": f"coalesce(p_referrer, {NS})",
    "gclid": "gclid",
}


def _columns(named: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in named.items())


_CTES = f"""
c0 AS (SELECT *, {_URL} AS page_url FROM rf),
c1 AS (SELECT event_id, event_name, ets, p_referrer, coalesce(p_ignore, 'false') AS ignored, {_columns({**TRAFFIC, **TEMPLATES})} FROM c0),
c2 AS (
  SELECT *, CASE WHEN coalesce(gclid, {_CLICKS}wbraid, {_CLICKS}gbraid) IS NOT NULL THEN 'a'
    WHEN coalesce(source, medium, campaign) IS NOT NULL AND NOT (medium = 'referral' AND ignored = 'true') THEN 'b'
    WHEN p_referrer IS NOT NULL AND NOT ignored = 'true' THEN 'c' ELSE 'd' END AS br
  FROM c1),
"""


def with_c(select: str) -> str:
    """A SELECT over the attributed rows ``c2`` (br: the channel's branch)."""
    from clickmarts.oracle import R_CTES
    return f"WITH {(R_CTES + _CTES).rstrip().rstrip(',')}\n{select}"


TRAFFIC_SQL = with_c(f"SELECT event_id AS event_bundle_sequence_id, {', '.join(TRAFFIC)} FROM c2")
TEMPLATES_SQL = with_c(f"SELECT event_id AS event_bundle_sequence_id, {', '.join(TEMPLATES)} FROM c2")
CHANNEL_SQL = with_c("SELECT event_id AS event_bundle_sequence_id, "
                     + ", ".join(f"{sql} AS event_traffic_source_{name}" for name, sql in CHANNEL.items()) + " FROM c2")

# -- flattened records (P11) ----------------------------------------------------------------
_DEVICE_NAMES = {"mobile_brand_name": "brand"}
_web = lambda n: _at("record", WEB_FIELDS, n, 2)
RECORDS = {
    **{f"device_{_DEVICE_NAMES.get(n, n)}": _at("record", DEVICE_FIELDS, n) for n in DEVICE_FIELDS if not n.startswith("browser")},
    **{f"device_{n}": first_of(_at("record", DEVICE_FIELDS, n), _web(n)) for n in ("browser", "browser_version")},
    "hostname": _web("hostname"),
    **{f"geo_{n}": _at("record", GEO_FIELDS, n, 1) for n in GEO_FIELDS},
    **{f"ecommerce_{n}": (field("record", i, n) if kind == "string" else
                          f"CASE WHEN (event_id + {i}) % 4 = 1 THEN " + ("(event_id % 100) / 4.0" if kind == "double" else "event_id % 7") + " END")
       for i, (n, kind) in enumerate(ECOMMERCE_FIELDS)},
    "app_info_id": field("record", 3, "app"),
    "event_previous_timestamp_utc": "CASE WHEN event_id % 3 = 0 THEN ets - 1000000 END",
}
RECORDS_SQL = with_r(f"SELECT event_id AS event_bundle_sequence_id, {_columns(RECORDS)} FROM rf")
