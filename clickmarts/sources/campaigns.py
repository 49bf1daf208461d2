"""Exports with every traffic source filled (C): the R fixture under campaign rules.

R leaves most traffic, device and commerce fields NULL.  Here each of them has a value, the
slug, or NULL by a rule over the event number and the field's place in its list, with
different periods for each source, so that every order of precedence occurs.  The rules are
plain numbers (:data:`RULES`) that the oracle reads as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmarts.config import NOT_SET
from clickmarts.operators.attribution import CLICK_ID_URL_FIELDS, GOOGLE_ADS_URL_FIELDS, HOTEL_URL_FIELDS, PMAX_URL_FIELDS
from clickmarts.sources.fixtures import (CTS_FIELDS, DEVICE_FIELDS, ECOMMERCE_FIELDS, GOOGLE_ADS_CAMPAIGN_FIELDS,
                                         MANUAL_CAMPAIGN_FIELDS, _kv, raw_events)

#: source -> (period, remainder with a value, remainder with the slug or None, period of the value).
RULES = {
    "manual": (7, 1, 0, 13),
    "google": (11, 1, 0, 5),
    "collected": (5, 2, None, 17),
    "url": (6, 3, None, 19),
    "param": (4, 1, None, 23),
    "record": (4, 1, None, 29),
}
URL_NAMES = (("utm_source", "utm_medium", "utm_campaign", "campaign_id", "utm_content", "utm_term", "gclid", "g_acid",
              "dclid", "srsltid") + tuple(p for _, p in GOOGLE_ADS_URL_FIELDS + PMAX_URL_FIELDS + HOTEL_URL_FIELDS)
             + CLICK_ID_URL_FIELDS)
PARAM_NAMES = ("source", "medium", "campaign", "campaign_id", "content", "term", "gclid")
GEO_FIELDS = ("continent", "country", "region", "city", "metro", "sub_continent")
WEB_FIELDS = ("browser", "browser_version", "hostname")
TRAFFIC_FIELDS = ("source", "medium", "name")


def _text(source: str, place: int, name: str) -> Column:
    """The value of field ``place`` of a source: text, the slug, or NULL."""
    period, has, slug, values = RULES[source]
    eid = F.col("event_bundle_sequence_id")
    at = (eid + F.lit(place)) % F.lit(period)
    out = F.when(at == has, F.concat(F.lit(f"{source[0]}-{name}-"), (eid % values).cast("string")))
    return out if slug is None else out.when(at == slug, F.lit(NOT_SET))


def _record(source: str, names, offset: int = 0) -> list[Column]:
    return [_text(source, offset + i, n).alias(n) for i, n in enumerate(names)]


def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C: one row per ``events`` row, with the R fixture's ids, times and users."""
    raw = raw_events(spark, sf_dir)
    eid = F.col("event_bundle_sequence_id")
    url = F.concat(F.lit("https://shop.example.com/p?e="), eid.cast("string"), *[
        F.coalesce(F.concat(F.lit(f"&{n}="), _text("url", i, n)), F.lit("")) for i, n in enumerate(URL_NAMES)], F.lit("#end"))
    params = F.filter(F.array(_kv("page_location", string_value=url), *[
        _kv(n, string_value=value, present=value.isNotNull()) for i, n in enumerate(PARAM_NAMES)
        for value in [_text("param", i, n)]]), lambda p: p.isNotNull())
    kept = F.filter("event_params", lambda p: p["key"] != "page_location")
    amount = lambda i, kind: F.when((eid + i) % 4 == 1, (eid % 100) / F.lit(4.0) if kind == "double" else eid % 7)
    ecommerce = [(_text("record", i, n) if kind == "string" else amount(i, kind)).cast(kind).alias(n)
                 for i, (n, kind) in enumerate(ECOMMERCE_FIELDS)]
    return raw.withColumns({
        "event_params": F.concat(params, kept),
        "session_traffic_source_last_click": F.struct(
            F.struct(*_record("manual", MANUAL_CAMPAIGN_FIELDS)).alias("manual_campaign"),
            F.struct(*_record("google", GOOGLE_ADS_CAMPAIGN_FIELDS)).alias("google_ads_campaign")),
        "collected_traffic_source": F.struct(*_record("collected", CTS_FIELDS)),
        "traffic_source": F.struct(*_record("record", TRAFFIC_FIELDS)),
        "device": F.struct(*_record("record", DEVICE_FIELDS), F.struct(*_record("record", WEB_FIELDS, 2)).alias("web_info")),
        "geo": F.struct(*_record("record", GEO_FIELDS, 1)),
        "app_info": F.struct(_text("record", 3, "app").alias("id")),
        "ecommerce": F.struct(*ecommerce),
        "event_previous_timestamp": F.when(eid % 3 == 0, F.col("event_timestamp") - F.lit(1_000_000)),
    })
