"""The marts in plain SQL: functions F1-F8 and the marts as views of a session.

``register`` puts the lookups and URL helpers into the session as SQL functions, events and
sessions as views, and builds the other marts on them as views in SQL.  A view computes
nothing until it is queried, and filters on it reach the tables below.
"""

from __future__ import annotations

from typing import Iterable, Optional

from pyspark.sql import DataFrame, SparkSession

from clickmarts.config import ECOM_EVENTS, NOT_SET
from clickmarts.functions.urls import COMMON_ESCAPES, URL_PART_PATTERNS, _NON_EMPTY_PARTS
from clickmarts.operators.products import EVENT_ECOMMERCE, ITEM_DEFAULTED, ITEM_MEASURES
from clickmarts.operators.sessions import ATTRIBUTED_SUFFIXES

PARAMS = "ARRAY<STRUCT<key: STRING, value: STRUCT<string_value: STRING, int_value: BIGINT, float_value: DOUBLE, double_value: DOUBLE>>>"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _entry(slot: str) -> str:
    return f"get(params, array_position(transform(params, p -> p.key), name) - 1).value.{slot}"


def _url_part(part: str) -> str:
    pattern = _quoted(URL_PART_PATTERNS[part])
    value = f"regexp_extract(url, {pattern}, 1)"
    return f"CASE WHEN url RLIKE {pattern} THEN {f'nullif({value}, {_quoted(str())})' if part in _NON_EMPTY_PARTS else value} END"


def _decoded() -> str:
    out = "text"
    for escape, char in COMMON_ESCAPES:
        out = f"replace({out}, {_quoted(escape)}, {_quoted(char)})"
    return out


#: Name -> (parameters, result, body).
FUNCTIONS = {
    "param_string": (f"params {PARAMS}, name STRING", "STRING", _entry("string_value")),
    "param_int": (f"params {PARAMS}, name STRING", "BIGINT", _entry("int_value")),
    "param_double": (f"params {PARAMS}, name STRING", "DOUBLE", _entry("double_value")),
    "param_numeric": (f"params {PARAMS}, name STRING", "DOUBLE",
                      f"coalesce({_entry('float_value')}, CAST({_entry('int_value')} AS DOUBLE))"),
    "url_param": ("url STRING, name STRING", "STRING",
                  "CASE WHEN contains(url, name || '=') THEN substr(regexp_substr(url, name || '=[^&#]+'), length(name) + 2) END"),
    **{f"url_{p}": ("url STRING", "STRING", _url_part(p)) for p in URL_PART_PATTERNS},
    "trailing_slash": ("path STRING", "STRING",
                       "CASE WHEN path IS NULL THEN '/' WHEN right(path, 1) = '/' THEN path ELSE path || '/' END"),
    "decode_common_escapes": ("text STRING", "STRING", _decoded()),
    "surrogate_key": ("parts ARRAY<STRING>", "STRING",
                      "md5(array_join(transform(parts, p -> coalesce(p, '_null_')), '-'))"),
}


def register_functions(spark: SparkSession, prefix: str = "ga_", only: Optional[Iterable[str]] = None) -> list[str]:
    """Create the functions for this session; their full names."""
    made = []
    for name in only or FUNCTIONS:
        params, result, body = FUNCTIONS[name]
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params}) RETURNS {result} RETURN {body}")
        made.append(f"{prefix}{name}")
    return made


def event_params_sql(events: str, prefix: str = "ga_") -> str:
    """M3 as SQL over an events view."""
    return f"""
        SELECT concat(id, p.key) AS id, id AS event_id, event_timestamp_utc, session_id, event_name, user_pseudo_id, page_url,
               p.key AS key, p.key AS event_parameter_name, p.value.string_value AS string_value, p.value.int_value AS int_value,
               p.value.float_value AS float_value, p.value.double_value AS double_value,
               coalesce(p.value.string_value, CAST(p.value.int_value AS STRING), CAST(p.value.float_value AS STRING),
                        CAST(p.value.double_value AS STRING), {_quoted(NOT_SET)}) AS event_parameter_value, date_tz
        FROM {events} LATERAL VIEW explode(event_params) AS p"""


def users_sql(sessions: str) -> str:
    """M5 as SQL over a sessions view; first touch by ``min_by``, as in the rollup."""
    first = []
    for a in ATTRIBUTED_SUFFIXES:
        kept = a in ("landing_page", "landing_page_query")
        value = ("concat(first.last_source, ' / ', first.last_medium)" if a == "source_medium"
                 else f"first.{a}" if kept else f"first.last_{a}")
        first.append(f"{value} AS first_{a}")
    record = ["session_start_at_utc"] + [a if a in ("landing_page", "landing_page_query") else f"last_{a}"
                                         for a in ATTRIBUTED_SUFFIXES if a != "source_medium"]
    return f"""
        SELECT id, {', '.join(first)}, first.session_start_at_utc AS first_session_start_at_utc, first_session_at_utc,
               last_session_at_utc, sessions, page_views, total_session_duration, total_engaged_seconds, total_events
        FROM (SELECT user_pseudo_id AS id, min_by(struct({', '.join(record)}), struct(session_start_at_utc, id)) AS first,
                     min(session_start_at_utc) AS first_session_at_utc, max(session_start_at_utc) AS last_session_at_utc,
                     count(id) AS sessions, sum(page_views) AS page_views, sum(duration_seconds) AS total_session_duration,
                     sum(engaged_seconds) AS total_engaged_seconds, sum(event_count) AS total_events
              FROM {sessions} GROUP BY user_pseudo_id)"""


def products_sql(events: str, prefix: str = "ga_") -> str:
    """M2 as SQL over an events view."""
    names = ", ".join(map(_quoted, ECOM_EVENTS))
    items = ", ".join(f"coalesce(i.{f}, {_quoted(NOT_SET)}) AS {f}" for f in ITEM_DEFAULTED)
    return f"""
        SELECT {prefix}surrogate_key(array(event_id, item_id, item_name)) AS event_specific_item_id,
               {prefix}surrogate_key(array(event_id, item_id, item_name, item_variant)) AS event_specific_variant_id, *
        FROM (SELECT DISTINCT id AS event_id, event_timestamp_utc, to_date(event_timestamp_utc) AS event_date_utc, event_name,
                     session_id, user_id, user_pseudo_id, {', '.join(EVENT_ECOMMERCE)}, date_tz, {items},
                     {', '.join(f'i.{f}' for f in ITEM_MEASURES)}
              FROM {events} LATERAL VIEW explode(items) AS i WHERE event_name IN ({names}))"""


def register(spark: SparkSession, events: DataFrame, sessions: Optional[DataFrame] = None, prefix: str = "ga_") -> list[str]:
    """Functions, and views ``<prefix>events``, ``<prefix>event_params``, ``<prefix>products`` and,
    given sessions, ``<prefix>sessions`` and ``<prefix>users``; the views' names."""
    register_functions(spark, prefix)
    views = {"events": events, "event_params": event_params_sql(f"{prefix}events", prefix), "products": products_sql(f"{prefix}events", prefix)}
    if sessions is not None:
        views |= {"sessions": sessions, "users": users_sql(f"{prefix}sessions")}
    for name, view in views.items():
        (view if isinstance(view, DataFrame) else spark.sql(view)).createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in views]
