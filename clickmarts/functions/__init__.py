"""Column-returning helpers (the reference's macros and scalar expressions)."""

from clickmarts.functions.keys import surrogate_key
from clickmarts.functions.params import param, param_numeric, value_as_string
from clickmarts.functions.urls import (
    clean_page_path,
    decode_common_escapes,
    hostname,
    trailing_slash,
    url_param,
    url_part,
)
from clickmarts.functions.timeparts import (
    date_from_micros,
    duration_seconds,
    engagement_seconds,
    hour_from_micros,
)

__all__ = [
    "surrogate_key", "param", "param_numeric", "value_as_string", "clean_page_path",
    "decode_common_escapes", "hostname", "trailing_slash", "url_param", "url_part",
    "date_from_micros", "duration_seconds", "engagement_seconds", "hour_from_micros",
]
