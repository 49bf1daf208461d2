"""Long-form event parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmarts.config import NOT_SET
from clickmarts.functions.params import value_as_string

EVENT_PARAM_COLUMNS = (
    "id", "event_id", "event_timestamp_utc", "session_id", "event_name", "user_pseudo_id",
    "page_url", "key", "event_parameter_name", "string_value", "int_value", "float_value",
    "double_value", "event_parameter_value", "date_tz",
)


def explode_params(events: DataFrame) -> DataFrame:
    """Inner unnest of ``event_params`` (J5): events without parameters vanish.

    A ``date_tz`` filter on the result still reaches the scan (it is pushed
    below the generator).
    """
    return events.select(
        F.col("id").alias("event_id"), "event_timestamp_utc", "session_id", "event_name",
        "user_pseudo_id", "page_url", "date_tz", F.explode("event_params").alias("p"))


def event_params_mart(events: DataFrame, not_set: str = NOT_SET) -> DataFrame:
    """One row per (event, parameter) (M3, a view in the reference)."""
    p = F.col("p")
    return explode_params(events).select(
        F.concat(F.col("event_id"), p["key"]).alias("id"),
        "event_id", "event_timestamp_utc", "session_id", "event_name", "user_pseudo_id",
        "page_url", p["key"].alias("key"), p["key"].alias("event_parameter_name"),
        p["value"]["string_value"].alias("string_value"),
        p["value"]["int_value"].alias("int_value"),
        p["value"]["float_value"].alias("float_value"),
        p["value"]["double_value"].alias("double_value"),
        value_as_string(p["value"], not_set).alias("event_parameter_value"),
        "date_tz",
    )
