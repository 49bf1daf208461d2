"""Event-item rows for ecommerce events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmarts.config import ECOM_EVENTS, NOT_SET
from clickmarts.functions.keys import surrogate_key
from clickmarts.functions.timeparts import date_of

ITEM_DEFAULTED = (
    "item_id", "item_name", "item_brand", "item_variant", "item_category", "item_category2",
    "item_category3", "item_category4", "item_category5", "coupon", "affiliation",
    "location_id", "item_list_id", "item_list_name", "item_list_index", "promotion_id",
    "promotion_name", "creative_name", "creative_slot",
)
ITEM_MEASURES = ("item_revenue_in_usd", "quantity", "price_in_usd", "price")
EVENT_ECOMMERCE = (
    "ecommerce_total_item_quantity", "ecommerce_purchase_revenue_in_usd",
    "ecommerce_purchase_revenue", "ecommerce_refund_value_in_usd", "ecommerce_refund_value",
    "ecommerce_shipping_value_in_usd", "ecommerce_shipping_value", "ecommerce_tax_value_in_usd",
    "ecommerce_tax_value", "ecommerce_unique_items", "ecommerce_transaction_id",
)
PRODUCT_COLUMNS = (
    ("event_specific_item_id", "event_specific_variant_id", "event_id", "event_timestamp_utc",
     "event_date_utc", "event_name", "session_id", "user_id", "user_pseudo_id")
    + EVENT_ECOMMERCE + ("date_tz",) + ITEM_DEFAULTED + ITEM_MEASURES)


def filter_ecommerce(events: DataFrame) -> DataFrame:
    """Keep the 14 ecommerce event names (P15); pushed to the scan as an IN filter."""
    return events.where(F.col("event_name").isin(*ECOM_EVENTS))


def explode_items(events: DataFrame) -> DataFrame:
    """Inner unnest of ``items`` (J6): events with an empty or NULL array vanish."""
    return events.select("*", F.explode("items").alias("i")).drop("items")


def item_rows(exploded: DataFrame, not_set: str = NOT_SET) -> DataFrame:
    """The 42 event-item columns with the slug for missing item dimensions."""
    ns = F.lit(not_set)
    return exploded.select(
        F.col("id").alias("event_id"), "event_timestamp_utc",
        date_of(F.col("event_timestamp_utc")).alias("event_date_utc"),
        "event_name", "session_id", "user_id", "user_pseudo_id", *EVENT_ECOMMERCE, "date_tz",
        *[F.coalesce(F.col(f"i.{f}"), ns).alias(f) for f in ITEM_DEFAULTED],
        *[F.col(f"i.{f}").alias(f) for f in ITEM_MEASURES],
    )


def distinct_items(rows: DataFrame) -> DataFrame:
    """Group by all 42 columns = DISTINCT (A3); partial aggregation before the shuffle."""
    return rows.distinct()


def by_day_and_event(events: DataFrame) -> DataFrame:
    """Events dealt in ranges of days, and of event ids within large days: the one exchange of a
    products mart written by day.  Equal rows are of one day and event id, and events cross
    instead of rows that repeat an event's columns per item and have two more keys each."""
    return events.repartitionByRange("date_tz", "id")


def products_mart(events: DataFrame, not_set: str = NOT_SET) -> DataFrame:
    """Event-item grain for ecommerce events with two surrogate ids (M2)."""
    rows = distinct_items(item_rows(explode_items(filter_ecommerce(events)), not_set))
    return rows.select(
        surrogate_key("event_id", "item_id", "item_name").alias("event_specific_item_id"),
        surrogate_key("event_id", "item_id", "item_name", "item_variant").alias("event_specific_variant_id"),
        *PRODUCT_COLUMNS[2:])
