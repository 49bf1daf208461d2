"""Configuration and fixed vocabulary shared by all marts."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Optional

from pyspark.sql import Column

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference model's for identical output.
# ---------------------------------------------------------------------------

NOT_SET = "(not set)"
SESSION_LENGTH_SECONDS = 1800
INCREMENTAL_REFRESH_DAYS = 3
LAST_NON_DIRECT_LOOKBACK_DAYS = 90
PREVIEW_DEFAULT_DAYS = 7

# Ecommerce event names kept by the products mart, in the reference's order.
ECOM_EVENTS = (
    "add_payment_info",
    "add_shipping_info",
    "add_to_cart",
    "add_to_wishlist",
    "begin_checkout",
    "purchase",
    "refund",
    "remove_from_cart",
    "select_item",
    "select_promotion",
    "view_cart",
    "view_item",
    "view_item_list",
    "view_promotion",
)

# Events excluded from the in-session event sequence.
SEQUENCE_EXCLUDED_EVENTS = ("session_start", "first_visit")

# Tie-break priority of traffic media when two candidate rows share a timestamp:
# anything else (3) beats referral (2) beats (none) (1).
MEDIUM_PRIORITY_NONE = "(none)"
MEDIUM_PRIORITY_REFERRAL = "referral"

DIRECT_SOURCE = "(direct)"


@dataclass(frozen=True)
class MartConfig:
    """Knobs of the mart build (the reference's project variables).

    ``id_scope`` chooses how the per-user event rank behind ``events.id`` is
    computed: ``"scan"`` ranks over everything scanned (reference behaviour,
    ids depend on the scanned day range); ``"instant"`` ranks only inside
    (user, timestamp) so an id does not change when other days are re-read.
    """

    not_set: str = NOT_SET
    session_length_seconds: int = SESSION_LENGTH_SECONDS
    incremental_refresh_days: int = INCREMENTAL_REFRESH_DAYS
    last_non_direct_lookback: Optional[int] = LAST_NON_DIRECT_LOOKBACK_DAYS
    dag_max_days: Optional[int] = None
    preview_days: Optional[int] = None
    id_scope: str = "scan"
    clean_path: Optional[Callable[[Column], Column]] = None
    # Window layout: "user" partitions the event windows by user (one
    # exchange, fastest on evenly spread data); "sliced" partitions them by
    # (user, time slice) and corrects from per-slice summaries, so a hot user
    # or session is spread over many tasks (its inputs are written once to
    # the checkpoint folder, a second pass over them is needed).  "auto"
    # counts rows per user first (a narrow aggregate); users holding more than
    # ``skew_threshold_rows`` go through the sliced windows, all others
    # through the per-user ones, and the results are unioned.  Same results.
    # Where the sessions' distinct event count is made: "fused" with the other metrics
    # (events computed in the same job), "narrow" in a branch of its own (events read from
    # a written table).  Same results.
    rollup: str = "fused"
    # Whether equal anonymous events are numbered into users of their own (see
    # ``operators.events.fill_user_id``).
    number_anonymous: bool = False
    # Malformed engagement milliseconds fail the build (the reference's hard cast) or are NULL.
    strict_engagement: bool = True
    # Drop intraday rows of days that also have a daily shard (the reference
    # keeps both, doubling such days).
    prefer_daily: bool = False
    window_layout: str = "auto"
    skew_threshold_rows: int = 10_000_000
    slice_seconds: int = 3600
    session_slice_seconds: int = 86400
