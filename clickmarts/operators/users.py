"""User rollup with first-touch attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmarts.operators.sessions import ATTRIBUTED_SUFFIXES

FIRST_FIELDS = tuple(f"first_{a}" for a in ATTRIBUTED_SUFFIXES) + ("first_session_start_at_utc",)
USER_METRICS = ("first_session_at_utc", "last_session_at_utc", "sessions", "page_views",
                "total_session_duration", "total_engaged_seconds", "total_events")
USER_COLUMNS = ("id",) + FIRST_FIELDS + USER_METRICS
# Metrics the reference's fan-out join multiplies by the user's session count.
FANOUT_SUMS = (("page_views", "page_views"), ("total_session_duration", "duration_seconds"),
               ("total_engaged_seconds", "engaged_seconds"), ("total_events", "event_count"))


def _first_touch_source(a: str) -> str:
    # first_landing_page* read the session's own landing page; the rest read
    # the session's last-touch values.
    return a if a in ("landing_page", "landing_page_query") else f"last_{a}"


def first_touch_record():
    """Struct of the first-touch values taken from the user's earliest session."""
    fields = [F.col(_first_touch_source(a)).alias(f"first_{a}") for a in ATTRIBUTED_SUFFIXES
              if a != "source_medium"]
    return F.struct(*fields, F.col("session_start_at_utc").alias("first_session_start_at_utc"))


def users_rollup(sessions: DataFrame, fanout: str = "dedup", unique_sessions: bool = True) -> DataFrame:
    """One row per ``user_pseudo_id`` (M5).

    First touch = the user's earliest session by start time (session id breaks
    ties), computed as ``min_by`` in the same aggregate as the metrics: one
    exchange of session rows by user with map-side partial aggregation, no
    window and no join.

    The sessions mart has one row per session, so its sessions are counted, which merges;
    for a table in which a session may stand repeatedly, ``unique_sessions=False`` counts
    them distinct, as the reference does, at the price of a second exchange.

    ``fanout="reference"`` reproduces the reference's join of one
    first-touch row per session back onto the sessions: each of a user's n
    session rows meets n identical first-touch rows, so the sums come out
    n times larger (count distinct, min and max unaffected).  Computed here as
    sum x n instead of materialising the n^2 pairs.
    """
    if fanout not in ("dedup", "reference"):
        raise ValueError("fanout must be 'dedup' or 'reference'")
    first = F.min_by(first_touch_record(), F.struct("session_start_at_utc", "id"))
    sums = [F.sum(src).alias(out) for out, src in FANOUT_SUMS]
    agg = sessions.groupBy("user_pseudo_id").agg(
        first.alias("_first"),
        F.min("session_start_at_utc").alias("first_session_at_utc"),
        F.max("session_start_at_utc").alias("last_session_at_utc"),
        (F.count("id") if unique_sessions else F.count_distinct("id")).alias("sessions"),
        *sums,
        F.count(F.lit(1)).alias("_rows"),
    )
    first_cols = []
    for a in ATTRIBUTED_SUFFIXES:
        if a == "source_medium":
            first_cols.append(F.concat(F.col("_first.first_source"), F.lit(" / "),
                                       F.col("_first.first_medium")).alias("first_source_medium"))
        else:
            first_cols.append(F.col(f"_first.first_{a}").alias(f"first_{a}"))
    first_cols.append(F.col("_first.first_session_start_at_utc").alias("first_session_start_at_utc"))
    metrics = [F.col("first_session_at_utc"), F.col("last_session_at_utc"), F.col("sessions")]
    for out, _ in FANOUT_SUMS:
        m = F.col(out) * F.col("_rows") if fanout == "reference" else F.col(out)
        metrics.append(m.alias(out))
    return agg.select(F.col("user_pseudo_id").alias("id"), *first_cols, *metrics)
