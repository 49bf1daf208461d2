"""Session-level steps.

Physical plan of the sessions mart: events are reduced by ONE aggregate that
fuses what the reference computes in four CTEs and joins back together (first
session_start row, first event, engagement metrics, page views).
Top-1-per-group is expressed as ``min_by`` over a sort key, i.e. a mergeable
aggregate.  The distinct event count is the one metric that does not merge.
In the job that computes the events they already lie by user, and the count
stays in the same aggregate (``rollup="fused"``: no exchange at all).  From a
written table it has a narrow branch of its own (``rollup="narrow"``): the wide
records are then really reduced before their one exchange, a hot session to
one row a task, and only (user, session, event) keys are shuffled apart.
An exchange of session rows (not events) by user serves the last-non-direct
window, which also carries the candidate session's values so that no self
join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmarts.config import (DIRECT_SOURCE, MEDIUM_PRIORITY_NONE, MEDIUM_PRIORITY_REFERRAL,
                               NOT_SET)
from clickmarts.functions.params import param, param_entry, param_keys
from clickmarts.functions.timeparts import date_of, days_between, duration_seconds
from clickmarts.operators.attribution import CLICK_ID_FIELDS, GOOGLE_ADS_FIELDS, PMAX_FIELDS

# Session dimensions defaulted to the slug (P12): (output, events-mart column).
DEFAULTED_DIMENSIONS = (
    ("landing_page_referrer", "page_referrer"),
    ("landing_page_hostname", "page_hostname"),
    ("landing_page", "page_path"),
    ("landing_page_query", "page_query"),
    ("device_category", "device_category"),
    ("device_brand", "device_brand"),
    ("device_os", "device_operating_system"),
    ("device_os_version", "device_operating_system_version"),
    ("device_browser", "device_browser"),
    ("device_browser_version", "device_browser_version"),
    ("geo_continent", "geo_continent"),
    ("geo_sub_continent", "geo_sub_continent"),
    ("geo_country", "geo_country"),
    ("geo_region", "geo_region"),
    ("geo_city", "geo_city"),
    ("geo_metro", "geo_metro"),
)
# Columns kept from the chosen session_start row, in output order.
SESSION_KEPT = (
    "id", "session_start_at_utc", "date_tz", "session_start_on_utc", "user_pseudo_id",
    "business_unit", "landing_page_referrer", "landing_page_hostname", "landing_page",
    "landing_page_query", "device_category", "device_brand", "device_os", "device_os_version",
    "device_browser", "device_browser_version", "geo_continent", "geo_sub_continent",
    "geo_country", "geo_region", "geo_city", "geo_metro", "session_number", "user_type",
)
# The 46 attributed values, as (suffix, source struct, field or None for landing columns).
ATTRIBUTED = (
    [("landing_page", None, "landing_page"), ("landing_page_query", None, "landing_page_query")]
    + [(f, "event_traffic_source", f) for f in ("source", "medium")]
    + [("source_medium", "event_traffic_source", None)]
    + [(f, "event_traffic_source", f) for f in ("campaign", "content", "term", "campaign_id",
                                                "referrer", "gclid")]
    + [(f, "event_traffic_source_template_google_ads", f) for f in GOOGLE_ADS_FIELDS]
    + [(f, "event_traffic_source_template_google_pmax_shopping", f) for f in PMAX_FIELDS]
    + [(f, "event_traffic_source_click_ids", f) for f in CLICK_ID_FIELDS]
)
ATTRIBUTED_SUFFIXES = tuple(a for a, _, _ in ATTRIBUTED)
METRIC_COLUMNS = ("session_end_at_utc", "duration_seconds", "is_engaged", "is_bounce",
                  "engaged_seconds", "page_views", "event_count")
SESSION_COLUMNS = (SESSION_KEPT + tuple(f"last_{a}" for a in ATTRIBUTED_SUFFIXES)
                   + tuple(f"last_non_direct_{a}" for a in ATTRIBUTED_SUFFIXES) + METRIC_COLUMNS)

_STRUCTS = ("event_traffic_source", "event_traffic_source_click_ids",
            "event_traffic_source_template_google_ads",
            "event_traffic_source_template_google_pmax_shopping")


def default_dimensions(events: DataFrame, not_set: str = NOT_SET) -> DataFrame:
    """Session inputs with missing dimensions replaced by the slug."""
    ns = F.lit(not_set)
    return events.select(
        "id", "session_id", "ga_session_id", "event_timestamp_utc", "event_name", "date_tz",
        "user_pseudo_id", "business_unit", *_STRUCTS, "referrer", "event_params",
        *[F.coalesce(F.col(src), ns).alias(out) for out, src in DEFAULTED_DIMENSIONS],
        F.col("ga_session_number").alias("session_number"),
        F.when(F.col("ga_session_number") == 1, F.lit("New")).otherwise(F.lit("Returning"))
        .alias("user_type"),
    )


def medium_priority(ts: Column) -> Column:
    """other (3) > referral (2) > (none) (1); a NULL medium counts as other."""
    m = ts["medium"]
    return (F.when(m == F.lit(MEDIUM_PRIORITY_NONE), F.lit(1))
            .when(m == F.lit(MEDIUM_PRIORITY_REFERRAL), F.lit(2)).otherwise(F.lit(3)))


def first_row_key(ts_col: str = "event_timestamp_utc", id_col: str = "id") -> Column:
    """Sort key of W5/W6: earliest time, then highest medium priority, then id."""
    return F.struct(F.col(ts_col), -medium_priority(F.col("event_traffic_source")), F.col(id_col))


def _start_record() -> Column:
    return F.struct(
        F.col("event_timestamp_utc").alias("session_start_at_utc"),
        "date_tz", "user_pseudo_id", "business_unit",
        *[out for out, _ in DEFAULTED_DIMENSIONS], "session_number", "user_type", *_STRUCTS)


def _attribution_record() -> Column:
    return F.struct(F.col("event_timestamp_utc").alias("session_start_at_utc"),
                    "landing_page", "landing_page_query", *_STRUCTS)


def engaged_flag(params: Column, keys=None) -> Column:
    """Per event: greatest(safe-cast text slot, int slot) of session_engaged; NULL if absent."""
    hit = param_entry(params, "session_engaged", keys)
    flag = F.greatest(F.coalesce(hit["value"]["string_value"].try_cast("long"), F.lit(0)),
                      F.coalesce(hit["value"]["int_value"], F.lit(0)))
    return F.when(hit.isNotNull(), flag)


def event_composite(keys=None) -> Column:
    """What ``event_count`` counts distinct (A4); NULL if a part is."""
    return F.concat(F.col("id"), F.col("user_pseudo_id"),
                    param(F.col("event_params"), "ga_session_id", "int_value", keys).cast("string"))


def distinct_event_counts(events: DataFrame) -> DataFrame:
    """(user_pseudo_id, session_id, event_count) of sessions with a counted event.  Distinct keys
    are dealt by the whole key, so those of a hot session spread over tasks."""
    keys = events.select("user_pseudo_id", "session_id", event_composite().alias("composite"))
    return (keys.where("composite is not null").groupBy("user_pseudo_id", "session_id")
            .agg(F.count_distinct("composite").alias("event_count")))


def session_rollup(events: DataFrame, rollup: str = "fused") -> DataFrame:
    """One row per session with everything the mart needs from its events.

    ``start``: first session_start row (W5), NULL when the session has none;
    ``attr``: first event of any kind (W6); engagement metrics (A1, A4);
    page views (A2, NULL rather than 0 when there are none).  ``rollup`` says
    where the distinct count is made; the result is the same.
    """
    if rollup not in ("fused", "narrow"):
        raise ValueError("rollup must be 'fused' or 'narrow'")
    given = events
    grouped = ["user_pseudo_id", "session_id"]
    is_start = F.col("event_name") == F.lit("session_start")
    key = first_row_key()
    ep = F.col("event_params")
    # Sorts carry what is read of the parameters, not the parameters.
    keys = F.col("_param_keys")
    events = events.withColumn("_param_keys", param_keys(ep)).withColumns({
        "_engaged": engaged_flag(ep, keys), "_msec": param(ep, "engagement_time_msec", "int_value", keys),
        "_composite": event_composite(keys)}).drop("_param_keys", "event_params")
    if rollup == "fused":
        # The first row of each composite counts: one sort for it and for the groups.
        first = F.row_number().over(Window.partitionBy(*grouped, "_composite").orderBy("_composite")) == F.lit(1)
        events = events.withColumn("_counted", first & F.col("_composite").isNotNull())
    # The session id is derived from the user, so grouping by (user, session)
    # forms the same groups; it lets the aggregate (and the per-user window
    # after it) reuse an existing partitioning by user instead of a new
    # exchange by session.
    rolled = events.groupBy(*grouped).agg(
        F.min_by(_start_record(), F.when(is_start, key)).alias("start"),
        F.min_by(_attribution_record(), key).alias("attr"),
        F.max("_engaged").alias("is_engaged"),
        (F.sum("_msec") / F.lit(1000)).alias("engaged_seconds"),
        *([F.count_if("_counted").alias("event_count")] if rollup == "fused" else []),
        F.max("event_timestamp_utc").alias("session_end_at_utc"),
        F.nullif(F.count_if(F.col("event_name") == F.lit("page_view")), F.lit(0)).alias("page_views"),
    )
    if rollup == "fused":
        return rolled
    # Both sides are one row per session, dealt by the same keys.
    counts = distinct_event_counts(given)
    same = rolled["session_id"].eqNullSafe(counts["session_id"]) & (rolled["user_pseudo_id"] == counts["user_pseudo_id"])
    return rolled.join(counts, same, "left").select(
        *[rolled[c] for c in rolled.columns], F.coalesce(counts["event_count"], F.lit(0)).alias("event_count"))


def last_non_direct(sessions: DataFrame, layout: str = "auto",
                    slice_seconds: int = 86400, threshold: int = 10_000_000, bound=None) -> DataFrame:
    """Candidate last-non-direct session per session (W7) with its start row.

    Over the user's sessions ordered by first-event time, the latest session
    (up to and including this one) whose first event is not '(direct)'; if
    none, the session itself.  The window carries the candidate's
    ``start`` record, so the reference's join back to sessions by id is not
    needed.  ``bound`` is a known maximum of sessions per user.  A candidate without a session_start row yields NULL.
    """
    direct = F.col("attr.event_traffic_source.source") == F.lit(DIRECT_SOURCE)
    own = F.struct(F.col("session_id").alias("id"), F.col("start").alias("start"))
    candidate = F.when(direct, F.lit(None)).otherwise(own)
    from clickmarts.operators import sliced

    def per_user(df: DataFrame) -> DataFrame:
        w = (Window.partitionBy("user_pseudo_id")
             .orderBy(F.col("attr.session_start_at_utc"), F.col("session_id"))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.withColumn("lnd", F.coalesce(F.last(candidate, ignorenulls=True).over(w), own))

    def sliced_(df: DataFrame) -> DataFrame:
        return sliced.last_non_direct(df, candidate, own, slice_seconds)

    # Written where it is read more than once: for the sliced passes, or to be counted and split.
    if layout == "sliced" or layout == "auto" and (bound is None or bound > threshold):
        sessions = sliced.materialize(sessions, "session-rollup")
    chosen, _, hot = sliced.plan_layout(sessions, layout, "user_pseudo_id", threshold,
                                        bound=bound)
    if chosen == "split":
        normal, hot_rows = sliced.split_by_keys(sessions, hot, "user_pseudo_id")
        return per_user(normal).unionByName(sliced_(hot_rows))
    return sliced_(sessions) if chosen == "sliced" else per_user(sessions)


def _attributed(prefix: str, rec: Column) -> list:
    out = []
    for suffix, struct, field in ATTRIBUTED:
        if struct is None:
            value = rec[field]
        elif field is None:
            value = F.concat(rec[struct]["source"], F.lit(" / "), rec[struct]["medium"])
        else:
            value = rec[struct][field]
        out.append(value.alias(f"{prefix}{suffix}"))
    return out


def assemble_sessions(rolled: DataFrame, lookback_days=90) -> DataFrame:
    """Final session columns (J2, J3, F11) from :func:`last_non_direct` output.

    The last-non-direct session is used when it has a session_start row and
    started at most ``lookback_days`` whole days before this session;
    otherwise the session's own values.
    """
    s, lnd = F.col("start"), F.col("lnd.start")
    use_lnd = lnd.isNotNull()
    if lookback_days is not None:
        use_lnd = use_lnd & (days_between(lnd["session_start_at_utc"], s["session_start_at_utc"])
                             <= F.lit(lookback_days))
    chosen = F.when(use_lnd, lnd).otherwise(s)
    # id and user_pseudo_id are the grouping keys themselves (equal to the
    # start row's values), so the output keeps the known partitioning by user
    # and a users rollup in the same job needs no further exchange.
    kept = [
        F.col("session_id").alias("id"),
        s["session_start_at_utc"].alias("session_start_at_utc"),
        s["date_tz"].alias("date_tz"),
        date_of(s["session_start_at_utc"]).alias("session_start_on_utc"),
        F.col("user_pseudo_id"),
    ] + [s[c].alias(c) for c in SESSION_KEPT[5:]]
    last = ([s["landing_page"].alias("last_landing_page"),
             s["landing_page_query"].alias("last_landing_page_query")]
            + _attributed("last_", F.col("attr"))[2:])
    metrics = [
        F.col("session_end_at_utc"),
        duration_seconds(s["session_start_at_utc"], F.col("session_end_at_utc")).alias("duration_seconds"),
        F.col("is_engaged"),
        (F.lit(1) - F.col("is_engaged")).alias("is_bounce"),
        F.col("engaged_seconds"),
        F.col("page_views"),
        F.col("event_count"),
    ]
    return rolled.where(s.isNotNull()).select(*kept, *last, *_attributed("last_non_direct_", chosen),
                                              *metrics)
