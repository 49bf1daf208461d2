"""The events mart (M1): raw tagged events -> one cleaned row per event."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickmarts.config import MartConfig
from clickmarts.operators import attribution as attr
from clickmarts.operators import events as ev
from clickmarts.operators import sliced


def prepare_events(raw: DataFrame, cfg: MartConfig = MartConfig()) -> DataFrame:
    """Row-local part of the events mart (P1-P11): no window, no shuffle.

    Usable on a streaming DataFrame as is.  ``raw`` carries the raw export
    columns plus ``business_unit``, ``is_streaming`` and ``date_tz``
    (see :mod:`clickmarts.sources.shards`).
    """
    df = ev.fill_user_id(raw)
    df = attr.extract_params(df)
    df = attr.resolve_traffic_fields(df)
    df = attr.add_templates(df)
    df = attr.resolve_channel(df, cfg.not_set)
    return ev.flatten_records(df, cfg.strict_engagement)


#: What the windows (W1-W4) read of a prepared row.
WINDOW_INPUTS = ("user_pseudo_id", "event_timestamp_utc", "event_name", "event_bundle_sequence_id", "stream_id",
                 "ga_session_id", "page_url", "hostname")


def _windows(df: DataFrame, layout: str, cfg: MartConfig) -> DataFrame:
    """W1-W4 (+ session key and URL parts) in the chosen layout."""
    if layout == "sliced":
        # The windows run on narrow rows; the records meet their results once, by row number.
        wide = df if sliced.ROW in df.columns else sliced.materialize(sliced.numbered_rows(df), "prepared-events")
        narrow = wide.select(sliced.ROW, "_row_hash", *WINDOW_INPUTS)
        if cfg.id_scope == "scan":
            narrow = sliced.rank_events(narrow, cfg.slice_seconds)
        else:
            narrow = ev.rank_events(narrow, cfg.id_scope).drop("_sec")  # keyed by (user, instant): no hot partition
        narrow = sliced.backfill_session_id(sliced.materialize(narrow, "ranked-events"), cfg.session_length_seconds)
        narrow = sliced.materialize(ev.add_session_key(narrow), "sessionised-events")
        narrow = ev.with_url_parts(narrow, "page_url", cfg.clean_path)
        narrow = sliced.navigation_and_sequence(narrow, cfg.slice_seconds)
        kept = [c for c in wide.columns if c not in ("_row_hash", "hostname", "event_timestamp_utc", "ga_session_id")]
        found = [c for c in narrow.columns if c == sliced.ROW or c not in kept and c != "_row_hash"]
        return wide.select(*kept).join(narrow.select(*found), sliced.ROW).drop(sliced.ROW)
    if cfg.id_scope == "instant":
        df = df.repartition("user_pseudo_id")  # one exchange for the rank and all that follows
    df = ev.rank_events(df, cfg.id_scope)
    df = ev.backfill_session_id(df, cfg.session_length_seconds)
    df = ev.add_session_key(df)
    df = ev.with_url_parts(df, "page_url", cfg.clean_path)
    df = ev.page_navigation(df)
    return ev.event_sequence(df)


def events_mart(raw: DataFrame, cfg: MartConfig = MartConfig()) -> DataFrame:
    """All 86 event columns (P16 order).

    ``window_layout="user"``: one hash exchange on ``user_pseudo_id`` serves
    the rank (W1), the session id back-fill (W2) and the per-session
    navigation windows (W3, W4).  ``"sliced"``: the same results from windows
    over (user, time slice) partitions plus small per-slice summaries, so no
    task ever holds all events of one user or session.  ``"auto"`` (default)
    counts events per user once; users above ``cfg.skew_threshold_rows`` go
    through the sliced windows, all others through the per-user ones, and
    the two results are unioned (exact: every window is per user or finer).

    The windows run on the raw row plus the few columns they read; the
    row-local attribution (P2-P10) and flattening (P11) are applied after
    them, so shuffles and sorts do not carry the derived fields.
    """
    df = ev.window_inputs(attr.extract_params(ev.fill_user_id(raw, numbered=cfg.number_anonymous)))
    layout, top, hot = sliced.plan_layout(df, cfg.window_layout, "user_pseudo_id",
                                          cfg.skew_threshold_rows)
    if layout == "split":
        # Written once: the rows are not derived anew for each side.
        df = sliced.materialize(sliced.numbered_rows(df), "prepared-events")
        normal, hot_rows = sliced.split_by_keys(df, hot, "user_pseudo_id")
        df = _windows(normal.drop(sliced.ROW), "user", cfg).drop("_row_hash").unionByName(_windows(hot_rows, "sliced", cfg))
    else:
        df = _windows(df, layout, cfg)
    df = attr.resolve_traffic_fields(df)
    df = attr.add_templates(df)
    df = attr.resolve_channel(df, cfg.not_set)
    mart = ev.finish_columns(df, cfg.strict_engagement)
    return sliced.remember_max_rows(mart, top if layout == "user" else None)
