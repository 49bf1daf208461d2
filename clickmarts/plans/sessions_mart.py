"""The sessions mart (M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickmarts.config import MartConfig
from clickmarts.operators import sessions as ss
from clickmarts.operators.sliced import known_max_rows


def sessions_mart(events: DataFrame, cfg: MartConfig = MartConfig()) -> DataFrame:
    """One row per session that has a session_start event (123 columns)."""
    prepared = ss.default_dimensions(events, cfg.not_set)
    # Sliced events do not lie by user, so a fused rollup would shuffle every event's records.
    by_user = cfg.window_layout == "user" or known_max_rows(events) is not None
    rolled = ss.session_rollup(prepared, cfg.rollup if by_user else "narrow")
    # Sessions per user never exceed events per user: a maximum that this very events frame
    # was counted with saves a second count.
    with_lnd = ss.last_non_direct(rolled, cfg.window_layout, cfg.session_slice_seconds,
                                  cfg.skew_threshold_rows, known_max_rows(events))
    return ss.assemble_sessions(with_lnd, cfg.last_non_direct_lookback)
