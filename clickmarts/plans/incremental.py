"""Incremental (late-data) builds of the day-partitioned marts.

Each run re-derives the last ``incremental_refresh_days`` days (plus the
newest) and replaces exactly those ``date_tz`` partitions; older partitions
are kept.  The source read is bounded by literal day predicates on the shard
suffix / partition column, so unrefreshed days are pruned at listing time.

Edges: windows keyed by user or session are cut where the scan starts, so
``padding_days`` extra days are read (not written) before the refreshed
range.  With ``id_scope="instant"`` event ids do not depend on the scanned
range, and an incremental run reproduces a full build on the refreshed days
as long as a session never spans more than ``padding_days``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from typing import Callable, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmarts.config import MartConfig
from clickmarts.plans.events_mart import events_mart
from clickmarts.plans.sessions_mart import sessions_mart
from clickmarts.sources import files
from clickmarts.sources.shards import SUFFIX_COL, tag_shard
from clickmarts.sources.sinks import read_partitions, write_partitions


def _existing_max_day(spark: SparkSession, path: str) -> Optional[dt.date]:
    """Newest day of the table, from its folder names; None where there is none yet (first, full build)."""
    return files.newest_day(spark, path)


def refresh_window(max_day: Optional[dt.date], cfg: MartConfig) -> Optional[dt.date]:
    """First day to rewrite, or None for a full build."""
    if max_day is None:
        return None
    return max_day - dt.timedelta(days=cfg.incremental_refresh_days)


def _bound_suffix(raw: DataFrame, first_day: Optional[dt.date]) -> DataFrame:
    if first_day is None:
        return raw
    return raw.where(F.right(F.col(SUFFIX_COL), F.lit(8)) >= F.lit(first_day.strftime("%Y%m%d")))


def refresh_events(spark: SparkSession, read_raw: Callable[[], DataFrame], target: str,
                   cfg: MartConfig = MartConfig(), padding_days: int = 1) -> Optional[dt.date]:
    """Build or refresh the events mart at ``target``; returns the first rewritten day.

    ``read_raw`` returns the untagged raw union (with ``table_suffix``), e.g.
    ``lambda: union_properties(spark, props)``.
    """
    first = refresh_window(_existing_max_day(spark, target), cfg)
    scan_from = None if first is None else first - dt.timedelta(days=padding_days)
    mart = events_mart(tag_shard(_bound_suffix(read_raw(), scan_from)), cfg)
    if first is not None:
        mart = mart.where(F.col("date_tz") >= F.lit(first))
    write_partitions(mart, target)
    return first


def refresh_sessions(spark: SparkSession, events_path: str, target: str,
                     cfg: MartConfig = MartConfig(), lookback_scan: str = "full") -> Optional[dt.date]:
    """Build or refresh the sessions mart from a written events mart.

    ``lookback_scan="full"`` reads ``last_non_direct_lookback`` extra days of
    events so the last-non-direct leg sees the whole lookback on incremental
    runs too; ``"reference"`` reads only the refreshed days (the reference's
    behaviour, where the lookback is silently capped at the refresh window).
    """
    first = refresh_window(_existing_max_day(spark, target), cfg)
    # The lookback accepts up to that many whole days, just under one day more by the
    # clock; a session that began then may have its first events on the day before.
    lookback = cfg.last_non_direct_lookback or 0
    extra = lookback + 2 if lookback and lookback_scan == "full" else 0
    scan_from = None if first is None else first - dt.timedelta(days=extra)
    events = read_partitions(spark, events_path, scan_from)
    mart = sessions_mart(events, replace(cfg, rollup="narrow"))
    if first is not None:
        mart = mart.where(F.col("date_tz") >= F.lit(first))
    write_partitions(mart, target)
    return first


def refresh_products(spark: SparkSession, events_path: str, target: str,
                     cfg: MartConfig = MartConfig()) -> Optional[dt.date]:
    from clickmarts.operators.products import by_day_and_event, products_mart
    first = refresh_window(_existing_max_day(spark, target), cfg)
    events = by_day_and_event(read_partitions(spark, events_path, first))
    write_partitions(products_mart(events, cfg.not_set), target, rebalance=False)
    return first


def stable_ids(cfg: MartConfig = MartConfig()) -> MartConfig:
    """Config whose event ids survive re-scans (for incremental / streaming use)."""
    return replace(cfg, id_scope="instant")
