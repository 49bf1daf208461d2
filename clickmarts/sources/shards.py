"""Raw export scans.

Layout: one parquet directory per property, partitioned by the export's table
suffix (``table_suffix=20240101`` for daily, ``table_suffix=intraday_20240101``
for intraday shards).  Day bounds are literal predicates on the partition
column, so Spark prunes whole shard directories before reading.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce
from typing import Iterable, Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmarts.config import PREVIEW_DEFAULT_DAYS

# Raw export columns read by the events mart (S2), in the reference's order.
RAW_COLUMNS = (
    "event_name", "event_timestamp", "event_params", "event_previous_timestamp",
    "event_value_in_usd", "event_bundle_sequence_id", "event_server_timestamp_offset",
    "user_id", "user_pseudo_id", "privacy_info", "user_properties",
    "user_first_touch_timestamp", "user_ltv", "device", "geo", "app_info", "traffic_source",
    "collected_traffic_source", "session_traffic_source_last_click", "stream_id", "platform",
    "event_dimensions", "ecommerce", "items",
)
SUFFIX_COL = "table_suffix"


@dataclass(frozen=True)
class Property:
    """One export stream: a human-readable name and its shard directory."""

    name: str
    path: str


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """All shards of one export with the raw column projection plus the suffix."""
    df = spark.read.parquet(path)
    return df.select(*RAW_COLUMNS, F.col(SUFFIX_COL).cast("string").alias(SUFFIX_COL))


def tag_shard(df: DataFrame, suffix_col: str = SUFFIX_COL) -> DataFrame:
    """``is_streaming`` ('streaming' for intraday shards, else 'daily') and
    ``date_tz`` (last 8 characters of the suffix as a date) (S3)."""
    sfx = F.col(suffix_col)
    return df.withColumns({
        "is_streaming": F.when(sfx.rlike("^intraday_"), F.lit("streaming")).otherwise(F.lit("daily")),
        "date_tz": F.to_date(F.right(sfx, F.lit(8)), "yyyyMMdd"),
    }).drop(suffix_col)


def tag_property(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("business_unit", F.lit(name))


def union_frames(frames: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """UNION ALL of several properties, each tagged with its name."""
    tagged = [tag_property(df, name) for name, df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_properties(spark: SparkSession, properties: Iterable[Property],
                     bound=None) -> DataFrame:
    """Read, bound (optional, applied per property before the union) and tag."""
    frames = []
    for prop in properties:
        df = read_shards(spark, prop.path)
        if bound is not None:
            df = bound(df)
        frames.append((prop.name, df))
    return union_frames(frames)


def _yyyymmdd(d: _dt.date) -> str:
    return d.strftime("%Y%m%d")


def preview_window_days(dag_max_days: Optional[int], preview_days: Optional[int]) -> int:
    """Days kept by the preview bound.

    Reference rule: ``dag_max_days`` only wins when it is below the preview
    variable, whose default in that comparison is 0 - so with the preview
    variable unset the window is always the 7-day default.
    """
    if dag_max_days is not None and dag_max_days < (preview_days if preview_days is not None else 0):
        return dag_max_days
    return preview_days if preview_days is not None else PREVIEW_DEFAULT_DAYS


def preview_bound(df: DataFrame, today: _dt.date, dag_max_days: Optional[int] = None,
                  preview_days: Optional[int] = None, suffix_col: str = SUFFIX_COL) -> DataFrame:
    """Keep shards dated between today - N and today (S4); ``today`` is injected."""
    n = preview_window_days(dag_max_days, preview_days)
    lo, hi = _yyyymmdd(today - _dt.timedelta(days=n)), _yyyymmdd(today)
    day = F.right(F.col(suffix_col), F.lit(8))
    return df.where(day.between(F.lit(lo), F.lit(hi)))


def max_partition(target: DataFrame, col: str = "date_tz") -> Optional[_dt.date]:
    """Newest day partition of an existing mart (reads the partition column only)."""
    return target.agg(F.max(col)).first()[0]


def incremental_bound(df: DataFrame, max_day: Optional[_dt.date], days: int,
                      suffix_col: str = SUFFIX_COL) -> DataFrame:
    """Keep shards dated on or after ``max_day - days`` (S5); no-op on first build."""
    if max_day is None:
        return df
    lo = _yyyymmdd(max_day - _dt.timedelta(days=days))
    return df.where(F.right(F.col(suffix_col), F.lit(8)) >= F.lit(lo))


def date_bound(df: DataFrame, first_day: Optional[_dt.date], col: str = "date_tz") -> DataFrame:
    """Same bound on an already-tagged frame (mart inputs)."""
    if first_day is None:
        return df
    return df.where(F.col(col) >= F.lit(first_day))


def prefer_daily(df: DataFrame) -> DataFrame:
    """Opt-in: drop intraday rows of days for which the same property has a daily shard.

    The reference keeps both, doubling such days.  Left-anti join on property
    and day; the list is a distinct over the property and partition columns.
    """
    keys = [c for c in ("business_unit", "date_tz") if c in df.columns]
    daily_days = df.where(F.col("is_streaming") == "daily").select(*keys).distinct()
    intraday = df.where(F.col("is_streaming") == "streaming").join(daily_days, keys, "left_anti").select(*df.columns)
    return df.where(F.col("is_streaming") == "daily").unionByName(intraday)


def read_export(spark: SparkSession, properties: Iterable[Property], cfg=None, *,
                preview: bool = False, today: Optional[_dt.date] = None,
                max_day: Optional[_dt.date] = None) -> DataFrame:
    """The events mart's input: all properties, bounded, unioned and tagged.

    The preview bound applies on a preview run or whenever ``cfg.dag_max_days``
    is set (as in the reference); the incremental bound applies when the
    target's newest partition ``max_day`` is given.  Both are literal
    predicates on the shard suffix, so unread shards are pruned per property
    before the union.
    """
    from clickmarts.config import MartConfig
    cfg = cfg or MartConfig()

    def bound(df: DataFrame) -> DataFrame:
        if preview or cfg.dag_max_days is not None:
            df = preview_bound(df, today or _dt.date.today(), cfg.dag_max_days, cfg.preview_days)
        return incremental_bound(df, max_day, cfg.incremental_refresh_days)

    tagged = tag_shard(union_properties(spark, properties, bound))
    return prefer_daily(tagged) if cfg.prefer_daily else tagged
