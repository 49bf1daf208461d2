"""Skew-robust ("time-sliced") versions of the per-user and per-session windows.

A window partitioned by user puts all of a user's events in one task; one
bot holding a third of the rows would then be sorted by a single task, and
AQE cannot split window partitions.  Here each window runs inside
(key, time slice) partitions - a hot user is spread over as many tasks as it
has active slices - and is then corrected from a small per-(key, slice)
summary table:

* row numbers: local number + events in earlier slices (prefix sum over the
  summary rows of the key);
* lag / lead up to 2 rows: the last two rows of the previous non-empty
  slices and the first two of the next ones;
* "last non-NULL" scans: the last non-NULL value of earlier slices.

Summary tables have one row per (key, slice); the windows over them hold at
most the number of slices of one key.  Results are identical to the plain
windows (the oracle checks both).  The slice column comes from the first
ordering column, so slice order agrees with row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmarts.config import SEQUENCE_EXCLUDED_EVENTS
from clickmarts.functions.keys import surrogate_key
from clickmarts.functions.timeparts import MICROS_PER_SECOND, floor_div, seconds_from_micros
from clickmarts.operators.events import row_hash
from clickmarts.session import free_shuffles

SLICE = "_slice"
ROW = "_row"  # number of a written row
_NULL_SLICE = -(1 << 62)  # rows without a timestamp sort first, like NULLs do


def known_max_rows(df: DataFrame):
    """Upper bound on rows per user that :func:`remember_max_rows` left on this very frame."""
    return getattr(df, "_max_rows_per_user", None)


def remember_max_rows(df: DataFrame, top) -> DataFrame:
    """Note the counted maximum of rows per user on the frame object.  It goes with no frame
    made from it (a filter, a union, a table written and read back), for which it may not hold."""
    if top is not None:
        df._max_rows_per_user = int(top)
    return df


# Hot keys are at most total_rows / threshold; below this count the key list
# is broadcast (a proven size bound), above it the join is left to AQE.
BROADCAST_HOT_KEYS_MAX = 200_000


def plan_layout(df: DataFrame, layout: str, key: str, threshold: int, bound=None):
    """Resolve ``"auto"`` into "user" or "split" (hot keys sliced, others per key).

    Returns (layout, max rows per key or None, hot-key DataFrame or None).
    One narrow aggregate over the key column; the driver receives two
    numbers (the maximum and how many keys exceed ``threshold``).  A known
    upper ``bound`` at or below the threshold skips the count.
    """
    if layout != "auto":
        return layout, None, None
    if bound is not None and bound <= threshold:
        return "user", bound, None
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    top, n_hot = counts.agg(F.max("_n"), F.count_if(F.col("_n") > F.lit(threshold))).first()
    if not n_hot:
        return "user", top, None
    # Written: both sides of the split read the list, not the rows it was counted from.
    hot = materialize(counts.where(F.col("_n") > F.lit(threshold)).select(key), "hot-keys")
    if n_hot <= BROADCAST_HOT_KEYS_MAX:
        hot = F.broadcast(hot)
    return "split", top, hot


def split_by_keys(df: DataFrame, hot: DataFrame, key: str):
    """(rows of other keys, rows of hot keys): anti / semi joins on the hot-key list."""
    return df.join(hot, key, "left_anti"), df.join(hot, key, "left_semi")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    The two-pass sliced windows read their input more than once (a narrow
    summary pass and the main pass); reading a written table instead of
    re-deriving the lineage keeps that to one computation, lets narrow passes
    read only their columns, and cuts the lineage (a lost executor does not
    trigger recomputation from the raw data).
    """
    from clickmarts.sources.sinks import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    free_shuffles(spark)
    return spark.read.parquet(path)


def numbered_rows(df: DataFrame) -> DataFrame:
    """Rows with a number each, for a join back once written, and the hash that ranks need."""
    return df.withColumns({ROW: F.monotonically_increasing_id(), "_row_hash": row_hash(df)})


def slice_of(micros: Column, slice_seconds: int) -> Column:
    return F.coalesce(floor_div(micros, slice_seconds * MICROS_PER_SECOND), F.lit(_NULL_SLICE))


def _before(keys, order) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _prefix_offsets(counted: DataFrame, keys, count_cols) -> DataFrame:
    """Add, per count column, the total of the key's earlier slices."""
    w = _before(keys, [SLICE])
    return counted.select(*keys, SLICE, *[
        F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_off") for c in count_cols])


# -- W1 ---------------------------------------------------------------------------

def rank_events(df: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """Per-user row number by (time, name, bundle) + event id; = events.rank_events('scan')."""
    df = df.withColumn(SLICE, slice_of(F.col("event_timestamp_utc"), slice_seconds))
    keys = ["user_pseudo_id"]
    w = Window.partitionBy(*keys, SLICE).orderBy("event_timestamp_utc", "event_name",
                                                  "event_bundle_sequence_id", row_hash(df))
    local = df.withColumn("_rn", F.row_number().over(w))
    counts = df.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_n"))
    offsets = _prefix_offsets(counts, keys, ["_n"])
    ranked = local.join(offsets, [*keys, SLICE]).withColumn(
        "_row_num", (F.col("_rn") + F.col("_n_off")).cast("long")).drop("_rn", "_n_off", SLICE)
    return ranked.withColumn(
        "event_id", surrogate_key("stream_id", "user_pseudo_id", "event_timestamp_utc", "_row_num"))


# -- W2 ---------------------------------------------------------------------------

def backfill_session_id(df: DataFrame, seconds: int = 1800) -> DataFrame:
    """= events.backfill_session_id, without a per-user partition.

    Slices are 2 x ``seconds`` wide, so the look-back window [t - 2s, t] of a
    probe at t = second + s lies in slice(t) and the slice before it.  Only
    narrow (user, slice, second, rank, value) rows are shuffled: non-NULL rows
    as values in their own slice, NULL rows as probes in slice(t).  A running
    "last value" inside slice(t) answers most probes; otherwise the last value
    of the previous slice (an aggregate) is used if it is recent enough.  The
    answers are joined back to the NULL rows only; other rows do not move.
    """
    width = 2 * seconds
    sec = seconds_from_micros(F.col("event_timestamp_utc"))
    has = F.col("ga_session_id").isNotNull()
    df = df.withColumn("_sec", sec)
    # (time, rank) is unique per user under both id scopes and orders ties.
    tie = [F.col("event_timestamp_utc").alias("_ts"), "_row_num"]
    values = df.where(has).select(
        "user_pseudo_id", floor_div(F.col("_sec"), width).alias(SLICE), F.col("_sec").alias("_ord"),
        F.lit(0).alias("_kind"), *tie, F.col("ga_session_id").alias("_v"))
    probes = df.where(~has & F.col("_sec").isNotNull()).select(
        "user_pseudo_id", floor_div(F.col("_sec") + F.lit(seconds), width).alias(SLICE),
        (F.col("_sec") + F.lit(seconds)).alias("_ord"), F.lit(1).alias("_kind"), *tie,
        F.lit(None).cast("long").alias("_v"))
    w = (Window.partitionBy("user_pseudo_id", SLICE).orderBy("_ord", "_kind", "_ts", "_row_num")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = values.unionByName(probes).withColumn(
        "_cand", F.last(F.when(F.col("_kind") == 0, F.struct(F.col("_ord").alias("s"), F.col("_v").alias("v"))),
                        ignorenulls=True).over(w))
    answers = running.where(F.col("_kind") == 1)
    last_of_slice = values.groupBy("user_pseudo_id", SLICE).agg(
        F.max_by(F.struct(F.col("_ord").alias("s"), F.col("_v").alias("v")),
                 F.struct("_ord", "_ts", "_row_num")).alias("_prev")
    ).withColumn(SLICE, F.col(SLICE) + F.lit(1))
    answers = answers.join(last_of_slice, ["user_pseudo_id", SLICE], "left").select(
        "user_pseudo_id", F.col("_ts").alias("event_timestamp_utc"), "_row_num",
        F.coalesce(F.col("_cand.v"),
                   F.when(F.col("_prev.s") >= F.col("_ord") - F.lit(width), F.col("_prev.v")))
        .alias("_filled"))
    own_second = F.substring(F.col("event_timestamp_utc").cast("string"), 1, 10).cast("long")
    filled = (df.where(~has).join(answers, ["user_pseudo_id", "event_timestamp_utc", "_row_num"], "left")
              .withColumn("ga_session_id", F.coalesce(F.col("_filled"), own_second)).drop("_filled"))
    return df.where(has).unionByName(filled.select(*df.columns)).drop("_sec")


# -- W3, W4 ---------------------------------------------------------------------------

def _row() -> Column:
    return F.struct(F.col("page_path").alias("path"), F.col("event_id").alias("id"),
                    F.col("event_timestamp_utc").alias("ts"))


def navigation_and_sequence(df: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """= events.page_navigation + events.event_sequence, sliced by time.

    Rows are hash-partitioned by (user, session, slice) once; the local
    windows, the per-slice summary aggregate and the summary join all reuse
    that partitioning.
    """
    keys = ["user_pseudo_id", "ga_session_id"]
    is_pv = F.coalesce(F.col("event_name") == F.lit("page_view"), F.lit(False))
    seq_on = F.coalesce(~F.col("event_name").isin(*SEQUENCE_EXCLUDED_EVENTS), F.lit(False))
    df = (df.withColumns({"_is_pv": is_pv, "_seq_on": seq_on,
                          SLICE: slice_of(F.unix_micros(F.col("event_timestamp_utc")), slice_seconds)})
          .repartition(*keys, SLICE))
    order = ["event_timestamp_utc", "event_id"]
    wp = Window.partitionBy(*keys, "_is_pv", SLICE).orderBy(*order)
    ws = Window.partitionBy(*keys, "_seq_on", SLICE).orderBy(*order)
    row = _row()
    local = df.withColumns({
        "_prn": F.row_number().over(wp),
        "_lag1": F.lag(row, 1).over(wp), "_lag2": F.lag(row, 2).over(wp),
        "_lead1": F.lead(row, 1).over(wp), "_lead2": F.lead(row, 2).over(wp),
        "_srn": F.row_number().over(ws),
    })
    pv = F.col("_is_pv")
    summary = local.groupBy(*keys, SLICE).agg(
        F.count_if(pv).alias("_pn"),
        F.count_if(F.col("_seq_on")).alias("_sn"),
        F.max(F.when(pv & (F.col("_prn") == 1), row)).alias("_first1"),
        F.max(F.when(pv & (F.col("_prn") == 2), row)).alias("_first2"),
        F.max(F.when(pv & F.col("_lead1").isNull(), row)).alias("_last1"),
        F.max(F.when(pv & F.col("_lead1").isNotNull() & F.col("_lead2").isNull(), row)).alias("_last2"),
    )
    back = _before(keys, [SLICE])
    fwd = _before(keys, [F.col(SLICE).desc()])
    nonempty = F.col("_pn") > 0
    summary = summary.withColumns({
        "_pn_off": F.coalesce(F.sum("_pn").over(back), F.lit(0)),
        "_sn_off": F.coalesce(F.sum("_sn").over(back), F.lit(0)),
        "_prev1": F.last(F.when(nonempty, F.col("_last1")), ignorenulls=True).over(back),
        "_next1": F.last(F.when(nonempty, F.col("_first1")), ignorenulls=True).over(fwd),
    })
    # Second-to-last page view up to and including a slice / second one from it on.
    summary = summary.withColumns({
        "_upto2": F.when(F.col("_pn") >= 2, F.col("_last2")).when(F.col("_pn") == 1, F.col("_prev1")),
        "_from2": F.when(F.col("_pn") >= 2, F.col("_first2")).when(F.col("_pn") == 1, F.col("_next1")),
    })
    summary = summary.withColumns({
        "_prev2": F.last(F.when(nonempty, F.col("_upto2")), ignorenulls=True).over(back),
        "_next2": F.last(F.when(nonempty, F.col("_from2")), ignorenulls=True).over(fwd),
    }).select(*keys, SLICE, "_pn_off", "_sn_off", "_prev1", "_prev2", "_next1", "_next2")

    j = local.join(summary, [*keys, SLICE])
    prn = F.col("_prn")
    lag1 = F.when(prn >= 2, F.col("_lag1")).otherwise(F.col("_prev1"))
    lag2 = F.when(prn >= 3, F.col("_lag2")).when(prn == 2, F.col("_prev1")).otherwise(F.col("_prev2"))
    lead1 = F.coalesce(F.col("_lead1"), F.col("_next1"))
    lead2 = (F.when(F.col("_lead2").isNotNull(), F.col("_lead2"))
             .when(F.col("_lead1").isNotNull(), F.col("_next1")).otherwise(F.col("_next2")))
    j = j.withColumns({"_g_lag1": lag1, "_g_lag2": lag2, "_g_lead1": lead1, "_g_lead2": lead2})
    ts = F.col("event_timestamp_utc")
    nav = {
        "seconds_on_page": F.timestamp_diff("SECOND", ts, F.col("_g_lead1.ts")),
        "is_entrance": (prn + F.col("_pn_off")) == F.lit(1),
        "is_exit": F.col("_g_lead1").isNull(),
        "page_sequence": (prn + F.col("_pn_off")).cast("long"),
        "previous_page_path": F.coalesce(F.col("_g_lag1.path"), F.lit("Entrance")),
        "previous_page_event_id": F.col("_g_lag1.id"),
        "previous_page_ts_utc": F.col("_g_lag1.ts"),
        "prev_prev_page_path": F.coalesce(F.col("_g_lag2.path"), F.lit("Entrance")),
        "next_page_path": F.coalesce(F.col("_g_lead1.path"), F.lit("Exit")),
        "next_page_event_id": F.col("_g_lead1.id"),
        "next_page_ts_utc": F.col("_g_lead1.ts"),
        "next_next_page_path": F.coalesce(F.col("_g_lead2.path"), F.lit("Exit")),
    }
    out = j.withColumns({k: F.when(pv, v) for k, v in nav.items()})
    out = out.withColumn("event_sequence",
                         F.when(F.col("_seq_on"), (F.col("_srn") + F.col("_sn_off")).cast("long")))
    return out.drop("_is_pv", "_seq_on", SLICE, "_prn", "_srn", "_lag1", "_lag2", "_lead1", "_lead2",
                    "_pn_off", "_sn_off", "_prev1", "_prev2", "_next1", "_next2",
                    "_g_lag1", "_g_lag2", "_g_lead1", "_g_lead2")


# -- W7 ---------------------------------------------------------------------------------

def last_non_direct(sessions: DataFrame, candidate: Column, own: Column,
                    slice_seconds: int = 86400) -> DataFrame:
    """Running last non-NULL ``candidate`` per user by first-event time, else ``own``.

    = sessions.last_non_direct with session rows sliced by day.
    """
    keys = ["user_pseudo_id"]
    start = F.col("attr.session_start_at_utc")
    df = sessions.withColumns({
        SLICE: slice_of(F.unix_micros(start), slice_seconds),
        "_cand": candidate,
    }).repartition(*keys, SLICE)
    order = [start, F.col("session_id")]
    w = (Window.partitionBy(*keys, SLICE).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = df.withColumn("_local", F.last("_cand", ignorenulls=True).over(w))
    summary = df.groupBy(*keys, SLICE).agg(
        F.max_by(F.col("_cand"), F.when(F.col("_cand").isNotNull(), F.struct(start, F.col("session_id"))))
        .alias("_slice_last"))
    summary = summary.select(*keys, SLICE, F.last("_slice_last", ignorenulls=True)
                             .over(_before(keys, [SLICE])).alias("_carry"))
    return (local.join(summary, [*keys, SLICE])
            .withColumn("lnd", F.coalesce(F.col("_local"), F.col("_carry"), own))
            .drop(SLICE, "_cand", "_local", "_carry"))
