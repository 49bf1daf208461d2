"""Live sessions from an event stream, with the ids and metrics of the batch marts.

The client's clock decides neither the watermark nor how long state lives: event time is the
client's time held within a day of the shard that the server put the event into.  A row
dated 2050 moves the watermark no further than its shard does.

State is one list of narrow event records per user and overlapping slice of two hours,
starting each hour (``window``).  An event of the slice's middle hour has everything within
half an hour of it in the same slice, which is all that the session-id back-fill (W2) looks
at; the outer half hours are only context.  A slice closes when the watermark passes its end,
is sent on once, and its state goes, so a user who never pauses holds two hours of state.

Closed slices are back-filled by the same window function as the batch mart and reduced to
one piece per session and batch.  Pieces merge by sums, least and largest values, so a
session over many slices, or with a late slice, is exact without being reopened.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmarts.config import SESSION_LENGTH_SECONDS
from clickmarts.functions.keys import surrogate_key
from clickmarts.functions.params import param
from clickmarts.functions.timeparts import floor_div, seconds_from_micros
from clickmarts.operators.events import backfill_session_id
from clickmarts.sources import files

CORE_SECONDS = 3600
PIECE_COLUMNS = ("session_id", "user_pseudo_id", "events", "page_views", "engaged_msec", "first_event_at_utc", "last_event_at_utc")


def bounded_event_time(micros: Column, day: Column, slack_days: int = 1) -> Column:
    """Client time, but no more than ``slack_days`` outside of the shard's day."""
    client = F.timestamp_micros(micros)
    low = F.date_sub(day, slack_days).cast("timestamp")
    high = F.date_add(day, slack_days + 1).cast("timestamp")
    return F.when(day.isNull() | micros.isNull(), F.lit(None).cast("timestamp")).otherwise(
        F.greatest(F.least(client, high), low))


def activity_slices(prepared: DataFrame, delay: str = "1 day", seconds: int = SESSION_LENGTH_SECONDS) -> DataFrame:
    """(user_pseudo_id, slice, events): closed slices of a prepared event stream.

    Rows without a shard day or time belong to no slice.
    """
    rows = prepared.select(
        "user_pseudo_id", "event_timestamp_utc", "event_name", "event_bundle_sequence_id", "ga_session_id",
        param(F.col("event_params"), "engagement_time_msec", "int_value").alias("msec"),
        bounded_event_time(F.col("event_timestamp_utc"), F.col("date_tz")).alias("event_time"))
    record = F.struct("event_timestamp_utc", "event_time", "event_name", "event_bundle_sequence_id", "ga_session_id", "msec")
    return (rows.withWatermark("event_time", delay)
            .groupBy("user_pseudo_id", F.window("event_time", f"{CORE_SECONDS + 2 * seconds} seconds",
                                                f"{CORE_SECONDS} seconds").alias("slice"))
            .agg(F.collect_list(record).alias("events")))


def session_pieces(slices: DataFrame, seconds: int = SESSION_LENGTH_SECONDS) -> DataFrame:
    """One row per session of closed slices, from their middle hours (:data:`PIECE_COLUMNS`)."""
    events = slices.select(F.col("user_pseudo_id"), F.unix_seconds("slice.start").alias("slice"), F.inline("events"))
    order = Window.partitionBy("user_pseudo_id", "slice").orderBy("event_timestamp_utc", "event_name", "event_bundle_sequence_id")
    ranked = events.withColumn("_row_num", F.row_number().over(order).cast("long"))
    filled = backfill_session_id(ranked, seconds, keys=("user_pseudo_id", "slice"))
    at = F.unix_seconds("event_time") - F.col("slice")
    core = filled.where((at >= seconds) & (at < seconds + CORE_SECONDS))
    return core.groupBy(surrogate_key("user_pseudo_id", "ga_session_id").alias("session_id"), "user_pseudo_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_name") == "page_view").alias("page_views"),
        F.sum("msec").alias("engaged_msec"),
        F.timestamp_micros(F.min("event_timestamp_utc")).alias("first_event_at_utc"),
        F.timestamp_micros(F.max("event_timestamp_utc")).alias("last_event_at_utc"))


def write_pieces(path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: a batch's pieces replace those of the same batch, so replays add nothing."""
    def run(batch: DataFrame, batch_id: int) -> None:
        session_pieces(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return run


def live_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Sessions of all closed slices so far: the pieces at ``path`` merged."""
    if not any(n.startswith("batch=") for n in files.names(spark, path)):
        schema = ("session_id string, user_pseudo_id string, events long, page_views long, engaged_seconds double, "
                  "first_event_at_utc timestamp, last_event_at_utc timestamp")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).groupBy("session_id", "user_pseudo_id").agg(
        F.sum("events").alias("events"), F.sum("page_views").alias("page_views"),
        (F.sum("engaged_msec") / F.lit(1000)).alias("engaged_seconds"),
        F.min("first_event_at_utc").alias("first_event_at_utc"), F.max("last_event_at_utc").alias("last_event_at_utc"))


def closed_slice_end(micros: Column, seconds: int = SESSION_LENGTH_SECONDS) -> Column:
    """Epoch second at which the slice with an event in its middle hour closes."""
    second = seconds_from_micros(micros)
    return floor_div(second - F.lit(seconds), CORE_SECONDS) * F.lit(CORE_SECONDS) + F.lit(CORE_SECONDS + 2 * seconds)
