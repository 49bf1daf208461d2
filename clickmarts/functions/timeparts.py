"""Time arithmetic on epoch microseconds.

Calendar parts are computed from the integer micros so the result does not
depend on the session time zone: the marts are defined in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3_600 * MICROS_PER_SECOND
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(c, n: int) -> Column:
    """Exact floor(c / n) for a long column and a positive constant."""
    c = _c(c)
    return ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("long")


def seconds_from_micros(micros) -> Column:
    """``unix_seconds(timestamp_micros(x))``."""
    return floor_div(micros, MICROS_PER_SECOND)


def hour_from_micros(micros) -> Column:
    """UTC hour of day (0-23) as a long."""
    return floor_div(F.pmod(_c(micros), F.lit(MICROS_PER_DAY)), MICROS_PER_HOUR)


def date_from_micros(micros) -> Column:
    """UTC calendar date of an epoch-micros instant."""
    return F.date_from_unix_date(floor_div(micros, MICROS_PER_DAY).cast("int"))


def date_of(ts) -> Column:
    """UTC date of a TimestampType column."""
    return date_from_micros(F.unix_micros(_c(ts)))


def _trunc_div(delta: Column, n: int) -> Column:
    q = floor_div(F.abs(delta), n)
    return F.when(delta < 0, -q).otherwise(q)


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (timestamps), truncated toward zero."""
    return _trunc_div(F.unix_micros(_c(end)) - F.unix_micros(_c(start)), MICROS_PER_SECOND)


def days_between(start, end) -> Column:
    """Whole 24-hour days from ``start`` to ``end`` (timestamps), truncated toward zero."""
    return _trunc_div(F.unix_micros(_c(end)) - F.unix_micros(_c(start)), MICROS_PER_DAY)


def duration_seconds(start, end) -> Column:
    """Seconds from start to end, NULL -> 0, never negative."""
    return F.greatest(F.coalesce(seconds_between(start, end), F.lit(0)), F.lit(0)).cast("long")


def engagement_seconds(text, strict: bool = True) -> Column:
    """Engagement milliseconds held as text -> seconds (double).

    ``strict`` keeps the hard cast of the reference (ANSI mode raises on
    malformed text); ``strict=False`` yields NULL instead.
    """
    t = _c(text)
    ms = t.cast("long") if strict else t.try_cast("long")
    return ms / F.lit(1000)
