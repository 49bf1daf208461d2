"""Key lookups in GA-style ``array<struct<key, value<...>>>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VALUE_SLOTS = ("string_value", "int_value", "float_value", "double_value")


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def param_keys(arr) -> Column:
    """The keys of a key/value array, in order (materialise once, reuse per lookup)."""
    return F.transform(_as_col(arr), lambda p: p["key"])


def param_entry(arr, key: str, keys=None) -> Column:
    """First entry whose key is ``key``; NULL when absent.

    A correlated "select value from unnest(arr) where key = k" in the
    reference; here a positional lookup inside the row (``array_position`` on
    the key array, 0 when absent, and ``get`` which yields NULL out of
    bounds), so no join or explode is planned and no exception is raised on
    a missing key under ANSI mode.  Passing a precomputed ``keys`` column
    shares one key extraction between many lookups.
    """
    a = _as_col(arr)
    k = param_keys(a) if keys is None else _as_col(keys)
    return F.get(a, F.array_position(k, F.lit(key)) - F.lit(1))


def param(arr, key: str, slot: str = "string_value", keys=None) -> Column:
    """Value of ``key`` in a key/value array, read from one typed slot (F1)."""
    if slot not in VALUE_SLOTS:
        raise ValueError(f"unknown value slot {slot!r}")
    return param_entry(arr, key, keys)["value"][slot]


def param_numeric(arr, key: str, keys=None) -> Column:
    """float slot, else int slot (the double slot is not consulted) (F2)."""
    hit = param_entry(arr, key, keys)
    return F.coalesce(hit["value"]["float_value"], hit["value"]["int_value"].cast("double"))


def value_as_string(value, not_set: str) -> Column:
    """Typed value struct rendered as text: string, else int, float, double, else the slug."""
    v = _as_col(value)
    return F.coalesce(
        v["string_value"],
        v["int_value"].cast("string"),
        v["float_value"].cast("string"),
        v["double_value"].cast("string"),
        F.lit(not_set),
    )
