"""Deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "_null_"
SEPARATOR = "-"


def surrogate_key(*cols) -> Column:
    """md5 over the text of the given columns, NULL spelled as a token.

    The rule is stable across engines (md5 of the same bytes), so the DuckDB
    oracle reproduces ids exactly.
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
        for c in cols
    ]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
