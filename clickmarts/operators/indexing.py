"""Distributed positional index (a global row number without a single-task window)."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dense_index(df: DataFrame, key: str, out: str = "rn",
                num_partitions: Optional[int] = None) -> DataFrame:
    """0-based position of each row in ``key`` order (key assumed unique).

    ``row_number() over (order by key)`` would move every row into one task.
    Instead rows are range-partitioned on ``key`` (Spark samples the bounds),
    numbered inside their partition, and shifted by the row count of all
    earlier partitions.  Only the per-partition counts (one row per
    partition, a bounded table) are gathered and broadcast.
    """
    ranged = (df.repartitionByRange(num_partitions, F.col(key)) if num_partitions
              else df.repartitionByRange(F.col(key)))
    ranged = ranged.withColumn("_pid", F.spark_partition_id())
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(key)) - F.lit(1)
    numbered = ranged.withColumn("_local", local)
    return (numbered.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("long"))
            .drop("_pid", "_off", "_local"))
