"""Day-partitioned mart tables.

``write_partitions`` replaces exactly the ``date_tz`` partitions present in
the DataFrame and keeps all others (dynamic partition overwrite), the
equivalent of an insert-overwrite of the refreshed days.  A REBALANCE hint on
the partition column lets AQE split an oversized day into several writer
tasks and merge small ones, so no single task writes a whole large day.
"""

from __future__ import annotations

import uuid
from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmarts.session import ensure_checkpoint_dir, free_shuffles

PARTITION_COL = "date_tz"


def write_partitions(df: DataFrame, path: str, partition_col: str = PARTITION_COL,
                     rebalance: bool = True) -> None:
    """Overwrite only the day partitions present in ``df``."""
    # Column metadata holds facts about this run (rows per user), not about the table.
    for field in df.schema.fields:
        if field.metadata:
            df = df.withMetadata(field.name, {})
    out = df.hint("rebalance", partition_col) if rebalance else df
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path))
    free_shuffles(df.sparkSession)


def read_partitions(spark: SparkSession, path: str, first_day=None,
                    partition_col: str = PARTITION_COL) -> DataFrame:
    """Read a mart table; a day bound prunes partitions at listing time."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    if first_day is not None:
        df = df.where(F.col(partition_col) >= F.lit(first_day))
    return df


def read_synced(spark: SparkSession, path: str, columns: Sequence[str] | T.StructType,
                partition_col: str = PARTITION_COL) -> DataFrame:
    """Read a mart whose partitions were written with different column sets,
    exposing exactly ``columns`` (S7): columns new in the latest schema are
    NULL in older partitions, columns dropped from it are not exposed.
    Parquet files are left as written; the sync is applied on read.  A column
    that no file has is NULL of its type in ``columns``, or of type string if
    only names are given.  (``snapshots.MartTable`` keeps a column log instead.)
    """
    df = spark.read.option("mergeSchema", "true").parquet(path)
    present = set(df.columns)
    wanted = {f.name: f.dataType for f in columns.fields} if isinstance(columns, T.StructType) else dict.fromkeys(columns, "string")
    return df.select(*[F.col(c) if c in present else F.lit(None).cast(t).alias(c) for c, t in wanted.items()])


def scratch_path(spark: SparkSession, name: str, base: Optional[str] = None) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local
    on a cluster: ``spark.checkpoint.dir`` names shared storage there)."""
    root = base or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/clickmarts-{name}-{uuid.uuid4().hex[:12]}"
