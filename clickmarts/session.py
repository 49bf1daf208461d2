"""Spark session helpers.

Library code never creates a session; these helpers are for tests, the bench
and the CLI-style entry points.  ``configure`` pins the settings every mart
relies on (UTC session time zone, AQE) on a session it is handed.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Pinned on any session the registered queries run on: the marts are defined
# in UTC, and TimestampType values are rendered in the session zone.  (The
# computations themselves use epoch micros and do not depend on it.)
_PINNED_CONF = {"spark.sql.session.timeZone": "UTC"}

# Defaults for sessions this module creates (tests, bench); on a user's own
# session these are left as configured.
_SESSION_CONF = {
    **_PINNED_CONF,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _PINNED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "clickmarts") -> SparkSession:
    """A local session for tests and the bench (UI off, modest shuffle fan-out)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CLICKMARTS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in _SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def free_shuffles(spark: SparkSession) -> None:
    """After a write whose rows are read back: let Spark delete the shuffle files behind it.
    Its cleaner waits for the driver's JVM to collect the finished plan."""
    spark.sparkContext._jvm.System.gc()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is respected as is.  Only when nothing is configured (local tests) do
    we pick a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = (spark.conf.get("spark.checkpoint.dir", None)
               or sc.getConf().get("spark.checkpoint.dir", None)
               or sc.getCheckpointDir())
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="clickmarts-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current
