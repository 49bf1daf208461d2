"""Small files and folder listings on whatever storage a path names.

Everything goes through Hadoop's file system classes, so the same code works on local
disks, HDFS and object stores.  Nothing here reads table data.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Optional

from pyspark.sql import SparkSession


class PathTaken(Exception):
    """A file that must be created only once is already there."""


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where))


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` with ``text``, whole or not at all; :class:`PathTaken` if it is there.

    The text is written beside it first and renamed without overwriting, which the file
    system decides for all writers at once.
    """
    jvm = spark.sparkContext._jvm
    fs, where = _fs(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(context.makeQualified(beside), context.makeQualified(where), options)
    except Exception as e:
        fs.delete(beside, False)
        if "FileAlreadyExistsException" in str(e) or "already exists" in str(e):
            raise PathTaken(path) from None
        raise


def newest_day(spark: SparkSession, path: str, partition_col: str = "date_tz") -> Optional[dt.date]:
    """Newest day partition of a table by listing its folders, without reading a file.
    Folders without data files do not count; None where there is no table or no day."""
    for name in reversed(names(spark, path)):
        value = name.removeprefix(f"{partition_col}=")
        if value == name or value == "__HIVE_DEFAULT_PARTITION__":
            continue
        if any(not n.startswith(("_", ".")) for n in names(spark, f"{path}/{name}")):
            return dt.date.fromisoformat(value)
    return None


def order_by_day(spark: SparkSession, path: str) -> None:
    """Let file times follow the days of a shard directory: a stream then reads it day by day."""
    suffixes = sorted((n for n in names(spark, path) if "=" in n), key=lambda n: n[-8:])
    for i, name in enumerate(suffixes):
        set_time(spark, f"{path}/{name}", 1_700_000_000 + 60 * i)


def set_time(spark: SparkSession, folder: str, seconds: int) -> None:
    """Set the modification time of all files in a folder (epoch seconds)."""
    for name in names(spark, folder):
        fs, where = _fs(spark, f"{folder}/{name}")
        fs.setTimes(where, seconds * 1000, -1)
