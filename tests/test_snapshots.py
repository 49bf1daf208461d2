"""Atomic versions, the column log and conflicts of mart tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmarts.sources import files
from clickmarts.sources.sinks import scratch_path, write_partitions
from clickmarts.sources.snapshots import CommitConflict, MartTable, consistent_versions, sync_columns

D = [dt.date(2024, 1, d) for d in range(1, 6)]


def table(spark):
    return MartTable(spark, scratch_path(spark, "t-snap"))


def frame(spark, rows, schema="v int, date_tz date"):
    return spark.createDataFrame(rows, schema)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_days_are_replaced_and_others_stay(spark):
    t = table(spark)
    assert t.manifest() is None and t.newest_day() is None
    t.commit(frame(spark, [(1, D[0]), (2, D[1]), (9, None)]))
    t.commit(frame(spark, [(3, D[1]), (4, D[2])]))
    assert got(t.read()) == got(frame(spark, [(1, D[0]), (3, D[1]), (4, D[2]), (9, None)]))
    assert got(t.read(version=1)) == got(frame(spark, [(1, D[0]), (2, D[1]), (9, None)]))
    assert t.newest_day() == D[2] and t.manifest().changed == tuple(sorted(d.isoformat() for d in D[1:3]))
    t.commit(frame(spark, []), days=D[1:2])  # a decided day without rows goes
    assert got(t.read(first_day=D[0])) == [(1, D[0]), (4, D[2])]
    assert got(t.read(days=[D[2], D[4]])) == [(4, D[2])] and t.read(days=[D[4]]).columns == ["v", "date_tz"]
    with pytest.raises(FileNotFoundError):
        MartTable(spark, scratch_path(spark, "t-none")).read()


def test_a_refresh_that_fails_between_two_days_leaves_the_old_version_whole(spark):
    """A task fails after another day's file is already written: readers see nothing of it."""
    t = table(spark)
    t.commit(frame(spark, [(i, d) for i, d in enumerate(D)]))
    before = got(t.read())

    @F.udf("int")
    def fails_on_the_last_day(v):
        if v >= 1004:
            raise RuntimeError("lost")
        return v

    bad = frame(spark, [(1000 + i, d) for i, d in enumerate(D)]).repartition(5, "date_tz").withColumn("v", fails_on_the_last_day("v"))
    with pytest.raises(Exception, match="lost"):
        t.commit(bad)
    assert got(t.read()) == before and t.versions() == [1]
    folder, days = t.stage(frame(spark, [(7, D[0])]), 2)  # staged whole, but never published
    assert days == [D[0].isoformat()] and got(t.read()) == before
    t.commit(frame(spark, [(8, D[0])]))
    assert got(t.read(days=D[:1])) == [(8, D[0])]


def test_concurrent_refreshes(spark):
    t = table(spark)
    base = t.commit(frame(spark, [(1, D[0]), (2, D[1])])).version
    t.commit(frame(spark, [(10, D[0])]), base=base)
    t.commit(frame(spark, [(20, D[1])]), base=base)  # other days: carried on to the next version
    assert got(t.read()) == [(10, D[0]), (20, D[1])] and t.versions() == [1, 2, 3]
    with pytest.raises(CommitConflict):
        t.commit(frame(spark, [(11, D[0])]), base=base)
    with pytest.raises(CommitConflict):  # read a day that has changed since
        t.commit(frame(spark, [(5, D[3])]), base=base, read_days=[D[1]])
    assert t.versions() == [1, 2, 3]


def test_two_writers_of_one_manifest(spark):
    path = scratch_path(spark, "t-once") + "/a/1.json"
    files.write_once(spark, path, "one")
    with pytest.raises(files.PathTaken):
        files.write_once(spark, path, "two")
    assert files.read_text(spark, path) == "one" and files.names(spark, path.rsplit("/", 1)[0]) == ["1.json"]


def test_columns_added_dropped_widened_and_brought_back(spark):
    t = table(spark)
    t.commit(frame(spark, [(1, "a", 1.5, D[0]), (2, "b", 2.5, D[1])], "n int, s string, f float, date_tz date"))
    t.commit(frame(spark, [(2**40, (1,), D[1])], "n long, r struct<x:int>, date_tz date"))
    assert t.read().schema == T.StructType.fromDDL("n long, r struct<x:int>, date_tz date")
    assert got(t.read()) == got(frame(spark, [(1, None, D[0]), (2**40, (1,), D[1])], "n long, r struct<x:int>, date_tz date"))
    t.commit(frame(spark, [(3, (1, "y"), "back", D[2])], "n int, r struct<x:int,y:string>, s string, date_tz date"))
    # Day 1 still holds a file with s='a', from before the column was dropped.
    want = frame(spark, [(1, None, None, D[0]), (2**40, (1, None), None, D[1]), (3, (1, "y"), "back", D[2])],
                 "n long, r struct<x:int,y:string>, s string, date_tz date")
    assert got(t.read()) == got(want) and t.read().schema == want.schema
    log = {(c.name, c.added, c.dropped, c.since) for c in t.manifest().columns}
    assert {("s", 1, 2, "2024-01-01"), ("f", 1, 2, "2024-01-01"), ("r", 2, None, "2024-01-02"), ("s", 3, None, "2024-01-03")} <= log


def test_no_untyped_column(spark):
    t = table(spark)
    t.commit(frame(spark, [(1, "a", D[0])], "n int, s string, date_tz date"))
    t.commit(frame(spark, [(2, D[1])], "n int, date_tz date").withColumn("s", F.lit(None)))
    assert got(t.read().select("n", "s")) == [(1, "a"), (2, None)] and dict(t.read().dtypes)["s"] == "string"
    with pytest.raises(ValueError, match="without a type"):
        sync_columns((), T.StructType([T.StructField("x", T.NullType())]), 1, None)
    with pytest.raises(TypeError, match="n: int"):
        t.commit(frame(spark, [("x", "a", D[1])], "n string, s string, date_tz date"))


def test_versions_that_belong_together(spark):
    events, a, b = table(spark), table(spark), table(spark)
    for v in (1, 2):
        events.commit(frame(spark, [(v, D[0])]))
    a.commit(frame(spark, [(1, D[0])]), inputs={"events": 1})
    assert consistent_versions(events, "events", {"a": a, "b": b}) is None
    b.commit(frame(spark, [(1, D[0])]), inputs={"events": 1})
    a.commit(frame(spark, [(2, D[0])]), inputs={"events": 2})
    assert consistent_versions(events, "events", {"a": a, "b": b}) == {"events": 1, "a": 1, "b": 1}


def test_vacuum_keeps_what_readable_versions_name(spark):
    t = table(spark)
    for v in range(4):
        t.commit(frame(spark, [(v, D[0]), (v, D[1])]) if v < 2 else frame(spark, [(v, D[1])]))
    t.stage(frame(spark, [(9, D[0])]), 5)  # a running refresh
    assert len(t.vacuum(2)) == 1
    assert got(t.read()) == [(1, D[0]), (3, D[1])] and got(t.read(version=3)) == [(1, D[0]), (2, D[1])]


def test_newest_day_from_folder_names(spark):
    path = scratch_path(spark, "t-days")
    assert files.newest_day(spark, path) is None
    write_partitions(frame(spark, [(1, D[0]), (2, D[2]), (3, None)]), path)
    (spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.get(spark.sparkContext._jsc.hadoopConfiguration())
     .mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/date_tz=2024-02-01")))  # no files
    assert files.newest_day(spark, path) == D[2]


def test_columns_that_no_file_has_are_typed(spark):
    from clickmarts.sources.sinks import read_synced
    path = scratch_path(spark, "t-synced")
    write_partitions(frame(spark, [(1, D[0])]), path)
    assert read_synced(spark, path, ["v", "new", "date_tz"]).dtypes == [("v", "int"), ("new", "string"), ("date_tz", "date")]
    typed = read_synced(spark, path, T.StructType.fromDDL("v int, n double, date_tz date"))
    assert got(typed) == [(1, None, D[0])] and typed.dtypes[1] == ("n", "double")
