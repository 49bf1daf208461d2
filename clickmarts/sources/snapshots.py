"""Mart tables with atomic versions, a column log and day lookups.

Layout of a table::

    <path>/_commit=00000003-<id>/date_tz=2024-01-05/part-*.parquet   staged data
    <path>/_versions/00000003.json                                   what version 3 is

A version is a manifest: for each day the commit whose folder holds it, the columns with
the version that added or dropped them, and the versions of the tables it was built from.
Data is staged in a folder that no manifest names yet; the version appears when its
manifest is created, in one step.  Readers list exactly the folders of one manifest, so a
failed or running refresh is never half visible, whatever its tasks have written.  Two
refreshes of the same version race for one manifest name; the loser is carried on to the
next version if the winner changed no day that it read or wrote, and else fails as a whole.

Manifests hold one entry a day, not one a file, so they stay small at any data size.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import asdict, dataclass, field, replace
from typing import Iterable, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmarts.session import free_shuffles
from clickmarts.sources import files
from clickmarts.sources.schema import merge_types
from clickmarts.sources.sinks import scratch_path

NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
COMMIT_COL = "_commit"
#: Whole tables are dealt by day in so many slices of days, one after the other.
SLICES = 8
SLICE_COL = "_slice_of_days"
#: Keys are hexadecimal digits, which zstd halves and snappy keeps.
CODEC = "zstd"


class CommitConflict(Exception):
    """Another refresh has changed days that this one read or wrote."""


@dataclass(frozen=True)
class Column:
    """A column of the mart, since which version and day; ``dropped`` once it is gone."""

    name: str
    type: str
    added: int
    since: Optional[str] = None
    dropped: Optional[int] = None

    @property
    def data_type(self) -> T.DataType:
        return T.StructType.fromJson(json.loads(self.type)).fields[0].dataType


def _type_text(dtype: T.DataType) -> str:
    return T.StructType([T.StructField("x", dtype)]).json()


@dataclass(frozen=True)
class Manifest:
    version: int
    days: dict[str, list] = field(default_factory=dict)      # day -> [commit folder, version that published it]
    columns: tuple[Column, ...] = ()                          # active and dropped ones
    inputs: dict[str, int] = field(default_factory=dict)      # table name -> its version
    changed: tuple[str, ...] = ()                             # days this version wrote or removed
    notes: dict = field(default_factory=dict)                 # e.g. the batch it belongs to

    @property
    def active(self) -> tuple[Column, ...]:
        return tuple(c for c in self.columns if c.dropped is None)

    def newest_day(self) -> Optional[dt.date]:
        known = [d for d in self.days if d != NULL_DAY]
        return dt.date.fromisoformat(max(known)) if known else None

    def text(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def of(text: str) -> "Manifest":
        raw = json.loads(text)
        return Manifest(**{**raw, "columns": tuple(Column(**c) for c in raw["columns"]), "changed": tuple(raw["changed"])})


def sync_columns(known: Iterable[Column], schema: T.StructType, version: int, since: Optional[str]) -> tuple[Column, ...]:
    """The column log after a write of ``schema`` (S7): new columns are added since this version,
    missing ones dropped, types widened field by field.  A column that comes back is a new
    one: what older days still hold under its name does not show.  The order is the write's."""
    active = {c.name.lower(): c for c in known if c.dropped is None}
    out = [c for c in known if c.dropped is not None]
    current = []
    for f in schema.fields:
        before = active.pop(f.name.lower(), None)
        if isinstance(f.dataType, T.NullType):
            if before is None:
                raise ValueError(f"column {f.name!r} is NULL without a type")
            current.append(before)
        elif before is None:
            current.append(Column(f.name, _type_text(f.dataType), version, since))
        else:
            current.append(replace(before, type=_type_text(merge_types(before.data_type, f.dataType, f.name))))
    return tuple([*out, *[replace(c, dropped=version) for c in active.values()], *current])


class MartTable:
    """A mart partitioned by day, read and written by whole versions."""

    def __init__(self, spark: SparkSession, path: str, partition_col: str = "date_tz"):
        self.spark, self.path, self.partition_col = spark, path.rstrip("/"), partition_col

    # -- versions ---------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in files.names(self.spark, f"{self.path}/_versions") if n.endswith(".json") and n[0] != "."]

    def manifest(self, version: Optional[int] = None) -> Optional[Manifest]:
        """The given version, or the newest; None where there is none yet."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        return Manifest.of(files.read_text(self.spark, f"{self.path}/_versions/{version:08d}.json"))

    def newest_day(self) -> Optional[dt.date]:
        """The newest day, from the manifest; no data file or folder is listed or read."""
        m = self.manifest()
        return m.newest_day() if m else None

    # -- reading ------------------------------------------------------------------

    def read(self, first_day: Optional[dt.date] = None, days: Optional[Iterable[dt.date]] = None,
             version: Optional[int] = None) -> DataFrame:
        """One version's rows, from ``first_day`` on or of ``days`` only; other days are not
        listed.  Columns are the version's; days written before a column was added have typed
        NULLs in it."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"no version of {self.path}")
        wanted = None if days is None else {d.isoformat() for d in days}
        chosen = {d: c for d, c in m.days.items()
                  if (first_day is None or (d != NULL_DAY and d >= first_day.isoformat())) and (wanted is None or d in wanted)}
        schema = T.StructType([T.StructField(c.name, c.data_type) for c in m.active if c.name != self.partition_col])
        day = next(c for c in m.active if c.name == self.partition_col)
        if not chosen:
            empty = self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(day.name, day.data_type)]))
            return empty.select(*[c.name for c in m.active])
        paths = [f"{self.path}/{folder}/{self.partition_col}={d}" for d, (folder, _) in sorted(chosen.items())]
        full = T.StructType([*schema.fields, T.StructField(COMMIT_COL, T.StringType()), T.StructField(day.name, day.data_type)])
        df = self.spark.read.schema(full).option("basePath", self.path).parquet(*paths)
        gone = {c.name.lower() for c in m.columns if c.dropped is not None}
        out = []
        for c in m.active:
            value = F.col(f"`{c.name}`")
            if c.name.lower() in gone:
                # Files of older commits may hold the dropped column of this name.
                older = sorted({folder.split("=")[1] for folder, v in chosen.values() if v < c.added})
                value = F.when(~F.col(COMMIT_COL).isin(older), value) if older else value
            out.append(value.alias(c.name))
        return df.select(*out)

    # -- writing ------------------------------------------------------------------

    def stage(self, df: DataFrame, version: int, layout: str = "rebalance") -> tuple[str, list[str]]:
        """Write ``df`` into a new commit folder; (folder, days written).

        ``layout`` says how rows get to the files of their days: by an exchange
        (``"rebalance"``); by none, since they lie by day already (``"dealt"``); or slice of
        days by slice, from a copy written as the rows lie (``"sliced"``), so that the exchange
        of all rows is never on disk, and not beside those that ``df`` comes from.
        """
        folder = f"{COMMIT_COL}={version:08d}-{uuid.uuid4().hex[:12]}"
        for f in df.schema.fields:
            if f.metadata:
                df = df.withMetadata(f.name, {})
        kept = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NullType)]
        df = df.select(*[F.col(f"`{c}`") for c in kept])
        if layout == "sliced":
            self._write_sliced(df, f"{self.path}/{folder}")
        else:
            self._write_days(df if layout == "dealt" else df.hint("rebalance", self.partition_col), f"{self.path}/{folder}")
        prefix = f"{self.partition_col}="
        return folder, [n.removeprefix(prefix) for n in files.names(self.spark, f"{self.path}/{folder}") if n.startswith(prefix)]

    def _write_days(self, df: DataFrame, path: str) -> None:
        df.write.mode("append").option("compression", CODEC).partitionBy(self.partition_col).parquet(path)
        free_shuffles(self.spark)

    def _write_sliced(self, df: DataFrame, path: str) -> None:
        scratch = scratch_path(self.spark, "staged")
        slice_of_day = F.pmod(F.xxhash64(self.partition_col), F.lit(SLICES)).cast("int")
        try:
            df.withColumn(SLICE_COL, slice_of_day).write.option("compression", CODEC).partitionBy(SLICE_COL).parquet(scratch)
            free_shuffles(self.spark)
            slices = [n for n in files.names(self.spark, scratch) if n.startswith(f"{SLICE_COL}=")]
            if not slices:
                self._write_days(df.limit(0), path)
            for name in slices:
                rows = self.spark.read.schema(df.schema).parquet(f"{scratch}/{name}")
                self._write_days(rows.hint("rebalance", self.partition_col), path)
                files.delete(self.spark, f"{scratch}/{name}")
        finally:
            files.delete(self.spark, scratch)

    def commit(self, df: DataFrame, days: Optional[Iterable[dt.date]] = None, inputs: Optional[dict[str, int]] = None,
               notes: Optional[dict] = None, base: Optional[int] = None, fresh: bool = False,
               read_days: Iterable[dt.date] = (), layout: str = "rebalance") -> Manifest:
        """Write ``df`` and publish it as the next version.

        Days present in ``df`` replace the table's, others stay (S6).  ``days``, if given, are
        all days that this write decides: those without rows are removed.  ``fresh`` starts
        from an empty table.  ``base`` is the version that ``df`` was computed from (the
        newest by default): days that another writer changed since then must be others than
        those decided here and the ``read_days`` of this table that ``df`` comes from.
        ``layout`` is that of :meth:`stage`.
        """
        start = self.manifest(base) if base is not None else self.manifest()
        start = start or Manifest(0)
        folder, written = self.stage(df, start.version + 1, layout)
        decided = {*written, *(d.isoformat() for d in days or ())}
        touched = decided | {d.isoformat() for d in read_days}
        head = start
        while True:
            newest = self.manifest()
            if newest is not None and newest.version > head.version:
                for v in range(head.version + 1, newest.version + 1):
                    other = self.manifest(v)
                    both = sorted(touched & set(other.changed))
                    if fresh or both:
                        raise CommitConflict(f"{self.path}: version {v} changed {both or 'the table'}")
                head = newest
            version = head.version + 1
            kept = {} if fresh else {d: c for d, c in head.days.items() if d not in decided}
            since = min((d for d in written if d != NULL_DAY), default=None)
            removed = set(head.days) - set(kept)
            made = Manifest(version, {**kept, **{d: [folder, version] for d in written}},
                            sync_columns(head.columns, df.schema, version, since),
                            dict(inputs or {}), tuple(sorted({*written, *removed})), dict(notes or {}))
            try:
                files.write_once(self.spark, f"{self.path}/_versions/{version:08d}.json", made.text())
                return made
            except files.PathTaken:
                continue

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete commit folders that none of the last ``keep`` versions names and that are no
        newer than the last one (a running refresh stages newer ones); returns their names."""
        known = self.versions()[-keep:]
        used = {folder for v in known for folder, _ in self.manifest(v).days.values()}
        old = [n for n in files.names(self.spark, self.path) if n.startswith(f"{COMMIT_COL}=") and n not in used
               and known and _commit_version(n) <= known[-1]]
        for n in old:
            files.delete(self.spark, f"{self.path}/{n}")
        return old


def _commit_version(folder: str) -> int:
    return int(folder.split("=")[1].split("-")[0])


def consistent_versions(source: MartTable, name: str, derived: dict[str, MartTable]) -> Optional[dict[str, int]]:
    """The newest versions that belong together: one of ``source`` and, for each derived table,
    its newest version built from that one.  None while there is no such version."""
    for version in reversed(source.versions()):
        found = {name: version}
        for other, table in derived.items():
            match = next((v for v in reversed(table.versions()) if table.manifest(v).inputs.get(name) == version), None)
            if match is None:
                break
            found[other] = match
        else:
            return found
    return None
