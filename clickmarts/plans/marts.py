"""The marts as versioned tables: full builds, refreshes of touched days, and their spread.

A refresh of the events mart rewrites the touched days and their neighbours and publishes
one version.  The other marts remember which events version they were built from; what has
changed since is the union of the days that later versions changed.  Products follow day by
day.  Sessions follow through an impact join:

* users with an event in a changed day, in the old or the new events version;
* their sessions, and their later sessions within the last-non-direct lookback, computed
  anew from their events alone;
* days in which a row of theirs came, went or changed are rewritten, with the rows of all
  other users carried over; other days keep their files.

So late data rewrites only days that it changes.  Each step publishes atomically and knows
its input's version, hence replaying a batch, or going on after a failure between two marts,
repeats no work and leaves no mart behind.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from typing import Callable, Iterable, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmarts.config import MartConfig
from clickmarts.operators.products import by_day_and_event, products_mart
from clickmarts.operators.sliced import materialize
from clickmarts.plans.events_mart import events_mart
from clickmarts.plans.sessions_mart import sessions_mart
from clickmarts.sources.shards import SUFFIX_COL, tag_shard
from clickmarts.sources.snapshots import NULL_DAY, Manifest, MartTable, consistent_versions

EVENTS = "events"


def _around(days: Iterable[dt.date], before: int, after: Optional[int] = None) -> list[dt.date]:
    after = before if after is None else after
    return sorted({d + dt.timedelta(days=k) for d in days for k in range(-before, after + 1)})


class Marts:
    """Events, sessions and products under ``root``, kept in step.

    ``read_raw`` returns the untagged raw union with its suffix column.  Event ids are
    instant-scoped, since scan-scoped ones would change with the days read.
    ``derived`` are the marts kept in step.  ``padding_days`` is how far a session or a navigation step may reach over a day's edge.
    """

    def __init__(self, spark: SparkSession, root: str, read_raw: Callable[[], DataFrame],
                 cfg: MartConfig = MartConfig(), padding_days: int = 1, derived: tuple[str, ...] = ("sessions", "products")):
        self.derived = derived
        self.cfg = replace(cfg, id_scope="instant", rollup="narrow")
        self.spark, self.read_raw, self.padding_days = spark, read_raw, padding_days
        self.events, self.sessions, self.products = (
            MartTable(spark, f"{root.rstrip('/')}/{name}") for name in (EVENTS, "sessions", "products"))

    # -- events ---------------------------------------------------------------------

    def build(self) -> dict[str, int]:
        """All marts from all raw shards, as new versions."""
        made = self.events.commit(events_mart(tag_shard(self.read_raw()), self.cfg), fresh=True, layout="sliced")
        return self.follow() | {EVENTS: made.version}

    def refresh(self) -> dict[str, int]:
        """The late-data run: the newest day of the events mart and the days before it that
        may still change, from their manifest; a full build where there is none yet."""
        newest = self.events.newest_day()
        if newest is None:
            return self.build()
        first = newest - dt.timedelta(days=self.cfg.incremental_refresh_days)
        scan_from = (first - dt.timedelta(days=self.padding_days)).strftime("%Y%m%d")
        raw = self.read_raw().where(F.right(F.col(SUFFIX_COL), F.lit(8)) >= F.lit(scan_from))
        mart = events_mart(tag_shard(raw), self.cfg).where(F.col("date_tz") >= F.lit(first))
        made = self.events.commit(mart, days=_around([first], 0, self.cfg.incremental_refresh_days))
        return self.follow() | {EVENTS: made.version}

    def rewrite_days(self, days: Iterable[dt.date], notes: Optional[dict] = None) -> Manifest:
        """The events of ``days`` and of ``padding_days`` around them, from their raw shards."""
        days = sorted(set(days))
        rewritten = _around(days, self.padding_days)
        wanted = [d.strftime("%Y%m%d") for d in _around(days, 2 * self.padding_days)]
        raw = self.read_raw().where(F.right(F.col(SUFFIX_COL), F.lit(8)).isin(*wanted))
        mart = events_mart(tag_shard(raw), self.cfg).where(F.col("date_tz").isin(*rewritten))
        return self.events.commit(mart, days=rewritten, notes=notes)

    # -- what follows from it ------------------------------------------------------------

    def _behind(self, table: MartTable) -> tuple[Optional[Manifest], int, Optional[set[str]]]:
        """(table's manifest, events version to reach, days changed since; None: everything)."""
        mine, newest = table.manifest(), self.events.manifest().version
        if mine is None:
            return None, newest, None
        changed: set[str] = set()
        for v in range(mine.inputs[EVENTS] + 1, newest + 1):
            changed |= set(self.events.manifest(v).changed)
        return mine, newest, changed

    def follow(self) -> dict[str, int]:
        """Bring the derived marts to the newest events version; their versions."""
        steps = {"sessions": self._follow_sessions, "products": self._follow_products}
        return {name: steps[name]().version for name in self.derived}

    def _follow_products(self) -> Manifest:
        mine, version, changed = self._behind(self.products)
        if mine is not None and mine.inputs[EVENTS] == version:
            return mine
        days = None if changed is None else [dt.date.fromisoformat(d) for d in changed if d != NULL_DAY]
        mart = products_mart(by_day_and_event(self.events.read(days=days, version=version)), self.cfg.not_set)
        return self.products.commit(mart, days=days, inputs={EVENTS: version}, base=mine and mine.version, layout="dealt")

    def _follow_sessions(self) -> Manifest:
        mine, version, changed = self._behind(self.sessions)
        if mine is not None and mine.inputs[EVENTS] == version:
            return mine
        if changed is None:
            return self.sessions.commit(sessions_mart(self.events.read(version=version), self.cfg), inputs={EVENTS: version})
        dirty = [dt.date.fromisoformat(d) for d in changed if d != NULL_DAY]
        if not dirty:
            return self.sessions.commit(self.sessions.read(days=()), days=(), inputs={EVENTS: version}, base=mine.version)
        before, after = self.events.read(days=dirty, version=mine.inputs[EVENTS]), self.events.read(days=dirty, version=version)
        users = before.select("user_pseudo_id").union(after.select("user_pseudo_id")).distinct()
        # The lookback accepts up to that many whole days, just under one day more by the
        # clock, and a session may reach over the edge of a day.
        reach = (self.cfg.last_non_direct_lookback or 0) + 1 + self.padding_days
        first, last = min(dirty) - dt.timedelta(days=self.padding_days), max(dirty) + dt.timedelta(days=reach)
        if self.cfg.last_non_direct_lookback is None:
            last = max(self.events.manifest(version).newest_day(), max(dirty))
            read_from = None
        else:
            read_from = first - dt.timedelta(days=reach)
        known = self.events.read(first_day=read_from, version=version).where(F.col("date_tz") <= F.lit(last + dt.timedelta(days=self.padding_days)))
        anew = sessions_mart(known.join(users, "user_pseudo_id", "left_semi"), self.cfg)
        # Compared with the old rows and then written: computed once.
        anew = materialize(anew.where(F.col("date_tz").between(F.lit(first), F.lit(last))), "sessions-anew")
        span = [d for d in map(dt.date.fromisoformat, (x for x in mine.days if x != NULL_DAY)) if first <= d <= last]
        held = self.sessions.read(days=span, version=mine.version)
        theirs = held.join(users, "user_pseudo_id", "left_semi")
        days = sorted(r[0] for r in _changed_days(theirs, anew).collect())
        kept = self.sessions.read(days=days, version=mine.version).join(users, "user_pseudo_id", "left_anti")
        mart = kept.unionByName(anew.where(F.col("date_tz").isin(*days)) if days else anew.limit(0))
        return self.sessions.commit(mart.select(*anew.columns), days=days, inputs={EVENTS: version}, base=mine.version, read_days=span)

    # -- batches -----------------------------------------------------------------------

    def apply_batch(self, batch: DataFrame, batch_id: int, stream: str = "raw") -> None:
        """For ``foreachBatch``: the days of newly landed shards, through all marts, once.

        The events version of a batch carries its stream, number and days, and appears
        together with its data.  A replayed batch finds it and only lets the other marts
        catch up, from whatever step a failure had left."""
        if not self.applied(stream, batch_id):
            days = [r[0] for r in tag_shard(batch).select("date_tz").distinct().collect() if r[0] is not None]
            if not days:
                return
            self.rewrite_days(days, {"stream": stream, "batch": batch_id, "days": sorted(d.isoformat() for d in days)})
        if self.events.manifest() is not None:
            self.follow()

    def applied(self, stream: str, batch_id: int) -> bool:
        """Whether an events version has this batch, or a later one, of the stream."""
        for v in reversed(self.events.versions()):
            notes = self.events.manifest(v).notes
            if notes.get("stream") == stream:
                return notes["batch"] >= batch_id
        return False

    def ledger(self) -> list[dict]:
        """One entry per batch: its stream, number, days, and which marts have it."""
        reached = {name: m.inputs[EVENTS] if (m := t.manifest()) else 0
                   for name, t in self._derived_tables().items()}
        out = []
        for v in self.events.versions():
            notes = self.events.manifest(v).notes
            if "batch" in notes:
                done = [name for name, at in reached.items() if at >= v]
                out.append({**notes, "version": v, "state": "done" if len(done) == len(reached) else "events", "marts": [EVENTS, *done]})
        return out

    def together(self) -> Optional[dict[str, int]]:
        """Newest versions of the marts that belong to one events version."""
        return consistent_versions(self.events, EVENTS, self._derived_tables())

    def _derived_tables(self) -> dict[str, MartTable]:
        return {name: getattr(self, name) for name in self.derived}


def _changed_days(old: DataFrame, new: DataFrame) -> DataFrame:
    """Days in which a row of ``old`` or ``new`` has no equal in the other, as often."""
    columns = [F.col(f"`{c}`") for c in new.columns]
    rows = [df.select("date_tz", F.xxhash64(*columns).alias("h1"), F.hash(*columns).alias("h2"), F.lit(sign).alias("n"))
            for df, sign in ((old, -1), (new, 1))]
    return (rows[0].union(rows[1]).groupBy("date_tz", "h1", "h2").agg(F.sum("n").alias("n"))
            .where("n <> 0 and date_tz is not null").select("date_tz").distinct())
