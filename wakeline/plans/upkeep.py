"""Gold tables that rest on all days, kept up to date by what a day changes.

Voyages: a day's fragments are compared with those it had. The vessels that differ have
their voyages near the day worked out again from a few days around it; what a voyage has
farther off is its stored summary less the fragments near the day. Metadata: a vessel's best
description is the greater of the one it has and the day's; only where the best one came
from the day and is gone are the vessel's other days read.

A note of the run that is at work lies beside the voyages' state until it is done. A run that
finds another's, left by one that broke off, or its own replaced by one that worked at the same
time, rebuilds the voyages from all fragments instead of trusting the state.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wakeline.operators.gold import best_descriptions, described
from wakeline.operators.voyages import margin_days, revised_summaries, voyage_summaries, voyages_of
from wakeline.rules import VoyageRules
from wakeline.sources.tables import (
    drop_path,
    path_exists,
    read_table,
    replace_partitions,
    replace_table,
    staging_path,
    state_path,
)

log = logging.getLogger(__name__)

#: Writes a gold table, or the given partitions of it, and tells the number of rows.
Publish = Callable[[DataFrame, Sequence[Sequence] | None], int]
#: Times that a run rebuilds the voyages because others worked on them meanwhile.
TRIES = 3


def counted(frame: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and the number of its rows once it is written."""
    seen = Observation()
    return frame.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rows_seen(seen: Observation) -> int:
    """The number of rows seen; what Spark finds empty before it runs has no observation."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return 0


def write_counted(
    frame: DataFrame,
    path: str,
    partitions: list[str],
    requested: Sequence[Sequence] | None,
    check: Callable[[DataFrame], None] | None = None,
) -> int:
    """Write and count in the same job."""
    out, seen = counted(frame)
    if partitions and (requested is None or len(requested) > 1):
        # gathers a partition's rows in few files, and splits one that is too large
        out = out.hint("rebalance", *[F.col(c) for c in partitions])
    if requested is None or not partitions:
        replace_table(out, path, partitions, check)
    else:
        replace_partitions(out, path, partitions, requested, check)
    return rows_seen(seen)


class _Staged:
    """Frames written to a place of their own until the run is done with them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.number = spark, staging_path(path), 0

    def keep(self, frame: DataFrame) -> DataFrame:
        self.number += 1
        path = f"{self.path}/{self.number}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self) -> None:
        drop_path(self.spark, self.path)


def _difference(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows gone and rows added."""
    new = new.select(*old.columns)
    return old.exceptAll(new), new.exceptAll(old)


class Voyages:
    """Fragments by day, summaries by the day they end, and the voyages published of them."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        rules: VoyageRules,
        keys: Sequence[str],
        run_id: str,
        publish: Publish,
    ):
        self.spark, self.root, self.rules, self.keys = spark, root, rules, list(keys)
        self.run_id, self.publish = run_id, publish
        # fragments are cut by a gap, so each gap has tables of its own
        cut = f"{'by_file_' if len(self.keys) > 1 else ''}{rules.gap_seconds:g}s"
        self.fragments = state_path(root, f"voyage_fragments_{cut}")
        self.summaries = state_path(root, f"voyage_summaries_{cut}")
        self.note = state_path(root, "voyage_note")
        self.made_by = f"{cut} {rules}"

    def ready(self) -> bool:
        """Whether state and voyages are those of a whole run under the same rules."""
        note = self._read_note()
        return note == (self.made_by, "") and path_exists(self.spark, self.summaries)

    def _read_note(self) -> tuple[str, str] | None:
        if not path_exists(self.spark, self.note):
            return None
        row = self.spark.read.schema("made_by string, run string").parquet(self.note).first()
        return row and tuple(row)

    def _write_note(self, run: str) -> None:
        row = self.spark.createDataFrame([(self.made_by, run)], "made_by string, run string")
        row.coalesce(1).write.mode("overwrite").parquet(self.note)

    def rebuild(self, fragments: DataFrame) -> int:
        """Everything from fragments of all days."""
        self._write_note(self.run_id)
        write_counted(fragments, self.fragments, ["track_date"], None)
        self.schema = fragments.schema
        return self._from_fragments()

    def _read_fragments(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.fragments)

    def _from_fragments(self) -> int:
        summaries = voyage_summaries(self._read_fragments(), self.rules, self.keys)
        for _ in range(TRIES):
            self._write_note(self.run_id)
            write_counted(_dated(summaries), self.summaries, ["end_date"], None)
            stored = self.spark.read.schema(_dated(summaries).schema).parquet(self.summaries)
            rows = self.publish(voyages_of(stored, self.rules), None)
            if self._read_note() == (self.made_by, self.run_id):
                self._write_note("")
                return rows
            log.warning("another run worked on voyages meanwhile; they are rebuilt")
        raise RuntimeError("other runs keep working on the voyages; run this one again")

    def revise(self, fragments: DataFrame, days: Iterable[dt.date]) -> tuple[int, list[tuple] | None]:
        """Bring in the fragments of some days.

        Returns the rows written and the start dates of changed voyages, None for all.
        """
        self._write_note(self.run_id)
        self.schema = fragments.schema
        staged, rows, starts = _Staged(self.spark, self.fragments), 0, set()
        try:
            new = staged.keep(fragments)
            for group in _near(sorted(days), 2 * margin_days(self.rules)):
                written, changed = self._revise(new, group, staged)
                rows, starts = rows + written, starts | set(changed)
        finally:
            staged.drop()
        if self._read_note() != (self.made_by, self.run_id):
            log.warning("another run worked on voyages meanwhile; they are rebuilt")
            return self._from_fragments(), None
        self._write_note("")
        return rows, sorted(starts)

    def _revise(self, new: DataFrame, days: list[dt.date], staged: _Staged) -> tuple[int, list[tuple]]:
        on_days = F.col("track_date").isin(days)
        every, new = self._read_fragments(), new.where(on_days)
        gone, added = _difference(every.where(on_days), new)
        vessels = staged.keep(gone.select(*self.keys).union(added.select(*self.keys)).distinct())
        if vessels.isEmpty():
            return 0, []
        margin = dt.timedelta(days=margin_days(self.rules))
        first, last = days[0] - margin, days[-1] + margin
        before = staged.keep(
            every.where(F.col("track_date").between(F.lit(first), F.lit(last))).join(vessels, self.keys, "left_semi")
        )
        now = before.where(~on_days).unionByName(new.join(vessels, self.keys, "left_semi"))
        stored = self.spark.read.schema(_dated(voyage_summaries(every)).schema).parquet(self.summaries)
        touching = (F.col("end_date") >= F.lit(first)) & (
            F.col("start_time") < F.lit(last + dt.timedelta(days=1)).cast("timestamp_ntz")
        )
        known = staged.keep(stored.where(touching).join(vessels, self.keys, "left_semi").drop("end_date"))

        def far(day: dt.date) -> DataFrame:
            return every.where((F.col("track_date") >= F.lit(day)) & (F.col("track_date") < F.lit(first)))

        revised = revised_summaries(now, before, known, first, last, far, self.rules, self.keys)
        gone, added = (staged.keep(x) for x in _difference(known, staged.keep(revised)))

        def published(rows: DataFrame) -> DataFrame:
            return voyages_of(rows, self.rules)

        voyages = read_table(self.spark, self.root, "voyage_candidates")
        rows, starts = _exchange(voyages, published(gone), published(added), "start_date", self.publish)
        _exchange(
            stored,
            _dated(gone),
            _dated(added),
            "end_date",
            lambda frame, dates: write_counted(frame, self.summaries, ["end_date"], dates),
        )
        write_counted(new, self.fragments, ["track_date"], [(day,) for day in days])
        return rows, starts


def _dated(summaries: DataFrame) -> DataFrame:
    return summaries.withColumn("end_date", F.to_date("end_time"))


def _near(days: list[dt.date], apart: int) -> list[list[dt.date]]:
    """Days in groups that stand more than some days apart."""
    groups: list[list[dt.date]] = []
    for day in days:
        if groups and (day - groups[-1][-1]).days <= apart:
            groups[-1].append(day)
        else:
            groups.append([day])
    return groups


def _exchange(
    table: DataFrame, gone: DataFrame, added: DataFrame, date: str, write: Publish
) -> tuple[int, list[tuple]]:
    """Take rows from a table and add others, in the partitions that have any of them."""
    gone, added = gone.select(*table.columns), added.select(*table.columns)
    # rows may stay as they are in a table that shows less than what changed
    less, more = _difference(gone, added)
    # one row for each partition
    dates = sorted(tuple(r) for r in less.union(more).select(date).distinct().collect())
    if not dates:
        return 0, []
    own = F.col(date).isin([day for (day,) in dates])
    return write(table.where(own).exceptAll(gone).unionByName(added), dates), dates


class Descriptions:
    """Descriptions of vessels by source date, the best of each vessel, and the metadata of them."""

    def __init__(self, spark: SparkSession, root: str, publish: Publish):
        self.spark, self.publish = spark, publish
        self.days, self.best = state_path(root, "vessel_descriptions"), state_path(root, "vessel_best")

    def ready(self) -> bool:
        return path_exists(self.spark, self.days) and path_exists(self.spark, self.best)

    def _read(self, schema, path: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)

    def rebuild(self, folded: DataFrame, requested: Sequence[Sequence] | None) -> int:
        """The best of all days, the given ones, or all, written anew."""
        write_counted(folded, self.days, ["source_date"], requested if path_exists(self.spark, self.days) else None)
        return self._publish(best_descriptions(self._read(folded.schema, self.days)))

    def _publish(self, best: DataFrame) -> int:
        replace_table(best, self.best)
        return self.publish(described(self._read(best.schema, self.best)), None)

    def revise(self, folded: DataFrame, source_dates: Sequence[str]) -> int:
        """Bring in some days' descriptions: of the vessels in them, and of a row for each other vessel."""
        staged = _Staged(self.spark, self.days)
        try:
            on_days = F.col("source_date").isin(list(source_dates))
            every, new = self._read(folded.schema, self.days), staged.keep(folded)
            was = best_descriptions(every.where(on_days)).withColumnRenamed("best", "was")
            now = best_descriptions(new).withColumnRenamed("best", "now")
            best = self._read(best_descriptions(every).schema, self.best)
            both = staged.keep(best.join(was, "mmsi", "full").join(now, "mmsi", "full"))
            # what was best came from these days and is not sent any more
            lost = F.col("was").isNotNull() & (F.col("was") >= F.col("best"))
            lost &= F.col("now").isNull() | (F.col("now") < F.col("was"))
            write_counted(new, self.days, ["source_date"], [(d,) for d in source_dates])
            lost_vessels = both.where(lost).select("mmsi")
            kept = both.where(~F.coalesce(lost, F.lit(False)))
            best = kept.select("mmsi", F.greatest("best", "now").alias("best"))
            if not lost_vessels.isEmpty():
                again = self._read(folded.schema, self.days).join(lost_vessels, "mmsi", "left_semi")
                best = best.unionByName(best_descriptions(again))
            return self._publish(best)
        finally:
            staged.drop()
