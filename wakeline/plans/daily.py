"""The run from bronze to gold, for one day, some days or everything.

What a run does is the same for any number of days: one job per layer over all of
them. Voyages and vessel metadata rest on all days, so each day leaves a small
mergeable table (voyage fragments, vessel descriptions), and what they make together
(voyage summaries, best descriptions) is kept too. A run takes off what its days were
and adds what they are, for the vessels that they changed, so it reads and writes no
more after years than after weeks; see :mod:`wakeline.plans.upkeep`. A small table of
the calendar days that each source date's positions fall on tells which silver
partitions a day concerns; no other is opened. Partitions are replaced by the dates
asked for, so a date that lost its rows loses its partitions, and re-running a day
gives the same tables as a complete rebuild. Partitions without a changed row keep
their files.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.operators.clean import build_silver
from wakeline.operators.gold import daily_activity, route_metrics, vessel_descriptions
from wakeline.operators.quality import SUITES, require_passed
from wakeline.operators.tracks import VESSEL
from wakeline.operators.voyages import voyage_fragments
from wakeline.plans.metrics import track_stage
from wakeline.plans.upkeep import Descriptions, Voyages, counted, rows_seen, write_counted
from wakeline.rules import VoyageRules
from wakeline.schema import TABLES
from wakeline.sources.ingest import ingest_pending
from wakeline.sources.jdbc import Database, load_gold_tables
from wakeline.sources.tables import (
    GOLD_TABLES,
    layer_path,
    path_exists,
    read_bronze,
    read_positions,
    read_table,
    state_path,
)

log = logging.getLogger(__name__)

Suite = Callable[[DataFrame], DataFrame]


def run_day(spark: SparkSession, root: str, source_date: str, **options) -> str:
    """Bring all tables up to date after one day of bronze arrived or changed."""
    return run_dates(spark, root, [source_date], **options)


def run_all(spark: SparkSession, root: str, **options) -> str:
    """Rebuild all tables from all of bronze."""
    return run_dates(spark, root, None, **options)


def run_from_raw(
    spark: SparkSession,
    raw_directory: str,
    root: str,
    file_limit: int | None = None,
    **options,
) -> str | None:
    """Load pending raw files, then run the days that came with them."""
    run_id = options.pop("run_id", None) or new_run_id()
    with track_stage(spark, state_path(root, "stage_metrics"), run_id, "raw_to_bronze") as metric:
        attempts = ingest_pending(spark, raw_directory, root, file_limit)
        loaded = attempts.where(F.col("status") == "success")
        per_date = loaded.groupBy("source_date").agg(F.sum("row_count").alias("rows")).collect()
        metric.input_rows = metric.output_rows = sum(row["rows"] for row in per_date)
    dates = sorted(row["source_date"] for row in per_date)
    return run_dates(spark, root, dates, run_id=run_id, **options) if dates else None


def new_run_id() -> str:
    return dt.datetime.now(dt.UTC).strftime("%Y%m%d_%H%M%S_") + uuid.uuid4().hex[:6]


def run_dates(
    spark: SparkSession,
    root: str,
    source_dates: Sequence[str] | None,
    rules: VoyageRules = VoyageRules(),
    per_day: bool = False,
    gate: bool = True,
    suites: Mapping[str, Suite] = SUITES,
    database: Database | None = None,
    run_id: str | None = None,
) -> str:
    """Bronze to gold for the given source dates, or all; returns the run's id.

    With ``gate`` a layer that has a quality suite is checked in a staging place
    and only then published; a failing suite raises and leaves the table as it
    was. ``per_day`` cuts voyages at the ends of each daily file. A serving load
    that fails, or that no database is given for, is recorded with its reason and
    does not undo the run.
    """
    run_id = run_id or new_run_id()
    metrics = state_path(root, "stage_metrics")
    stage = partial(track_stage, spark, metrics, run_id)
    publish = partial(_publish, spark, root, suites if gate else {})
    keys = ("mmsi", "source_date") if per_day else VESSEL
    rebuild = source_dates is None

    with stage("bronze_to_silver") as metric:
        bronze = _of_dates(read_bronze(spark, root), source_dates)
        if gate and "bronze" in suites:
            require_passed(suites["bronze"](bronze))
        before = set() if rebuild else _event_days(spark, root, source_dates)
        silver, read = counted(bronze)
        requested = None if rebuild else [(d,) for d in source_dates]
        metric.output_rows = publish("vessel_positions", build_silver(silver), requested)
        metric.input_rows = rows_seen(read)
        _record_event_days(spark, root, source_dates)

    days = None
    positions = read_positions(spark, root)
    if not rebuild:
        touched = before | _event_days(spark, root, source_dates)
        days = [(day,) for day in sorted(touched)]
        positions = _on_event_days(spark, root, positions, touched)

    with stage("silver_to_activity") as metric:
        source, read = counted(positions)
        metric.output_rows = publish("vessel_daily_activity", daily_activity(source), days)
        metric.input_rows = rows_seen(read)

    starts = None
    with stage("silver_to_voyages") as metric:
        upkeep = Voyages(spark, root, rules, keys, run_id, partial(publish, "voyage_candidates"))
        fresh = rebuild or not upkeep.ready()
        source, read = counted(read_positions(spark, root) if fresh else positions)
        fragments = voyage_fragments(source, rules, keys)
        if fresh:
            metric.output_rows = upkeep.rebuild(fragments)
        else:
            metric.output_rows, starts = upkeep.revise(fragments, touched)
        metric.input_rows = rows_seen(read)

    with stage("bronze_to_metadata") as metric:
        upkeep = Descriptions(spark, root, partial(publish, "vessel_metadata"))
        source, read = counted(bronze)
        folded = vessel_descriptions(source, ("mmsi", "source_date"))
        if rebuild or not upkeep.ready():
            metric.output_rows = upkeep.rebuild(folded, requested)
        else:
            metric.output_rows = upkeep.revise(folded, source_dates)
        metric.input_rows = rows_seen(read)

    with stage("voyages_to_routes") as metric:
        voyages = read_table(spark, root, "voyage_candidates")
        if starts is not None:
            voyages = voyages.where(F.col("start_date").isin([day for (day,) in starts]))
        source, read = counted(voyages)
        metric.output_rows = publish("route_metrics", route_metrics(source), starts)
        metric.input_rows = rows_seen(read)

    _serve(spark, root, database, partial(stage, "gold_to_database"))
    return run_id


def _serve(spark: SparkSession, root: str, database: Database | None, stage) -> None:
    try:
        with stage() as metric:
            if database is None:
                metric.status, metric.error = "skipped", "no database is configured"
                return
            tables = {table: read_table(spark, root, table) for table in GOLD_TABLES}
            rows = sum(frame.count() for frame in tables.values())
            metric.input_rows = rows
            load_gold_tables(database, tables)
            metric.output_rows = rows
    except Exception as error:  # gold is published by now and stays so
        log.warning("serving tables were not loaded: %s", error)


def _publish(
    spark: SparkSession,
    root: str,
    suites: Mapping[str, Suite],
    table: str,
    frame: DataFrame,
    requested: Sequence[Sequence] | None,
) -> int:
    """Write a table, or the requested partitions of it, by way of its quality gate."""
    schema, partitions, _ = TABLES[table]

    def check(staged: DataFrame) -> None:
        if table in suites:
            require_passed(suites[table](staged))

    return write_counted(frame.select(*schema.names), layer_path(root, table), partitions, requested, check)


def _of_dates(bronze: DataFrame, source_dates: Sequence[str] | None) -> DataFrame:
    """Rows of the given source dates, by partition columns."""
    if source_dates is None:
        return bronze
    days = [dt.date.fromisoformat(d) for d in source_dates]
    partition = F.make_date("year", "month", "day")
    return bronze.where(
        F.col("year").isin(sorted({d.year for d in days})) & partition.isin(days)
    )


def _record_event_days(
    spark: SparkSession, root: str, source_dates: Sequence[str] | None
) -> None:
    """Note the calendar days that positions of these source dates fall on."""
    positions = read_positions(spark, root)
    if source_dates is not None:
        positions = positions.where(F.col("source_date").isin(list(source_dates)))
    days = positions.select(F.to_date("event_time").alias("event_day"), "source_date").distinct()
    requested = None if source_dates is None else [(d,) for d in source_dates]
    write_counted(days, state_path(root, "event_days"), ["source_date"], requested)


def _days_table(spark: SparkSession, root: str) -> DataFrame | None:
    """``event_day, source_date``; worked out once for a lake that has positions without it."""
    path = state_path(root, "event_days")
    if not path_exists(spark, path):
        if not path_exists(spark, layer_path(root, "vessel_positions")):
            return None
        _record_event_days(spark, root, None)
    return spark.read.schema("event_day date, source_date string").parquet(path)


def _event_days(spark: SparkSession, root: str, source_dates: Sequence[str]) -> set[dt.date]:
    table = _days_table(spark, root)
    if table is None:
        return set()
    days = table.where(F.col("source_date").isin(list(source_dates)))
    return {row["event_day"] for row in days.select("event_day").distinct().collect()}


def _on_event_days(
    spark: SparkSession, root: str, positions: DataFrame, days: set[dt.date]
) -> DataFrame:
    """Positions on the given calendar days, from the source dates that have such."""
    if not days:
        return positions.where(F.col("source_date") == "")
    table = _days_table(spark, root).where(F.col("event_day").isin(list(days)))
    dates = [row["source_date"] for row in table.select("source_date").distinct().collect()]
    midnight = F.lit(min(days)).cast("timestamp_ntz")
    end = F.lit(max(days) + dt.timedelta(days=1)).cast("timestamp_ntz")
    return positions.where(
        F.col("source_date").isin(dates)
        & (F.col("event_time") >= midnight)
        & (F.col("event_time") < end)
        & F.to_date("event_time").isin(list(days))
    )
