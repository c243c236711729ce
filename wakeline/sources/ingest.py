"""Raw files into the bronze table.

A day's partition is always rebuilt from every file of that day, so loading a day
again, or after a late file, replaces it and never doubles it.
"""

from __future__ import annotations

import datetime as dt
import logging
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wakeline.functions.times import FILE_DATE, date_from_file_name, date_parts
from wakeline.sources import manifest as mf
from wakeline.sources.files import (
    BAD_LINE,
    RAW_PATTERN,
    Headers,
    discover_files,
    headers_of,
    scan_reports_flagged,
    unreadable_files,
)
from wakeline.sources.tables import (
    BRONZE_PARTITIONS,
    drop_path,
    layer_path,
    manifest_path,
    move_partitions,
    staging_path,
    state_path,
    write_full,
)

log = logging.getLogger(__name__)


def quarantine_path(root: str) -> str:
    return state_path(root, "quarantine")


def ingest_files(
    spark: SparkSession, paths: Sequence[str], root: str, headers: Headers | None = None
) -> dict[str, int]:
    """Replace the bronze partitions of all these files' days, without a shuffle.

    Returns how many rows of each file went to bronze. A day whose files have no rows is left without a partition. Lines with too many
    fields go to quarantine, by the same days. A file without a date in its name is
    an error.
    """
    dates = {path: date_in_name(path.rsplit("/", 1)[-1]) for path in paths}
    if None in dates.values():
        undated = next(path for path, date in dates.items() if date is None)
        raise ValueError(f"no date in file name: {undated}")
    requested = [(d.year, d.month, d.day) for d in sorted(set(dates.values()))]
    flagged = scan_reports_flagged(spark, paths, headers).withColumn(
        "source_date", date_from_file_name(F.col("file_name"))
    )
    parts = date_parts(F.col("source_date"))
    rows = flagged.select("*", F.col(BAD_LINE).isNotNull().alias("is_bad"), *parts)
    # one scan writes both; the lines kept out have a place of their own to be moved from
    staged = staging_path(layer_path(root, "bronze"))
    write_full(rows, staged, ["is_bad", *BRONZE_PARTITIONS])
    places = {"true": quarantine_path(root), "false": layer_path(root, "bronze")}
    # one column of what was written, and a row for each file
    written = spark.read.schema("file_name string, is_bad boolean").parquet(staged)
    counts = written.where(~F.col("is_bad")).groupBy("file_name").agg(F.count(F.lit(1))).collect()
    for is_bad, path in places.items():
        move_partitions(spark, staged, path, BRONZE_PARTITIONS, requested, f"is_bad={is_bad}")
    drop_path(spark, staged)
    return dict(map(tuple, counts))


def date_in_name(name: str) -> dt.date | None:
    """The date in a file name, if there is one in the calendar."""
    found = re.search(FILE_DATE, name)
    try:
        return dt.date.fromisoformat(found.group(1)) if found else None
    except ValueError:
        return None


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Lines kept out of bronze: ``file_name, line, source_date``."""
    schema = f"file_name string, {BAD_LINE} string, source_date string"
    lines = spark.read.schema(schema).parquet(quarantine_path(root))
    return lines.withColumnRenamed(BAD_LINE, "line")


def ingest_day(spark: SparkSession, path: str, root: str) -> None:
    """Load one daily file."""
    ingest_files(spark, [path], root)


def ingest_pending(
    spark: SparkSession,
    raw_directory: str,
    root: str,
    file_limit: int | None = None,
    pattern: str = RAW_PATTERN,
) -> DataFrame:
    """Load the files the manifest does not know as loaded; returns their attempts.

    ``file_limit`` counts pending files only. Everything pending is one job. Where that
    fails, each file is tried by itself, in one job again, and what can be read is
    loaded together: a broken file keeps only itself out. Outcomes and row counts go
    into the manifest as they are.
    """
    found = discover_files(spark, raw_directory, pattern)
    manifest = mf.read_manifest(spark, manifest_path(root))
    pending = mf.pending_files(found, manifest).orderBy("path")
    if file_limit is not None:
        pending = pending.limit(file_limit)
    # one row per pending file: a listing, not data
    return load_listed(spark, pending.collect(), found, root)


def load_listed(
    spark: SparkSession, wanted: Sequence[Row], found: DataFrame, root: str
) -> DataFrame:
    """Load these files, with the others of their days, and record how it went."""
    undated = [f for f in wanted if date_in_name(f["file_name"]) is None]
    failed = {f["file_name"]: "no date in file name" for f in undated}
    dates = sorted({f["source_date"] for f in wanted if f["file_name"] not in failed})
    files = found.where(F.col("source_date").isin(dates)).collect() if dates else []
    broken, counts = _load(spark, files, root)
    failed |= broken
    loaded = [f for f in files if f["file_name"] not in failed]
    attempts = _attempts(spark, loaded, failed, counts)
    mf.append_attempts(attempts, manifest_path(root))
    return attempts


def _load(
    spark: SparkSession, files: list[Row], root: str
) -> tuple[dict[str, str], dict[str, int]]:
    """Load files, returning the error of each that could not be, and rows by file."""
    if not files:
        return {}, {}
    paths = [f["path"] for f in files]
    headers, failed = headers_of(spark, paths)

    def load_rest() -> dict[str, int]:
        rest = [p for p in paths if p not in failed]
        return ingest_files(spark, rest, root, headers) if rest else {}

    try:
        counts = load_rest()
    except Exception as error:  # a file may be broken in any way
        log.warning("loading %d files together failed, trying each: %s", len(files), error)
        failed |= unreadable_files(spark, [p for p in paths if p not in failed])
        counts = load_rest()
    for path, error in failed.items():
        log.warning("%s could not be loaded: %s", path, error)
    return {f["file_name"]: failed[f["path"]] for f in files if f["path"] in failed}, counts


def _attempts(
    spark: SparkSession, loaded: list[Row], failed: dict[str, str], counts: dict[str, int]
) -> DataFrame:
    """What became of files, with the rows of each in bronze."""
    listing = spark.createDataFrame(
        [(f["file_name"], f["source_date"], counts.get(f["file_name"], 0)) for f in loaded],
        "file_name string, source_date string, row_count long",
    )
    errors = spark.createDataFrame(list(failed.items()), "file_name string, error string")
    # fixed here, so that what is returned is what is recorded
    rows = mf.success(listing).unionByName(mf.failure(errors)).collect()
    return spark.createDataFrame(rows, mf.MANIFEST_SCHEMA)
