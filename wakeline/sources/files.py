"""Raw daily files: zstd-compressed CSV, read in place by Spark.

A compressed file is one task, so parallelism comes from reading many files in
one job. Columns are bound by header name: files are grouped by their header, which
one distributed job reads from the first bytes of each, and each group is one scan.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions.times import date_from_file_name
from wakeline.operators.clean import cast_columns
from wakeline.schema import LEGACY_NAMES, REPORT_SCHEMA

RAW_PATTERN = "ais-*.csv.zst"
BAD_LINE = "bad_line"
#: Files by the names in their header.
Headers = dict[tuple[str, ...], list[str]]
#: Files that a task looks at, and the most tasks.
FILES_A_TASK, PROBE_TASKS = 8, 400
_TYPES = {f.name: f.dataType.simpleString() for f in REPORT_SCHEMA.fields}


def discover_files(
    spark: SparkSession, directory: str, pattern: str = RAW_PATTERN
) -> DataFrame:
    """Path, name, size and source date of the raw files, in order; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        "path",
        name.alias("file_name"),
        F.col("length").alias("size_bytes"),
        date_from_file_name(name).alias("source_date"),
    ).orderBy("path")


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of a file, from its first line only."""
    return tuple(spark.read.option("header", True).csv(path).columns)


def headers_of(spark: SparkSession, paths: Sequence[str]) -> tuple[Headers, dict[str, str]]:
    """Files by header, and the errors of files that have none to read.

    Tasks open the files themselves, read the first bytes and stop. What they cannot
    open, such as a folder or a store only Spark reaches, Spark looks into one by one.
    """
    groups: Headers = defaultdict(list)
    failed: dict[str, str] = {}
    look = _probe(spark, paths, "first line")
    for path, (line, error) in look.items():
        if error is None:
            groups[tuple(next(csv.reader([line]), ()))].append(path)
    rest = [path for path in paths if look[path][1] is not None]
    for path, header in _each(lambda p: header_of(spark, p), rest):
        if isinstance(header, Exception):
            failed[path] = str(header)
        else:
            groups[header].append(path)
    return dict(groups), failed


def unreadable_files(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Errors of the files that cannot be read to their end, each tried by itself."""
    tried = _probe(spark, paths, "whole file")
    rest = [path for path in paths if tried[path][1] is not None]

    def read(path: str) -> None:
        spark.read.text(path).write.format("noop").mode("overwrite").save()

    return {path: str(error) for path, error in _each(read, rest) if isinstance(error, Exception)}


def _each(action: Callable, paths: Sequence[str], threads: int = 16) -> list[tuple]:
    """Every path with what the action gave or raised."""

    def attempt(path: str):
        try:
            return action(path)
        except Exception as error:  # a file may be broken in any way
            return error

    with ThreadPoolExecutor(threads) as pool:
        return list(zip(paths, pool.map(attempt, paths)))


def _probe(spark: SparkSession, paths: Sequence[str], what: str) -> dict[str, tuple]:
    """First line and error of every file, from one job."""

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        def first_line(path: str) -> str:
            system, at = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
            with system.open_input_stream(at) as stream:
                start = b""
                while b"\n" not in start and (more := stream.read(1 << 14)):
                    start += more
                while what == "whole file" and stream.read(1 << 20):
                    pass
            return start.split(b"\n", 1)[0].decode("utf-8-sig", "replace").rstrip("\r")

        for frame in frames:
            lines, errors = [], []
            for path in frame["path"]:
                try:
                    line, error = first_line(path), None
                except Exception as failure:  # a file may be broken in any way
                    line, error = None, str(failure)
                lines.append(line)
                errors.append(error)
            yield frame.assign(line=lines, error=errors).astype(object)

    if not paths:
        return {}
    listing = spark.createDataFrame([(p,) for p in paths], "path string")
    parts = listing.repartition(min(-(-len(paths) // FILES_A_TASK), PROBE_TASKS))
    # one row per new file: a listing, not data
    rows = parts.mapInPandas(look, "path string, line string, error string").collect()
    return {row["path"]: (row["line"], row["error"]) for row in rows}


def scan_reports(
    spark: SparkSession, paths: str | Sequence[str], headers: Headers | None = None
) -> DataFrame:
    """Typed reports of one or many files, with ``file_name``.

    A value that does not fit its type is null, a line with too few fields is
    padded, and fields beyond the header are dropped.
    """
    return _typed(_scan_lines(spark, paths, headers))


def scan_reports_flagged(
    spark: SparkSession, paths: str | Sequence[str], headers: Headers | None = None
) -> DataFrame:
    """Typed reports, with ``bad_line`` set on lines that have too many fields.

    Bytes that are not UTF-8 are taken out of the text columns.
    """
    return _typed(_without_broken_bytes(_scan_lines(spark, paths, headers, keep_bad=True)))


def scan_reports_quarantine(
    spark: SparkSession, paths: str | Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Typed reports, and the lines kept out of them: those with too many fields."""
    flagged = scan_reports_flagged(spark, paths)
    bad = F.col(BAD_LINE).isNotNull()
    quarantined = flagged.where(bad).select("file_name", F.col(BAD_LINE).alias("line"))
    return flagged.where(~bad).drop(BAD_LINE), quarantined


def scan_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A file with the types its values suggest, which takes a pass of its own."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def sample_head(spark: SparkSession, path: str, rows: int = 10_000) -> DataFrame:
    """The first rows of a file as they are, for inspection."""
    return scan_inferred(spark, path).limit(rows)


def _scan_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    headers: Headers | None = None,
    keep_bad: bool = False,
) -> DataFrame:
    """All files as text columns under the current names."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if headers is None:
        headers, failed = headers_of(spark, paths)
        if failed:
            raise OSError(f"cannot read {len(failed)} files: {failed}")
    chosen = set(paths)
    groups = {h: [p for p in files if p in chosen] for h, files in headers.items() if h}
    scans = [_scan_group(spark, h, files, keep_bad) for h, files in groups.items() if files]
    if not scans:
        names = [*REPORT_SCHEMA.names, *([BAD_LINE] if keep_bad else []), "file_name"]
        return spark.createDataFrame([], ", ".join(f"{n} string" for n in names))
    return reduce(DataFrame.unionByName, scans)


def _scan_group(
    spark: SparkSession, header: tuple[str, ...], files: list[str], keep_bad: bool
) -> DataFrame:
    names = [LEGACY_NAMES.get(name.strip(), name.strip()) for name in header]
    malformed = "_malformed"
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    fields = list(names)
    if keep_bad:
        # fields are only counted when every column is parsed
        reader = reader.option("columnNameOfCorruptRecord", malformed)
        reader = reader.option("columnPruning", False)
        fields.append(malformed)
    lines = reader.schema(", ".join(f"`{f}` string" for f in fields)).csv(files)
    columns = [
        F.col(n) if n in names else F.lit(None).cast("string").alias(n)
        for n in REPORT_SCHEMA.names
    ]
    if keep_bad:
        # Spark refuses a query that needs nothing but the malformed line, so the
        # first field always takes part
        parsed = F.length(F.coalesce(F.col(names[0]), F.lit(""))) >= 0
        surplus = parsed & (_field_count(F.col(malformed)) > len(names))
        columns.append(F.when(surplus, F.col(malformed)).alias(BAD_LINE))
    return lines.select(*columns, F.col("_metadata.file_name").alias("file_name"))


def _field_count(line: Column) -> Column:
    """Fields of a CSV line; commas inside quotes do not count."""
    return F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), ",", -1))


def _typed(lines: DataFrame) -> DataFrame:
    return cast_columns(lines, {n: t for n, t in _TYPES.items() if t != "string"})


def _without_broken_bytes(lines: DataFrame) -> DataFrame:
    broken = "\ufffd"  # what the decoder puts in place of a byte it cannot read
    texts = [n for n, t in _TYPES.items() if t == "string"]
    return lines.withColumns({n: F.replace(F.col(n), F.lit(broken), F.lit("")) for n in texts})
