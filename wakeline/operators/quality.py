"""Data-quality checks, column profiles and key checks.

All checks of a frame are aggregate expressions of one aggregation, so a suite
reads its input once however many checks it has.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.rules import CleaningRules
from wakeline.schema import TABLES

_RULES = CleaningRules()


@dataclass(frozen=True)
class Check:
    """A named rule over a whole frame.

    ``measures`` are its aggregates; ``verdict`` turns the total row count and
    the measured values into (passed, detail).
    """

    name: str
    measures: tuple[Column, ...]
    verdict: Callable[[Column, list[Column]], tuple[Column, Column]]


def _fixed(rate: Column) -> Column:
    return F.format_string("%.4f", rate)


def row_count(min_rows: int) -> Check:
    def verdict(total: Column, _: list[Column]):
        detail = F.concat(
            F.lit("rows="), total.cast("string"), F.lit(f", min_required={min_rows}")
        )
        return total >= min_rows, detail

    return Check("row_count", (), verdict)


def null_rate(column: str, max_rate: float) -> Check:
    def verdict(total: Column, measured: list[Column]):
        rate = F.try_divide(measured[0], total)
        detail = F.concat(
            F.lit("null_rate="), _fixed(rate), F.lit(f", max_allowed={float(max_rate)}")
        )
        return _unless_empty(total, rate <= float(max_rate), detail)

    return Check(f"null_rate_{column}", (F.count_if(F.col(column).isNull()),), verdict)


def duplicate_rate(keys: Sequence[str], max_rate: float) -> Check:
    """A key of nulls is a key like any other."""

    def verdict(total: Column, measured: list[Column]):
        rate = F.lit(1.0) - F.try_divide(measured[0], total)
        detail = F.concat(
            F.lit("dup_rate="), _fixed(rate), F.lit(f", max_allowed={float(max_rate)}")
        )
        return _unless_empty(total, rate <= float(max_rate), detail)

    return Check(
        f"duplicate_rate_{'_'.join(keys)}", (F.countDistinct(F.struct(*keys)),), verdict
    )


def value_range(column: str, low: float, high: float) -> Check:
    def verdict(_: Column, measured: list[Column]):
        detail = F.concat(
            F.lit("out_of_range="),
            measured[0].cast("string"),
            F.lit(f", expected=[{low}, {high}]"),
        )
        return measured[0] == 0, detail

    value = F.col(column)
    return Check(f"range_{column}", (F.count_if((value < low) | (value > high)),), verdict)


def completeness(frame_columns: Sequence[str], required: Sequence[str]) -> Check:
    """Known when the plan is built; no data is read for it."""
    missing = [name for name in required if name not in frame_columns]
    text = f"missing_columns={missing}" if missing else "all required columns present"

    def verdict(_total: Column, _measured: list[Column]):
        return F.lit(not missing), F.lit(text)

    return Check("schema_completeness", (), verdict)


def _unless_empty(total: Column, passed: Column, detail: Column) -> tuple[Column, Column]:
    return (
        F.coalesce(passed, F.lit(False)),
        F.when(total == 0, F.lit("empty DataFrame")).otherwise(detail),
    )


def run_checks(frame: DataFrame, stage: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check: stage, total_rows, check_no, name, passed, detail."""
    aggregates = [F.count(F.lit(1)).alias("total_rows")]
    places: list[list[str]] = []
    for i, check in enumerate(checks):
        names = [f"_m{i}_{j}" for j in range(len(check.measures))]
        aggregates += [m.alias(name) for m, name in zip(check.measures, names)]
        places.append(names)
    measured = frame.agg(*aggregates)
    rows = []
    for i, (check, names) in enumerate(zip(checks, places)):
        passed, detail = check.verdict(F.col("total_rows"), [F.col(n) for n in names])
        rows.append(
            F.struct(
                F.lit(i + 1).alias("check_no"),
                F.lit(check.name).alias("name"),
                passed.alias("passed"),
                detail.alias("detail"),
            )
        )
    return measured.select(
        F.lit(stage).alias("stage"), "total_rows", F.inline(F.array(*rows))
    )


def bronze_suite(frame: DataFrame) -> DataFrame:
    required = ["mmsi", "base_date_time", "latitude", "longitude", "sog"]
    checks = [row_count(1000), completeness(frame.columns, required)]
    checks += [
        null_rate(name, rate)
        for name, rate in (("mmsi", 0.01), ("latitude", 0.05))
        if name in frame.columns
    ]
    return run_checks(frame, "bronze", checks)


def silver_suite(frame: DataFrame) -> DataFrame:
    return run_checks(
        frame,
        "silver",
        [
            row_count(1000),
            null_rate("mmsi", 0.0),
            null_rate("event_time", 0.0),
            duplicate_rate(["mmsi", "event_time"], 0.0),
            value_range("latitude", _RULES.latitude_min, _RULES.latitude_max),
            value_range("longitude", _RULES.longitude_min, _RULES.longitude_max),
            value_range("sog", 0, _RULES.sog_unavailable),
        ],
    )


def activity_suite(frame: DataFrame) -> DataFrame:
    return run_checks(
        frame,
        "gold_activity",
        [
            row_count(100),
            null_rate("mmsi", 0.0),
            null_rate("activity_date", 0.0),
            value_range("point_count", 1, 100_000),
        ],
    )


SUITES = {
    "bronze": bronze_suite,
    "vessel_positions": silver_suite,
    "vessel_daily_activity": activity_suite,
}


def quality_summary(checks: DataFrame) -> DataFrame:
    """One row per stage: checks run, passed and failed, and the overall verdict."""
    return checks.groupBy("stage").agg(
        F.max("total_rows").alias("total_rows"),
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(~F.col("passed")).alias("checks_failed"),
        F.every("passed").alias("overall_passed"),
    )


class QualityError(RuntimeError):
    """A layer did not pass its checks."""


def require_passed(checks: DataFrame) -> DataFrame:
    """Raise with the details of every failed check. A report has a row per check."""
    failed = checks.where(~F.col("passed")).orderBy("stage", "check_no").collect()
    if failed:
        raise QualityError(
            "; ".join(f"{row['stage']}.{row['name']}: {row['detail']}" for row in failed)
        )
    return checks


def unique_key_violations(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def table_key_violations(table: str, frame: DataFrame) -> DataFrame:
    return unique_key_violations(frame, TABLES[table][2])


def null_report(frame: DataFrame) -> DataFrame:
    """Null count and rate of every column, from one aggregation."""
    counted = frame.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in frame.columns],
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in frame.columns]
    )
    return counted.select(F.col("_total").alias("total_rows"), F.inline(rows)).select(
        "column_name",
        "total_rows",
        "null_count",
        F.coalesce(
            F.round(F.try_divide("null_count", "total_rows"), 4), F.lit(0.0)
        ).alias("null_rate"),
    )


def profile_columns(frame: DataFrame, samples: int = 3) -> DataFrame:
    """Type, nulls, distinct values and the first few values of every column.

    Values are compared as text and the samples are the smallest. Values fold
    into counts before the shuffle, so what moves is one row per distinct value
    and task. A frame without rows has no profile.
    """
    types = dict(frame.dtypes)
    long = frame.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")
                    )
                    for c in frame.columns
                ]
            )
        )
    )
    values = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = values.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias(
            "null_count"
        ),
        F.count("value").alias("unique_count"),
        F.sum("n").alias("total_rows"),
    )
    smallest = Window.partitionBy("column_name").orderBy("value")
    firsts = (
        values.where(F.col("value").isNotNull())
        .withColumn("_rank", F.row_number().over(smallest))
        .where(F.col("_rank") <= samples)
        .groupBy("column_name")
        .agg(F.array_sort(F.collect_list("value")).alias("sample_values"))
    )
    dtype = F.coalesce(
        *[F.when(F.col("column_name") == c, F.lit(kind)) for c, kind in types.items()]
    )
    # one row per column on both sides
    return counted.join(firsts, "column_name", "left").select(
        "column_name",
        dtype.alias("dtype"),
        "null_count",
        F.round(F.try_divide("null_count", "total_rows"), 4).alias("null_rate"),
        "unique_count",
        F.coalesce("sample_values", F.array().cast("array<string>")).alias("sample_values"),
    )
