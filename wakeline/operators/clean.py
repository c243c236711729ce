"""From raw reports to typed, valid, unique positions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.functions.times import parse_event_time
from wakeline.rules import CleaningRules
from wakeline.schema import LEGACY_NAMES, POSITION_COLUMNS

CRITICAL_COLUMNS = ["mmsi", "event_time", "latitude", "longitude"]
POSITION_KEY = ["mmsi", "event_time"]
DEFAULT_RULES = CleaningRules()

_POSITION_TYPES = {
    "mmsi": "bigint",
    "latitude": "double",
    "longitude": "double",
    "sog": "double",
    "cog": "double",
    "heading": "double",
    "vessel_type": "int",
    "status": "int",
    "draft": "double",
    "cargo": "int",
}


def rename_legacy_columns(reports: DataFrame) -> DataFrame:
    """Rename older header names by name; columns already named right stay."""
    return reports.withColumnsRenamed(LEGACY_NAMES)


def cast_columns(frame: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns, a value that does not fit becoming null.

    Integer codes also arrive as decimals such as ``37.0``, so they go by way of
    double.
    """
    casts = {}
    for name, kind in types.items():
        value = F.col(name)
        if kind == "int":
            value = value.try_cast("double")
        casts[name] = value.try_cast(kind)
    return frame.withColumns(casts)


def cast_reports(reports: DataFrame) -> DataFrame:
    return cast_columns(reports, _POSITION_TYPES)


def normalize_timestamp(
    reports: DataFrame, column: str = "base_date_time", lenient: bool = False
) -> DataFrame:
    """Add ``event_time``, null where the text is no report time."""
    return reports.withColumn("event_time", parse_event_time(F.col(column), lenient))


def drop_null_critical(
    frame: DataFrame, columns: Iterable[str] = tuple(CRITICAL_COLUMNS)
) -> DataFrame:
    # not dropna: these conditions reach the Parquet scan
    for name in columns:
        frame = frame.where(F.col(name).isNotNull())
    return frame


def null_sentinel(frame: DataFrame, rules: CleaningRules = DEFAULT_RULES) -> DataFrame:
    """Speeds at or above the "not available" value become null."""
    known = F.when(F.col("sog") < rules.sog_unavailable, F.col("sog"))
    return frame.withColumn("sog", known)


def drop_null_island(frame: DataFrame) -> DataFrame:
    at_origin = (F.col("latitude") == 0.0) & (F.col("longitude") == 0.0)
    return frame.where(~at_origin)


def validate_mmsi(frame: DataFrame, rules: CleaningRules = DEFAULT_RULES) -> DataFrame:
    mmsi = F.col("mmsi")
    return frame.where((mmsi > rules.mmsi_above) & (mmsi < rules.mmsi_below))


def validate_coordinates(frame: DataFrame, rules: CleaningRules = DEFAULT_RULES) -> DataFrame:
    return frame.where(
        F.col("latitude").between(rules.latitude_min, rules.latitude_max)
        & F.col("longitude").between(rules.longitude_min, rules.longitude_max)
    )


def validate_sog(frame: DataFrame, rules: CleaningRules = DEFAULT_RULES) -> DataFrame:
    """Keep unknown speeds and those in [0, sentinel)."""
    sog = F.col("sog")
    return frame.where(sog.isNull() | ((sog >= 0) & (sog < rules.sog_unavailable)))


def validate_cog(frame: DataFrame, rules: CleaningRules = DEFAULT_RULES) -> DataFrame:
    return frame.where(F.col("cog").between(0.0, rules.cog_max))


def validate_row(frame: DataFrame, rules: CleaningRules = DEFAULT_RULES) -> DataFrame:
    for check in (validate_mmsi, validate_coordinates, validate_sog):
        frame = check(frame, rules)
    return frame


def deduplicate_positions(
    frame: DataFrame, keys: Iterable[str] = tuple(POSITION_KEY)
) -> DataFrame:
    """One row per key: the most complete one, ties going to the smallest values.

    The choice is an aggregate, so copies collapse before the shuffle however
    many there are of one key, and it does not depend on row order.
    """
    keys = list(keys)
    rest = [name for name in frame.columns if name not in keys]
    missing = sum((F.col(name).isNull().cast("int") for name in rest), F.lit(0))
    chosen = frame.groupBy(*keys).agg(F.min(F.struct(missing.alias("_missing"), *rest)).alias("_"))
    return chosen.select(
        *[F.col(name) if name in keys else F.col(f"_.{name}") for name in frame.columns]
    )


def build_silver(
    bronze: DataFrame,
    source_date: str | None = None,
    rules: CleaningRules = DEFAULT_RULES,
) -> DataFrame:
    """Clean, typed, unique positions of one or many source dates.

    With ``source_date`` the rows are labelled with it. Without, ``bronze`` brings
    the column and is deduplicated within each date, so one run over many dates
    gives what one run per date gives.
    """
    labelled = bronze if source_date is None else bronze.withColumn("source_date", F.lit(source_date))
    typed = cast_reports(normalize_timestamp(labelled)).select(*POSITION_COLUMNS, "source_date")
    valid = validate_row(drop_null_island(null_sentinel(drop_null_critical(typed), rules)), rules)
    return deduplicate_positions(valid, [*POSITION_KEY, "source_date"])
