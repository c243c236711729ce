"""Time columns. Everything is timestamp without time zone, so no result
depends on the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted shapes of a report time.
_STRICT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}$"
_LENIENT = (
    r"^\d{4}-\d{1,2}-\d{1,2}"
    r"([T ]\d{1,2}:\d{1,2}:\d{1,2}|T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6})$"
)
FILE_DATE = r"(\d{4}-\d{2}-\d{2})"


def parse_event_time(text: Column, lenient: bool = False) -> Column:
    """Report time, or null when the text has neither accepted shape.

    The shape is checked first and the ISO cast does the parsing, which needs no
    formatter per value. ``lenient`` also trims and takes fractional seconds.
    """
    text = text.cast("string")
    if lenient:
        text = F.trim(text)
    shape = _LENIENT if lenient else _STRICT
    return F.when(text.rlike(shape), text.try_cast("timestamp_ntz"))


def epoch_seconds(time: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without zone."""
    return (
        F.unix_date(F.to_date(time)).cast("bigint") * 86400
        + F.hour(time) * 3600
        + F.minute(time) * 60
        + F.second(time)
    )


def hours_between(earlier: Column, later: Column) -> Column:
    return (epoch_seconds(later) - epoch_seconds(earlier)) / F.lit(3600.0)


def date_from_file_name(name: Column) -> Column:
    """First ``yyyy-MM-dd`` in a file name, or null."""
    return F.nullif(F.regexp_extract(name, FILE_DATE, 1), F.lit(""))


def date_parts(date_text: Column) -> list[Column]:
    """year, month and day as unpadded integers."""
    day = date_text.try_cast("date")
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    ]
