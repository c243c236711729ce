"""Per-vessel sequence operators: previous point, gaps, segments, paths.

A vessel may own a large share of all rows, so no window spans a whole track.
Windows run within (vessel, calendar day), where whole-second report times bound
the group at 86,400 distinct instants; what crosses a midnight travels through a
seam table of one row per vessel and day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.geo import great_circle_nm
from wakeline.functions.times import epoch_seconds, hours_between
from wakeline.rules import VoyageRules

VESSEL = ("mmsi",)
_ORDER = ["event_time", "longitude", "latitude"]


def with_day(positions: DataFrame) -> DataFrame:
    return positions.withColumn("track_date", F.to_date("event_time"))


def _placed(positions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Positions of a known vessel and time, which cleaned ones are.

    Saying so on both sides of a seam join lets them share one shuffle.
    """
    for name in (*keys, "event_time"):
        positions = positions.where(F.col(name).isNotNull())
    return with_day(positions)


def day_window(keys: Sequence[str]):
    """Time order within one vessel and day, total on unique positions."""
    return Window.partitionBy(*keys, "track_date").orderBy(*_ORDER)


def opens_segment(previous_end: Column, start: Column, rules: VoyageRules) -> Column:
    """1 where the pause since ``previous_end`` is longer than the allowed gap."""
    return (epoch_seconds(start) - epoch_seconds(previous_end) > rules.gap_seconds).cast("int")


def with_previous(
    positions: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = VESSEL,
) -> DataFrame:
    """Add ``prev_<value>`` from the vessel's previous point, null at its first.

    Rows without a key or time have no place in a track and are dropped.
    """
    values = list(values)
    day = day_window(keys)
    local = _placed(positions, keys).withColumns(
        {
            "_first": F.lag("event_time").over(day).isNull(),
            "_last": F.lead("event_time").over(day).isNull(),
            **{f"_prev_{v}": F.lag(v).over(day) for v in values},
        }
    )
    across_days = Window.partitionBy(*keys).orderBy("track_date")
    seams = local.where("_last").select(
        *keys,
        "track_date",
        *[F.lag(v).over(across_days).alias(f"_seam_{v}") for v in values],
    )
    joined = local.join(seams, [*keys, "track_date"], "left")
    return joined.select(
        *[local[name] for name in positions.columns],
        *[
            F.when(F.col("_first"), F.col(f"_seam_{v}"))
            .otherwise(F.col(f"_prev_{v}"))
            .alias(f"prev_{v}")
            for v in values
        ],
    )


def time_gaps(positions: DataFrame, keys: Sequence[str] = VESSEL) -> DataFrame:
    """Add ``prev_time`` and ``time_gap_hours`` since the vessel's previous point."""
    previous = with_previous(positions, ["event_time"], keys)
    return previous.withColumnRenamed("prev_event_time", "prev_time").withColumn(
        "time_gap_hours", hours_between(F.col("prev_time"), F.col("event_time"))
    )


def distances(positions: DataFrame, keys: Sequence[str] = VESSEL) -> DataFrame:
    """Add ``distance_nm`` to the vessel's previous point."""
    previous = with_previous(positions, ["latitude", "longitude"], keys)
    return previous.withColumn(
        "distance_nm",
        great_circle_nm(
            F.col("prev_latitude"), F.col("prev_longitude"), F.col("latitude"), F.col("longitude")
        ),
    )


def voyage_segments(
    positions: DataFrame,
    rules: VoyageRules = VoyageRules(),
    keys: Sequence[str] = VESSEL,
) -> DataFrame:
    """Label every position with its ``voyage_id``, counted from 1 per vessel."""
    day = day_window(keys)
    pause = opens_segment(F.lag("event_time").over(day), F.col("event_time"), rules)
    breaks = F.coalesce(pause, F.lit(0))
    local = (
        _placed(positions, keys)
        .withColumns({"_break": breaks, "_last": F.lead("event_time").over(day).isNull()})
        .withColumns(
            {
                "_breaks": F.sum("_break").over(day.rowsBetween(Window.unboundedPreceding, 0)),
                "_day_start": F.first("event_time").over(
                    day.rowsBetween(Window.unboundedPreceding, 0)
                ),
            }
        )
    )
    across_days = Window.partitionBy(*keys).orderBy("track_date")
    seam_pause = opens_segment(
        F.lag("event_time").over(across_days), F.col("_day_start"), rules
    )
    # the last row of a day carries the day's first time and number of breaks
    seams = (
        local.where("_last")
        .withColumn("_opened", F.coalesce(seam_pause, F.lit(1)) + F.col("_breaks"))
        .select(
            *keys,
            "track_date",
            (
                F.sum("_opened").over(across_days.rowsBetween(Window.unboundedPreceding, 0))
                - F.col("_breaks")
            ).alias("_first_id"),
        )
    )
    # every day has its seam; an outer join only keeps both shuffles alike
    joined = local.join(seams, [*keys, "track_date"], "left")
    return joined.select(
        *[local[name] for name in positions.columns],
        (F.col("_first_id") + F.col("_breaks")).alias("voyage_id"),
    )


def vessel_track(positions: DataFrame, mmsi: int | None = None) -> DataFrame:
    """Time-ordered [longitude, latitude] path of every vessel, one row per day.

    A path is a list, and a list has to fit one row, so a track is cut by day;
    read in ``track_date`` order the pieces are the whole path. Positions are
    unique per vessel and second, which bounds a piece at 86,400 points.
    """
    points = positions if mmsi is None else positions.where(F.col("mmsi") == F.lit(mmsi))
    ordered = F.array_sort(
        F.collect_list(F.struct("event_time", "longitude", "latitude"))
    )
    return (
        with_day(points.select("mmsi", "event_time", "longitude", "latitude"))
        .groupBy("mmsi", "track_date")
        .agg(ordered.alias("_points"))
        .select(
            "mmsi",
            "track_date",
            F.size("_points").alias("point_count"),
            F.transform(
                "_points",
                lambda p: F.struct(
                    p["longitude"].alias("longitude"), p["latitude"].alias("latitude")
                ),
            ).alias("path"),
        )
    )
