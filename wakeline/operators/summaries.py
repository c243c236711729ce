"""Summaries of days that merge into those of any longer time.

Column profiles: rows, nulls, smallest and largest value and a sketch of the distinct values of
every column, from one scan. Counts and ends are exact, the number of distinct values is an
estimate, whose last digits depend on the order of merging;
:func:`wakeline.operators.quality.profile_columns` counts them.

Vessels: the vessels of a day and group as bitmaps, one for each range of 32,768 numbers that has
any, beside sums that add up. Distinct vessels of any days are counted exactly from them, where
counts of days could not be added. A bitmap takes 4 KB before compression, so this pays where many
days are merged, not for a single one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.exact import mean_of_micro, to_micro
from wakeline.schema import ROUTE_SCHEMA

#: Binary logarithm of a sketch's slots: a standard error of about 1.6 percent, 4 KB at most.
SKETCH_BITS = 12


# --- column profiles ---------------------------------------------------------


def column_summaries(
    frame: DataFrame, keys: Sequence[str] = ("source_date",), sketch_bits: int = SKETCH_BITS
) -> DataFrame:
    """Keys, ``column_name, dtype, total_rows, null_count, smallest, largest, sketch``.

    A row for every group of the keys and every other column. Values are compared as text. A
    frame without rows has no summary; a column of nulls has no ends and an empty sketch.
    """
    keys = list(keys)
    types = {name: kind for name, kind in frame.dtypes if name not in keys}
    parts = []
    for i, (name, kind) in enumerate(types.items()):
        text = F.col(f"`{name}`").cast("string")
        # a sketch leaves out empty text, but not its hash
        value = F.when(text.isNotNull(), F.xxhash64(text))
        parts.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("dtype"),
                F.count_if(text.isNull()).alias("null_count"),
                F.min(text).alias("smallest"),
                F.max(text).alias("largest"),
                F.hll_sketch_agg(value, sketch_bits).alias("sketch"),
            ).alias(f"_c{i}")
        )
    counted = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_rows"), *parts)
    rows = counted.where("total_rows > 0").select(
        *keys, "total_rows", F.inline(F.array(*[F.col(f"_c{i}") for i in range(len(types))]))
    )
    return rows.select(
        *keys, "column_name", "dtype", "total_rows", "null_count", "smallest", "largest", "sketch"
    )


def merge_summaries(summaries: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Summaries by fewer keys."""
    return summaries.groupBy(*keys, "column_name").agg(
        F.max("dtype").alias("dtype"),
        F.sum("total_rows").alias("total_rows"),
        F.sum("null_count").alias("null_count"),
        F.min("smallest").alias("smallest"),
        F.max("largest").alias("largest"),
        F.hll_union_agg("sketch", F.lit(True)).alias("sketch"),
    )


def profile_of(summaries: DataFrame) -> DataFrame:
    """One row per column: rows, nulls, smallest and largest value, estimated distinct values."""
    return merge_summaries(summaries).select(
        "column_name",
        "dtype",
        "total_rows",
        "null_count",
        F.round(F.try_divide("null_count", "total_rows"), 4).alias("null_rate"),
        F.hll_sketch_estimate("sketch").alias("unique_estimate"),
        "smallest",
        "largest",
    )


# --- vessels -----------------------------------------------------------------


def vessel_bitmaps(frame: DataFrame, keys: Sequence[str | Column], **sums: Column) -> DataFrame:
    """Keys, ``vessel_range, vessels`` and the given aggregates of every range.

    Vessels without a number have a range of null and an empty bitmap.
    """
    mmsi = F.col("mmsi").cast("bigint")
    return frame.groupBy(*keys, F.bitmap_bucket_number(mmsi).alias("vessel_range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(mmsi)).alias("vessels"),
        *[column.alias(name) for name, column in sums.items()],
    )


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Keys, ``vessel_count`` and sums: distinct vessels of all rows that share the keys.

    The ranges of a group are merged first, each by itself, so that no task takes in all bitmaps
    of a group.
    """
    ranges = bitmaps.groupBy(*keys, "vessel_range").agg(
        F.bitmap_or_agg("vessels").alias("vessels"), *[F.sum(name).alias(name) for name in sums]
    )
    counted = ranges.withColumn("_vessels", F.bitmap_count("vessels")).drop("vessels")
    return counted.groupBy(*keys).agg(
        F.sum("_vessels").alias("vessel_count"), *[F.sum(name).alias(name) for name in sums]
    )


def _mean_parts(name: str, column: str) -> dict[str, Column]:
    micro = to_micro(F.col(column))
    return {f"{name}_sum": F.sum(micro), f"{name}_known": F.count(micro)}


ROUTE_SUMS = ("voyages", "points", "hours_sum", "hours_known", "speed_sum", "speed_known")
ACTIVITY_SUMS = ("records", "points", "points_known", "speed_sum", "speed_known")


def route_days(voyages: DataFrame) -> DataFrame:
    """Vessels and sums of the voyages per route type and day."""
    return vessel_bitmaps(
        voyages,
        ["candidate_route_type", F.to_date("start_time").alias("metric_date")],
        voyages=F.count(F.lit(1)),
        points=F.sum("point_count"),
        **_mean_parts("hours", "duration_hours"),
        **_mean_parts("speed", "avg_sog"),
    )


def _route_means(totals: DataFrame) -> DataFrame:
    return totals.withColumns(
        {
            "avg_duration_hours": mean_of_micro(F.col("hours_sum"), F.col("hours_known")),
            "avg_speed": mean_of_micro(F.col("speed_sum"), F.col("speed_known")),
        }
    )


def route_metrics_of(days: DataFrame) -> DataFrame:
    """What :func:`wakeline.operators.gold.route_metrics` makes of the voyages."""
    merged = merge_bitmaps(days, ["candidate_route_type", "metric_date"], ROUTE_SUMS)
    route = F.sha2(F.concat_ws("_", "candidate_route_type", "metric_date"), 256)
    totals = _route_means(merged).withColumn("route_id", route)
    return totals.withColumnRenamed("points", "point_count").select(*ROUTE_SCHEMA.names)


def route_periods(days: DataFrame, unit: str = "month") -> DataFrame:
    """Voyages and distinct vessels per route type and week, month, quarter or year."""
    period = F.trunc("metric_date", unit).alias("period")
    dated = days.select("*", period)
    merged = merge_bitmaps(dated, ["candidate_route_type", "period"], ROUTE_SUMS)
    return _route_means(merged).select(
        "candidate_route_type",
        "period",
        "vessel_count",
        "voyages",
        F.col("points").alias("point_count"),
        "avg_duration_hours",
        "avg_speed",
    )


def activity_days(enriched: DataFrame) -> DataFrame:
    """Vessels and sums of the activity, as enriched, per day and vessel type."""
    return vessel_bitmaps(
        enriched,
        ["activity_date", "vessel_type"],
        records=F.count(F.lit(1)),
        points=F.sum("point_count"),
        points_known=F.count("point_count"),
        **_mean_parts("speed", "avg_sog"),
    )


def activity_by_vessel_type_of(days: DataFrame) -> DataFrame:
    """What :func:`wakeline.operators.analytics.activity_by_vessel_type` makes of the activity."""
    merged = merge_bitmaps(days, ["vessel_type"], ACTIVITY_SUMS)
    points = F.try_divide(F.col("points").cast("decimal(20,0)"), F.col("points_known"))
    return merged.select(
        "vessel_type",
        "vessel_count",
        F.round(points.cast("decimal(38,10)"), 0).cast("double").alias("avg_daily_points"),
        mean_of_micro(F.col("speed_sum"), F.col("speed_known")).alias("avg_speed"),
    ).orderBy(F.desc("vessel_count"), F.asc_nulls_first("vessel_type"))


def kpi_of(activity: DataFrame, routes: DataFrame) -> DataFrame:
    """One row: vessels, voyages, records, positions and days, from the days' summaries only."""
    everything = merge_bitmaps(activity, [], ACTIVITY_SUMS)
    days = activity.agg(F.countDistinct("activity_date").alias("n")).scalar()
    voyages = routes.agg(F.sum("voyages").alias("n")).scalar()
    return everything.select(
        F.coalesce("vessel_count", F.lit(0)).alias("unique_vessels"),
        F.coalesce(voyages, F.lit(0)).alias("voyage_segments"),
        F.coalesce("records", F.lit(0)).alias("daily_records"),
        F.coalesce("points", F.lit(0)).alias("total_positions"),
        days.alias("available_days"),
    )
