"""Lookups, rankings and distributions over the gold tables and positions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.functions.classes import vessel_class
from wakeline.functions.exact import exact_mean, integer_mean
from wakeline.functions.geo import is_moving
from wakeline.operators.quantiles import exact_quantile, exact_quantiles
from wakeline.rules import MOVING_KNOTS

#: Where cleaned columns lie.


# --- filters -----------------------------------------------------------------


def filter_activity(
    activity: DataFrame,
    dates: Iterable[dt.date | str] | None = None,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """Activity of the given dates with mean speed in [low, high].

    A speed bound drops rows of unknown mean speed.
    """
    if dates is not None:
        activity = activity.where(F.col("activity_date").isin([_as_date(d) for d in dates]))
    if low is not None:
        activity = activity.where(F.col("avg_sog") >= F.lit(float(low)))
    if high is not None:
        activity = activity.where(F.col("avg_sog") <= F.lit(float(high)))
    return activity


def filter_route_types(frame: DataFrame, types: Iterable[str]) -> DataFrame:
    """Voyages or route metrics of the given route types."""
    return frame.where(F.col("candidate_route_type").isin(list(types)))


def filter_mmsi(frame: DataFrame, mmsi: int | str) -> DataFrame:
    return frame.where(F.col("mmsi") == F.lit(parse_mmsi(mmsi)))


def parse_mmsi(mmsi: int | str) -> int:
    try:
        return int(str(mmsi).strip())
    except ValueError:
        raise ValueError(f"an MMSI is a number, not {mmsi!r}") from None


def name_matches(text: str, regex: bool = True) -> Column:
    """Case-insensitive search in ``vessel_name``; an unknown name is an empty one."""
    name = F.coalesce(F.col("vessel_name"), F.lit(""))
    text = text.strip()
    if regex:
        return name.rlike("(?i)" + text)
    return F.contains(F.lower(name), F.lower(F.lit(text)))


def search_name(frame: DataFrame, text: str, regex: bool = True) -> DataFrame:
    return frame.where(name_matches(text, regex))


def voyages_by_name(
    voyages: DataFrame, enriched_activity: DataFrame, text: str, regex: bool = True
) -> DataFrame:
    """Voyages of the vessels whose activity matches a name search."""
    matched = search_name(enriched_activity, text, regex).select("mmsi")
    return voyages.join(matched, "mmsi", "left_semi")


def voyage_arcs(
    voyages: DataFrame,
    types: Iterable[str] = ("transit", "coastal"),
    min_duration: float = 1.0,
) -> DataFrame:
    """Origin and destination of the voyages that have both, unknown values as 0."""
    ends = ["start_latitude", "start_longitude", "end_latitude", "end_longitude"]
    return (
        filter_route_types(voyages.dropna(subset=ends), types)
        .where(F.col("duration_hours") >= F.lit(float(min_duration)))
        .select(
            "mmsi", "start_time", *ends, "candidate_route_type", "duration_hours", "avg_sog"
        )
        .fillna(0)
    )


def map_points(positions: DataFrame) -> DataFrame:
    """Points to draw: located, unknown speed and vessel type as 0."""
    return positions.dropna(subset=["latitude", "longitude"]).fillna(
        {"sog": 0.0, "vessel_type": 0}
    )


# --- derived columns ---------------------------------------------------------


def with_moving(positions: DataFrame, threshold: float = MOVING_KNOTS) -> DataFrame:
    return positions.withColumn("is_moving", is_moving(F.col("sog"), threshold))


def with_vessel_class(positions: DataFrame) -> DataFrame:
    return positions.withColumn("vessel_class", vessel_class(F.col("vessel_type")))


def with_speed_ratio(points: DataFrame, fraction: float = 0.95) -> DataFrame:
    """Speed as a share of the ``fraction`` quantile (1 knot at least), within [0, 1]."""
    top = F.greatest(exact_quantile(points, "sog", fraction).scalar(), F.lit(1.0))
    clipped = F.when(
        F.col("sog").isNotNull(), F.least(F.greatest(F.col("sog"), F.lit(0.0)), top)
    )
    return points.withColumn("speed_ratio", clipped / top)


def activity_enriched(activity: DataFrame, metadata: DataFrame) -> DataFrame:
    """Activity with the vessel's name and type where known."""
    return activity.join(metadata.select("mmsi", "vessel_name", "vessel_type"), "mmsi", "left")


# --- aggregates --------------------------------------------------------------


def activity_by_vessel_type(activity: DataFrame, metadata: DataFrame) -> DataFrame:
    """Vessels, mean daily points and mean speed per vessel type, unknown type included."""
    return (
        activity_enriched(activity, metadata)
        .groupBy("vessel_type")
        .agg(
            F.countDistinct("mmsi").alias("vessel_count"),
            integer_mean(F.col("point_count"), 0).alias("avg_daily_points"),
            exact_mean(F.col("avg_sog")).alias("avg_speed"),
        )
        .orderBy(F.desc("vessel_count"), F.asc_nulls_first("vessel_type"))
    )


def route_type_breakdown(routes: DataFrame) -> DataFrame:
    return (
        routes.groupBy("candidate_route_type")
        .agg(
            F.count(F.lit(1)).alias("day_count"),
            integer_mean(F.col("vessel_count"), 0).alias("avg_daily_vessels"),
            exact_mean(F.col("avg_duration_hours")).alias("avg_duration"),
            exact_mean(F.col("avg_speed")).alias("avg_speed"),
        )
        .orderBy(F.desc("avg_daily_vessels"), "candidate_route_type")
    )


def top_active_vessels(enriched: DataFrame, limit: int = 50) -> DataFrame:
    """Vessels with the most points; those without a name are left out."""
    return (
        enriched.dropna(subset=["mmsi", "vessel_name"])
        .groupBy("mmsi", "vessel_name")
        .agg(
            F.sum("point_count").alias("total_points"),
            exact_mean(F.col("avg_sog")).alias("avg_speed"),
            F.round(F.max("max_sog"), 2).alias("max_speed"),
            F.countDistinct("activity_date").alias("days_active"),
        )
        .orderBy(F.desc("total_points"), "mmsi", "vessel_name")
        .limit(limit)
    )


def route_type_counts(voyages: DataFrame) -> DataFrame:
    return (
        voyages.dropna(subset=["candidate_route_type"])
        .groupBy("candidate_route_type")
        .agg(F.count(F.lit(1)).alias("voyages"))
        .orderBy(F.desc("voyages"), "candidate_route_type")
    )


def speed_histogram(activity: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width, right-closed bins over the mean speeds, empty bins kept.

    The smallest value belongs to the first bin. A single distinct value gets a
    range of a tenth of a percent around it.
    """
    counts = (
        activity.where(F.col("avg_sog").isNotNull())
        .groupBy("avg_sog")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    lo, hi = F.min("avg_sog"), F.max("avg_sog")
    pad = F.when(lo == hi, F.when(lo == 0, 0.001).otherwise(F.abs(lo) * 0.001)).otherwise(0.0)
    span = counts.agg(
        F.struct((lo - pad).alias("lo"), (hi + pad).alias("hi")).alias("span")
    )
    edges = span.where(F.col("span.lo").isNotNull()).select(
        "span",
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    )

    def edge(limits: Column, i: Column | int) -> Column:
        step = (limits.getField("hi") - limits.getField("lo")) / F.lit(float(bins))
        return limits.getField("lo") + step * (i if isinstance(i, Column) else F.lit(float(i)))

    # the inner edges once, as one array
    inner = span.select(
        F.array(*[edge(F.col("span"), i) for i in range(1, bins)]).alias("edges")
    ).scalar()
    spanned = counts.withColumn("edges", inner)
    passed = F.size(F.filter("edges", lambda at: F.col("avg_sog") > at))
    binned = (
        spanned.select(passed.alias("bin"), "n")
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    # both sides have one row per bin
    return (
        edges.join(binned, "bin", "left")
        .select(
            "bin",
            F.round(edge(F.col("span"), F.col("bin").cast("double")), 4).alias("above"),
            F.round(edge(F.col("span"), F.col("bin").cast("double") + 1.0), 4).alias("upto"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("record_count"),
        )
        .orderBy("bin")
    )


def kpi_summary(
    activity: DataFrame,
    metadata: DataFrame,
    filtered_activity: DataFrame,
    filtered_voyages: DataFrame,
) -> DataFrame:
    """One row: vessels and positions overall, voyages and records as filtered."""
    records = filtered_activity.agg(F.count(F.lit(1)).alias("n")).scalar()
    voyages = filtered_voyages.agg(F.count(F.lit(1)).alias("n")).scalar()
    # metadata has one row per vessel
    vessels = metadata.agg(F.count("mmsi").alias("n")).scalar()
    return activity.agg(
        F.sum("point_count").alias("total_positions"),
        F.countDistinct("activity_date").alias("available_days"),
    ).select(
        vessels.alias("unique_vessels"),
        voyages.alias("voyage_segments"),
        records.alias("daily_records"),
        "total_positions",
        "available_days",
    )


def map_center(points: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """Exact median latitude and longitude."""
    medians = exact_quantiles(points, [latitude, longitude], 0.5)
    return medians.agg(
        F.max(F.when(F.col("name") == latitude, F.col("quantile"))).alias("center_latitude"),
        F.max(F.when(F.col("name") == longitude, F.col("quantile"))).alias("center_longitude"),
    )


def filter_options(activity: DataFrame, voyages: DataFrame) -> DataFrame:
    """Values a user can filter by: dates, route types and the top mean speed."""
    dates = activity.select(
        F.lit("activity_date").alias("option"), F.col("activity_date").cast("string").alias("value")
    ).distinct()
    types = (
        voyages.dropna(subset=["candidate_route_type"])
        .select(
            F.lit("candidate_route_type").alias("option"),
            F.col("candidate_route_type").alias("value"),
        )
        .distinct()
    )
    speed = activity.agg(F.max("avg_sog").cast("string").alias("value")).select(
        F.lit("max_avg_sog").alias("option"), "value"
    )
    return dates.union(types).union(speed).orderBy("option", "value")


# --- rankings ----------------------------------------------------------------


def top_vessels_on_date(
    activity: DataFrame, metadata: DataFrame, date: dt.date | str, limit: int = 20
) -> DataFrame:
    on_date = activity.where(F.col("activity_date") == F.lit(_as_date(date)))
    return (
        activity_enriched(on_date, metadata)
        .select(
            "mmsi",
            "vessel_name",
            "vessel_type",
            "activity_date",
            "point_count",
            "avg_sog",
            "max_sog",
            "first_seen_time",
            "last_seen_time",
        )
        .orderBy(F.desc("point_count"), "mmsi")
        .limit(limit)
    )


def speed_anomalies(
    activity: DataFrame, metadata: DataFrame, above: float = 30.0, limit: int = 50
) -> DataFrame:
    """Vessel days with the highest top speed, over a threshold."""
    fast = activity.where(F.col("max_sog") > F.lit(float(above)))
    return (
        activity_enriched(fast, metadata)
        .select("mmsi", "vessel_name", "activity_date", "avg_sog", "max_sog", "point_count")
        .orderBy(F.desc("max_sog"), "mmsi", "activity_date")
        .limit(limit)
    )


def route_distribution(routes: DataFrame, types: Iterable[str] | None = None) -> DataFrame:
    chosen = routes if types is None else filter_route_types(routes, types)
    return chosen.select(
        "metric_date",
        "candidate_route_type",
        "vessel_count",
        "avg_duration_hours",
        "avg_speed",
        "point_count",
    ).orderBy("metric_date", F.desc("vessel_count"), "candidate_route_type")


def transit_trend(routes: DataFrame) -> DataFrame:
    return (
        routes.where(F.col("candidate_route_type") == "transit")
        .select("metric_date", "vessel_count", "avg_duration_hours", "avg_speed")
        .orderBy("metric_date")
    )


def longest_voyages(voyages: DataFrame, limit: int = 100) -> DataFrame:
    return (
        voyages.select(
            "mmsi",
            "start_time",
            "end_time",
            "duration_hours",
            "avg_sog",
            "candidate_route_type",
            "point_count",
            "start_latitude",
            "start_longitude",
            "end_latitude",
            "end_longitude",
        )
        .orderBy(F.desc("duration_hours"), "mmsi", "start_time")
        .limit(limit)
    )


# --- one vessel --------------------------------------------------------------


def vessel_info(metadata: DataFrame, mmsi: int | str) -> DataFrame:
    return filter_mmsi(metadata, mmsi)


def vessel_activity(activity: DataFrame, mmsi: int | str) -> DataFrame:
    return (
        filter_mmsi(activity, mmsi)
        .select(
            "activity_date",
            "point_count",
            "avg_sog",
            "max_sog",
            "first_seen_time",
            "last_seen_time",
        )
        .orderBy("activity_date")
    )


def vessel_voyages(voyages: DataFrame, mmsi: int | str) -> DataFrame:
    return (
        filter_mmsi(voyages, mmsi)
        .select("start_time", "end_time", "duration_hours", "avg_sog", "candidate_route_type")
        .orderBy("start_time")
    )


def track_points(positions: DataFrame, mmsi: int | str) -> DataFrame:
    """A vessel's points in time order, unknown numbers as 0."""
    return filter_mmsi(positions, mmsi).fillna(0).orderBy("event_time", "longitude", "latitude")


def _as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)
