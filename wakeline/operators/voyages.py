"""Voyages: segments of a track between long pauses.

Two levels keep every group bounded. Fragments are cut within (vessel, day) and
reduced to one row each; a pause longer than the gap ends a fragment, so a day
holds few of them however many points it has. Fragments of a vessel are then
chained over midnight. A fragment holds counts and sums only, so a stored
fragment table lets a new day be added without reading older positions again.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.classes import route_type
from wakeline.functions.exact import mean_of_micro, to_micro
from wakeline.functions.geo import great_circle_nm
from wakeline.functions.times import hours_between
from wakeline.operators.tracks import VESSEL, day_window, opens_segment, with_day
from wakeline.rules import VoyageRules

FRAGMENT_FIELDS = [
    "start_time",
    "end_time",
    "start_longitude",
    "start_latitude",
    "end_longitude",
    "end_latitude",
    "point_count",
    "sog_micro",
    "sog_count",
]
#: Fields that add up.
SUMS = FRAGMENT_FIELDS[-3:]


def point_aggregates(order: str | None = None) -> list[Column]:
    """What a fragment keeps of its points, in the order of a column or of a track.

    Two source dates may hold a vessel's report of one time, so time alone is no order.
    """
    order = order or F.struct("event_time", "longitude", "latitude")
    return [
        F.min("event_time").alias("start_time"),
        F.max("event_time").alias("end_time"),
        F.min_by("longitude", order).alias("start_longitude"),
        F.min_by("latitude", order).alias("start_latitude"),
        F.max_by("longitude", order).alias("end_longitude"),
        F.max_by("latitude", order).alias("end_latitude"),
        F.count(F.lit(1)).alias("point_count"),
        F.sum(to_micro(F.col("sog"))).alias("sog_micro"),
        F.count("sog").alias("sog_count"),
    ]


def voyage_fragments(
    positions: DataFrame,
    rules: VoyageRules = VoyageRules(),
    keys: Sequence[str] = VESSEL,
) -> DataFrame:
    """Mergeable summary of every voyage piece within one vessel and day."""
    day = day_window(keys)
    pause = opens_segment(F.lag("event_time").over(day), F.col("event_time"), rules)
    points = with_day(positions.select(*keys, "event_time", "longitude", "latitude", "sog"))
    numbered = points.withColumns(
        {"_seq": F.row_number().over(day), "_break": F.coalesce(pause, F.lit(0))}
    ).withColumn(
        "_fragment", F.sum("_break").over(day.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        numbered.groupBy(*keys, "track_date", "_fragment")
        .agg(*point_aggregates("_seq"))
        .select(*keys, "track_date", *FRAGMENT_FIELDS)
    )


def session_fragments(
    positions: DataFrame,
    rules: VoyageRules = VoyageRules(),
    keys: Sequence[str] = VESSEL,
) -> DataFrame:
    """The same fragments by Spark's session windows.

    A session ends ``gap`` after its last point and a point exactly ``gap`` later
    still belongs to it, as in the pause rule.
    """
    points = with_day(positions.select(*keys, "event_time", "longitude", "latitude", "sog"))
    gap = f"{int(rules.gap_seconds)} seconds"
    session = F.session_window("event_time", gap)
    return (
        points.groupBy(*keys, "track_date", session)
        .agg(*point_aggregates())
        .select(*keys, "track_date", *FRAGMENT_FIELDS)
    )


def merge_fragments(
    fragments: DataFrame,
    rules: VoyageRules = VoyageRules(),
    keys: Sequence[str] = VESSEL,
) -> DataFrame:
    """Chain a vessel's fragments into voyages with finished statistics."""
    return voyages_of(voyage_summaries(fragments, rules, keys), rules)


def voyage_summaries(
    fragments: DataFrame,
    rules: VoyageRules = VoyageRules(),
    keys: Sequence[str] = VESSEL,
) -> DataFrame:
    """Chains of a vessel's fragments, each as one fragment: voyages of any number of points."""
    return _folded(_numbered(fragments, rules, keys), keys)


def voyages_of(summaries: DataFrame, rules: VoyageRules) -> DataFrame:
    """Voyages with enough points, finished."""
    return finish_voyages(summaries.where(F.col("point_count") >= rules.min_points), rules)


def _numbered(fragments: DataFrame, rules: VoyageRules, keys: Sequence[str]) -> DataFrame:
    """Fragments with the number, from 1, of their voyage among the vessel's."""
    track = Window.partitionBy(*keys).orderBy("start_time")
    pause = opens_segment(F.lag("end_time").over(track), F.col("start_time"), rules)
    return fragments.withColumn("_open", F.coalesce(pause, F.lit(1))).withColumn(
        "_voyage", F.sum("_open").over(track.rowsBetween(Window.unboundedPreceding, 0))
    )


def _folded(numbered: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        numbered.groupBy(*keys, "_voyage")
        .agg(
            F.min("start_time").alias("start_time"),
            F.max("end_time").alias("end_time"),
            F.min_by("start_longitude", "start_time").alias("start_longitude"),
            F.min_by("start_latitude", "start_time").alias("start_latitude"),
            F.max_by("end_longitude", "start_time").alias("end_longitude"),
            F.max_by("end_latitude", "start_time").alias("end_latitude"),
            *[F.sum(c).alias(c) for c in SUMS],
        )
        .select(*keys, *FRAGMENT_FIELDS)
    )


def revised_summaries(
    window: DataFrame,
    before: DataFrame,
    known: DataFrame,
    first: dt.date,
    last: dt.date,
    far: Callable[[dt.date], DataFrame],
    rules: VoyageRules = VoyageRules(),
    keys: Sequence[str] = VESSEL,
) -> DataFrame:
    """Summaries of the voyages that touch the days from ``first`` to ``last``, worked out anew.

    ``window`` has the vessels' fragments on these days as they are now, ``before`` as they were,
    ``known`` the summaries there were. Days on which fragments differ stand at least
    :func:`margin_days` inside, so what a voyage has before ``first`` or after ``last`` stays joined
    to its part inside; that rest is what its summary leaves when the fragments inside are taken
    off. Only a voyage that goes on at both ends and breaks inside needs older fragments, to tell
    what belongs to either end: ``far`` gives those from a day on, and is called only then.
    """
    keys = list(keys)
    start = F.lit(first).cast("timestamp_ntz")
    end = F.lit(last + dt.timedelta(days=1)).cast("timestamp_ntz")
    sums = [F.coalesce(F.sum(F.col(f"f.{c}")), F.lit(0)).alias(f"_{c}") for c in SUMS]
    held = known.alias("s").join(before.alias("f"), keys, "left").where(
        F.col("f.start_time").isNull()
        | F.col("f.start_time").between(F.col("s.start_time"), F.col("s.end_time"))
    )
    inside = held.groupBy(*keys, F.col("s.start_time").alias("start_time")).agg(*sums)
    rest = known.join(inside, [*keys, "start_time"])
    rest = rest.withColumns({c: F.col(c) - F.col(f"_{c}") for c in SUMS}).select(*keys, *FRAGMENT_FIELDS)
    on_left, on_right = F.col("start_time") < start, F.col("end_time") >= end

    numbered = _numbered(window, rules, keys)
    count = numbered.groupBy(*keys).agg(F.max("_voyage").alias("_last"))
    rest = rest.where(on_left | on_right).join(count, keys)
    broken = rest.where(on_left & on_right & (F.col("_last") > 1))
    oldest = broken.agg(F.min("start_time")).first()[0]
    if oldest is None:
        older = {c: F.col(c) for c in SUMS}
    else:
        own = broken.select(*keys, F.col("start_time").alias("_from"))
        parts = far(oldest.date()).join(own, keys).where(F.col("start_time").between(F.col("_from"), start))
        parts = parts.groupBy(*keys).agg(*[F.sum(c).alias(f"_{c}") for c in SUMS])
        rest = rest.join(parts, keys, "left")
        older = {c: F.coalesce(f"_{c}", c) for c in SUMS}

    # a voyage that goes on at both ends has its rest at the first, less what is known to be later
    places = [f"{c}_{axis}" for c in ("start", "end") for axis in ("time", "longitude", "latitude")]
    at_start = {e: F.col(s) for s, e in zip(places[:3], places[3:])}
    at_end = {s: F.col(e) for s, e in zip(places[:3], places[3:])}
    after = {c: F.when(on_left, F.col(c) - older[c]).otherwise(F.col(c)) for c in SUMS}
    before_ = {c: F.when(on_right, older[c]).otherwise(F.col(c)) for c in SUMS}
    columns = [*keys, *FRAGMENT_FIELDS, "_voyage"]
    left = rest.where(on_left).withColumns({**at_start, **before_, "_voyage": F.lit(1).cast("long")})
    right = rest.where(on_right).withColumns({**at_end, **after, "_voyage": F.col("_last")})
    pieces = numbered.select(*columns).unionByName(left.select(*columns)).unionByName(right.select(*columns))
    return _folded(pieces, keys)


def margin_days(rules: VoyageRules) -> int:
    """Days beside a changed one that a voyage can be told by: more than a pause within a voyage."""
    return math.ceil(rules.gap_seconds / 86_400) + 1


def finish_voyages(summaries: DataFrame, rules: VoyageRules) -> DataFrame:
    """Mean speed, duration, class and start date from voyage summaries."""
    hours = hours_between(F.col("start_time"), F.col("end_time"))
    return (
        summaries.withColumns(
            {
                "avg_sog": mean_of_micro(F.col("sog_micro"), F.col("sog_count")),
                "duration_hours": F.round(hours, 2),
            }
        )
        .withColumns(
            {
                "candidate_route_type": route_type(
                    F.col("avg_sog"), F.col("duration_hours"), rules
                ),
                "start_date": F.to_date("start_time"),
            }
        )
        .select(
            "mmsi",
            "start_time",
            "end_time",
            "start_longitude",
            "start_latitude",
            "end_longitude",
            "end_latitude",
            "point_count",
            "avg_sog",
            "duration_hours",
            "candidate_route_type",
            "start_date",
        )
    )


def voyage_candidates(
    positions: DataFrame,
    rules: VoyageRules = VoyageRules(),
    per_day: bool = False,
) -> DataFrame:
    """Voyages over the whole range given.

    ``per_day`` restarts the segmentation at every source date, which is what
    processing each daily file by itself gives.
    """
    keys = ("mmsi", "source_date") if per_day else VESSEL
    return merge_fragments(voyage_fragments(positions, rules, keys), rules, keys)


def voyage_sessions(positions: DataFrame, rules: VoyageRules = VoyageRules()) -> DataFrame:
    """Voyages by session windows; equal to :func:`voyage_candidates`."""
    return merge_fragments(session_fragments(positions, rules), rules)


def voyage_distances(voyages: DataFrame) -> DataFrame:
    """Add the great-circle distance from a voyage's start to its end."""
    return voyages.withColumn(
        "distance_nm",
        great_circle_nm(
            F.col("start_latitude"),
            F.col("start_longitude"),
            F.col("end_latitude"),
            F.col("end_longitude"),
        ),
    )
