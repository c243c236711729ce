"""Great-circle geometry in nautical miles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.rules import EARTH_RADIUS_NM, MOVING_KNOTS


def great_circle_nm(
    from_latitude: Column, from_longitude: Column, to_latitude: Column, to_longitude: Column
) -> Column:
    """Haversine distance; null when any coordinate is null.

    Antipodal points can push the half-chord above one by rounding, so it is
    clamped before the arc sine.
    """
    half_dlat = (F.radians(to_latitude) - F.radians(from_latitude)) / 2
    half_dlon = (F.radians(to_longitude) - F.radians(from_longitude)) / 2
    chord = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(F.radians(from_latitude)) * F.cos(
        F.radians(to_latitude)
    ) * F.sin(half_dlon) * F.sin(half_dlon)
    # least() skips nulls, so a missing coordinate is restored explicitly
    half_chord = F.when(chord.isNotNull(), F.least(F.sqrt(chord), F.lit(1.0)))
    return F.asin(half_chord) * (2 * EARTH_RADIUS_NM)


def is_moving(sog: Column, threshold: float = MOVING_KNOTS) -> Column:
    return sog > F.lit(float(threshold))
