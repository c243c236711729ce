"""Classing rules for vessels and voyages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.rules import VoyageRules

# Vessel type codes of each named class.
VESSEL_CLASSES = {
    "fishing": [30, 31, 32],
    "sailing": [36, 37],
    "tug": [52],
    "passenger": [60, 61],
    "cargo": [70, 71, 72],
    "tanker": [80, 81, 89],
}


def vessel_class(vessel_type: Column) -> Column:
    named = F.coalesce(
        *[F.when(vessel_type.isin(codes), F.lit(name)) for name, codes in VESSEL_CLASSES.items()]
    )
    return F.coalesce(named, F.lit("other"))


def route_type(avg_sog: Column, duration_hours: Column, rules: VoyageRules) -> Column:
    """Class of a voyage from its rounded mean speed and rounded duration.

    An unknown speed is not stationary; the duration decides.
    """
    by_duration = (
        F.when(duration_hours < rules.short_hours, "short_move")
        .when(duration_hours < rules.coastal_hours, "coastal")
        .otherwise("transit")
    )
    return F.when(avg_sog < rules.stationary_knots, "stationary").otherwise(by_duration)
