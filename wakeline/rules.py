"""Thresholds of the cleaning and voyage rules, as immutable parameters."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class CleaningRules:
    """Limits a position report has to satisfy."""

    latitude_min: float = -90.0
    latitude_max: float = 90.0
    longitude_min: float = -180.0
    longitude_max: float = 180.0
    sog_unavailable: float = 102.3
    cog_max: float = 360.0
    mmsi_above: int = 99_999_999
    mmsi_below: int = 1_000_000_000


@dataclass(frozen=True)
class VoyageRules:
    """How a track is cut into voyages and how a voyage is classed."""

    gap_hours: float = 4.0
    min_points: int = 10
    stationary_knots: float = 0.5
    short_hours: float = 1.0
    coastal_hours: float = 12.0

    def __post_init__(self) -> None:
        if self.gap_hours <= 0:
            raise ValueError("gap_hours must be positive")

    @property
    def gap_seconds(self) -> float:
        return self.gap_hours * 3600.0


MOVING_KNOTS = 0.5
EARTH_RADIUS_NM = 3440.065
