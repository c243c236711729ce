"""Samples, profiles and vessel counts kept by day, so that a day costs its day.

Each table here has a partition for every day, made of that day's rows alone. What is asked of
all days is merged from the partitions: silver is not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.operators import sampling, summaries
from wakeline.operators.analytics import activity_enriched
from wakeline.plans.upkeep import write_counted
from wakeline.sources.tables import path_exists, read_positions, read_table, state_path


def _refresh(frame: DataFrame, path: str, date: str, dates: Sequence | None) -> int:
    """Replace the days' partitions, or all; the first refresh makes the table."""
    known = path_exists(frame.sparkSession, path)
    return write_counted(frame, path, [date], [(d,) for d in dates] if dates is not None and known else None)


def _of(frame: DataFrame, date: str, dates: Sequence | None) -> DataFrame:
    return frame if dates is None else frame.where(F.col(date).isin(list(dates)))


class Samples:
    """The ``n`` rows of smallest hash of every source date, kept with all their columns.

    A smaller sample, of days or of everything, is the same as if it were taken from silver, since
    none of its rows is left out of its day's. A store of its own for every ``n`` and seed.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        n: int = sampling.ROWS_PER_DAY,
        key: Sequence[str] = sampling.DEFAULT_KEY,
        seed: int = sampling.SEED,
    ):
        self.spark, self.root, self.n, self.key, self.seed = spark, root, int(n), tuple(key), seed
        self.path = state_path(root, f"position_sample_{self.n}_{seed}_{'_'.join(self.key)}")

    def refresh(self, source_dates: Sequence[str] | None = None) -> int:
        positions = _of(read_positions(self.spark, self.root), "source_date", source_dates)
        sample = sampling.stratified_sample(positions, self.n, ("source_date",), self.key, self.seed)
        return _refresh(sample, self.path, "source_date", source_dates)

    def read(self) -> DataFrame:
        return self.spark.read.schema(read_positions(self.spark, self.root).schema).parquet(self.path)

    def _enough(self, n: int) -> None:
        if n > self.n:
            raise ValueError(f"{self.n} rows a day are kept, {n} are asked for")

    def daily(self, n: int) -> DataFrame:
        self._enough(n)
        return sampling.stratified_sample(self.read(), n, ("source_date",), self.key, self.seed)

    def capped(self, n: int) -> DataFrame:
        self._enough(n)
        return sampling.capped_sample(self.read(), n, self.key, self.seed)

    def proportional(self, n: int, minimum: int = 1000) -> DataFrame:
        self._enough(max(n, minimum))
        return sampling.proportional_sample(
            self.read(), n, ("source_date",), minimum, self.key, self.seed
        )


class Profiles:
    """Column summaries of the positions by source date."""

    def __init__(self, spark: SparkSession, root: str, sketch_bits: int = summaries.SKETCH_BITS):
        self.spark, self.root, self.bits = spark, root, sketch_bits
        self.path = state_path(root, f"column_summaries_{sketch_bits}")

    def _made(self, source_dates: Sequence[str] | None) -> DataFrame:
        positions = _of(read_positions(self.spark, self.root), "source_date", source_dates)
        return summaries.column_summaries(positions, ("source_date",), self.bits)

    def refresh(self, source_dates: Sequence[str] | None = None) -> int:
        return _refresh(self._made(source_dates), self.path, "source_date", source_dates)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self._made(None).schema).parquet(self.path)

    def profile(self, source_dates: Sequence[str] | None = None) -> DataFrame:
        """Of all days or some."""
        return summaries.profile_of(_of(self.read(), "source_date", source_dates))


class VesselDays:
    """Vessels and sums of the activity by day and vessel type, and of the voyages by route type.

    A vessel's type is that of the metadata when its day was refreshed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.activity_path = state_path(root, "activity_days")
        self.route_path = state_path(root, "route_days")

    def _activity(self) -> DataFrame:
        activity = read_table(self.spark, self.root, "vessel_daily_activity")
        return activity_enriched(activity, read_table(self.spark, self.root, "vessel_metadata"))

    def _voyages(self) -> DataFrame:
        return read_table(self.spark, self.root, "voyage_candidates")

    def refresh(self, days: Sequence | None = None) -> int:
        """Bring in calendar days of activity and of the voyages that start on them."""
        enriched = summaries.activity_days(_of(self._activity(), "activity_date", days))
        routes = summaries.route_days(_of(self._voyages(), "start_date", days))
        return _refresh(enriched, self.activity_path, "activity_date", days) + _refresh(
            routes, self.route_path, "metric_date", days
        )

    def activity(self) -> DataFrame:
        schema = summaries.activity_days(self._activity()).schema
        return self.spark.read.schema(schema).parquet(self.activity_path)

    def routes(self) -> DataFrame:
        schema = summaries.route_days(self._voyages()).schema
        return self.spark.read.schema(schema).parquet(self.route_path)
