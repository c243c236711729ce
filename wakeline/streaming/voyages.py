"""Voyages from a stream of positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions.times import epoch_seconds
from wakeline.operators.voyages import finish_voyages, point_aggregates
from wakeline.rules import VoyageRules
from wakeline.schema import POSITION_SCHEMA
from wakeline.sources.tables import layer_path


def stream_positions(spark: SparkSession, root: str, files_per_trigger: int = 1000) -> DataFrame:
    """Positions as silver partitions appear."""
    return (
        spark.readStream.schema(POSITION_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(layer_path(root, "vessel_positions"))
    )


def stream_voyages(
    positions: DataFrame,
    rules: VoyageRules = VoyageRules(),
    watermark: str = "1 day",
) -> DataFrame:
    """Finished voyages of a position stream, for append mode.

    A voyage comes out once the watermark has passed its last point by the gap.
    A report later than the watermark is dropped, so reports may be at most
    ``watermark`` out of order; a rebuild from silver has no such limit. A day whose
    partition is written again is read again, and its positions are known as repeats
    as long as the watermark has not passed them; later they are dropped as late.
    What the rewrite changed in voyages already out only a rebuild brings in.
    """
    # a watermark needs an instant; results keep the zone-free time
    instant = F.timestamp_seconds(epoch_seconds(F.col("event_time")))
    session = F.session_window("_instant", f"{int(rules.gap_seconds)} seconds")
    summaries = (
        positions.withColumn("_instant", instant)
        .withWatermark("_instant", watermark)
        .dropDuplicatesWithinWatermark(["mmsi", "event_time", "source_date"])
        .groupBy("mmsi", session)
        .agg(*point_aggregates())
        .where(F.col("point_count") >= rules.min_points)
    )
    return finish_voyages(summaries, rules)
