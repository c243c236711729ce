"""Incremental ingestion: every raw file once, late files included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wakeline.sources.files import RAW_PATTERN, discover_files
from wakeline.sources.ingest import load_listed


def stream_ingest(
    spark: SparkSession,
    raw_directory: str,
    root: str,
    checkpoint: str,
    pattern: str = RAW_PATTERN,
    files_per_trigger: int = 100,
    available_now: bool = True,
) -> StreamingQuery:
    """Load new files into bronze as they appear.

    The stream carries file names; each batch loads the days of its files with the
    header-bound scan, every file of such a day at once, and records how each went
    in the manifest, where files that are broken or have no date are found. Replaying
    a batch rewrites the same partitions, so a restart changes nothing.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(raw_directory)
        .select("path")
    )

    def load(batch: DataFrame, _: int) -> None:
        names = F.element_at(F.split("path", "/"), -1)
        # at most files_per_trigger names
        taken = [row[0] for row in batch.select(names).distinct().collect()]
        found = discover_files(batch.sparkSession, raw_directory, pattern)
        wanted = found.where(F.col("file_name").isin(taken)).collect()
        load_listed(batch.sparkSession, wanted, found, root)

    writer = files.writeStream.option("checkpointLocation", checkpoint).foreachBatch(load)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
