"""The ingestion manifest: an append-only table of load attempts.

A file may be tried many times; its latest attempt is its state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.schema import MANIFEST_SCHEMA
from wakeline.sources.tables import path_exists

SUCCESS, FAILED = "success", "failed"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest, or an empty one before the first attempt."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def append_attempts(attempts: DataFrame, path: str) -> None:
    """Record attempts; :func:`success` and :func:`failure` make them."""
    attempts.select(*MANIFEST_SCHEMA.names).write.mode("append").parquet(path)


def _now() -> Column:
    """The time in UTC, whatever the session's zone, so that attempts of all sessions compare."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def success(files: DataFrame) -> DataFrame:
    """Attempts from rows of (file_name, source_date, row_count)."""
    return files.select(
        "file_name",
        _now().alias("ingested_at"),
        F.col("row_count").cast("bigint").alias("row_count"),
        "source_date",
        F.lit(SUCCESS).alias("status"),
        F.lit(None).cast("string").alias("error"),
    )


def failure(files: DataFrame) -> DataFrame:
    """Attempts from rows of (file_name, error)."""
    return files.select(
        "file_name",
        _now().alias("ingested_at"),
        F.lit(0).cast("bigint").alias("row_count"),
        F.lit(None).cast("string").alias("source_date"),
        F.lit(FAILED).alias("status"),
        "error",
    )


def reset_manifest(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], MANIFEST_SCHEMA).write.mode("overwrite").parquet(path)


def latest_attempts(manifest: DataFrame) -> DataFrame:
    """Each file's latest attempt, ties going to the greatest values."""
    state = [c for c in manifest.columns if c not in ("file_name", "ingested_at")]
    return (
        manifest.groupBy("file_name")
        .agg(F.max(F.struct("ingested_at", *state)).alias("_"))
        .select("file_name", "_.*")
    )


def pending_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose latest attempt did not succeed, or that were never tried."""
    loaded = latest_attempts(manifest).where(F.col("status") == SUCCESS).select("file_name")
    return files.join(loaded, "file_name", "left_anti")


def is_ingested(manifest: DataFrame, file_name: str) -> DataFrame:
    """One row, one column ``ingested``."""
    tried = latest_attempts(manifest.where(F.col("file_name") == F.lit(file_name)))
    return tried.agg((F.count_if(F.col("status") == SUCCESS) > 0).alias("ingested"))


def ingested_dates(manifest: DataFrame) -> DataFrame:
    """Source date of every loaded file, in order."""
    return (
        latest_attempts(manifest)
        .where((F.col("status") == SUCCESS) & (F.col("source_date") != ""))
        .select("source_date", "file_name")
        .orderBy("source_date", "file_name")
    )


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """Files tracked, loaded and failed, rows loaded and the last successful load."""
    loaded = F.col("status") == SUCCESS
    return latest_attempts(manifest).agg(
        F.count(F.lit(1)).alias("total_tracked"),
        F.count_if(loaded).alias("successful"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.max(F.when(loaded, F.col("ingested_at"))).alias("last_run"),
    )
