"""Stage metrics of a run and their summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions.exact import to_micro
from wakeline.schema import STAGE_METRICS_SCHEMA


@dataclass
class Stage:
    """One stage of a run; the caller fills in the row counts, and why it was skipped."""

    run_id: str
    stage: str
    started_at: dt.datetime
    completed_at: dt.datetime | None = None
    duration_seconds: float = 0.0
    input_rows: int | None = None
    output_rows: int | None = None
    status: str = "running"
    error: str | None = None


@contextmanager
def track_stage(spark: SparkSession, path: str, run_id: str, name: str) -> Iterator[Stage]:
    """Time a stage and append its outcome to the metrics table, failed or not."""
    stage = Stage(run_id, name, _now())
    try:
        yield stage
        if stage.status == "running":
            stage.status = "success"
    except Exception as error:
        stage.status, stage.error = "failed", str(error)
        raise
    finally:
        stage.completed_at = _now()
        seconds = (stage.completed_at - stage.started_at).total_seconds()
        stage.duration_seconds = round(seconds, 2)
        row = spark.createDataFrame([asdict(stage)], STAGE_METRICS_SCHEMA)
        row.write.mode("append").parquet(path)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


def run_summary(stages: DataFrame) -> DataFrame:
    """One row per run: its start, stages, total time and outcomes."""
    return stages.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"),
        F.count(F.lit(1)).alias("total_stages"),
        F.round(F.sum(to_micro(F.col("duration_seconds"))) / 1_000_000, 2).alias(
            "total_duration_seconds"
        ),
        F.count_if(F.col("status") == "success").alias("stages_passed"),
        F.count_if(F.col("status") == "failed").alias("stages_failed"),
    )


def run_stages(stages: DataFrame) -> DataFrame:
    """Stage, duration and status of every run, in order of start."""
    return stages.select(
        "run_id", "stage", "started_at", "duration_seconds", "status"
    ).orderBy("run_id", "started_at")
