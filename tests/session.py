"""The Spark session tests and benchmarks run in."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def make_session(cores: int | str = 8, timezone: str = "America/New_York") -> SparkSession:
    """A local session. The zone is not UTC on purpose: no result may depend on it."""
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wakeline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", timezone)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-warehouse-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
