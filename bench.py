"""Headline queries, timed: prints one JSON line.

Each query is run once to warm up and then three times; the median counts. The
scaled part makes ``BENCH_COPIES`` reports of every one and runs bronze to gold
over them by way of Parquet, as rows per second.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import bridge
import entry_queries
from wakeline.functions.times import parse_event_time
from wakeline.operators import clean, gold
from wakeline.operators import voyages as vy
from wakeline.plans import daily
from wakeline.schema import REPORT_SCHEMA
from wakeline.sources.ingest import ingest_pending
from wakeline.sources.tables import read_bronze

HEADLINE = [
    "build_silver",
    "dedup_positions",
    "daily_activity",
    "voyage_candidates",
    "voyage_segments",
    "voyage_sessions",
    "time_gaps",
    "distance_nm",
    "vessel_metadata",
    "route_metrics",
    "activity_enriched",
    "activity_by_vessel_type",
    "top_active_vessels",
    "speed_histogram",
    "speed_ratio",
    "map_center",
    "kpi_summary",
    "stratified_sample",
    "capped_sample",
    "vessel_track",
    "quality_silver",
    "null_report",
    "profile_columns",
    "manifest_latest",
]


def session() -> SparkSession:
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(frame: DataFrame) -> float:
    start = time.perf_counter()
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(make, repeats: int = 3) -> float:
    run(make())
    return statistics.median(run(make()) for _ in range(repeats))


def dense(reports: DataFrame, times: int) -> DataFrame:
    """Every report followed by more of its vessel, ten seconds apart, as real tracks are."""
    later = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    time = parse_event_time(F.col("base_date_time"))
    moved = (time + F.make_dt_interval(secs=F.col("_i") * 10)).cast("string")
    return (
        reports.withColumn("_i", later)
        .withColumns(
            {
                "base_date_time": F.coalesce(moved, F.col("base_date_time")),
                "longitude": F.col("longitude") + F.col("_i") * 0.001,
            }
        )
        .drop("_i")
    )


def scaled(spark: SparkSession, sf_dir: str, times: int) -> dict[str, float]:
    """Bronze to gold by way of Parquet, as a run does it."""
    folder = bridge.scratch(spark)
    bronze_path, silver_path = f"{folder}/bronze", f"{folder}/silver"
    # as many files as a month of daily ones
    many = dense(bridge.bronze(spark, sf_dir), times).drop("report_id").repartition(30)
    many.write.parquet(bronze_path)
    bronze = spark.read.parquet(bronze_path)
    rows = bronze.count()
    out = {"rows": rows}

    start = time.perf_counter()
    clean.build_silver(bronze).write.parquet(silver_path)
    out["silver_sec"] = time.perf_counter() - start
    silver = spark.read.parquet(silver_path)
    start = time.perf_counter()
    gold.daily_activity(silver).write.parquet(f"{folder}/activity")
    out["activity_sec"] = time.perf_counter() - start
    start = time.perf_counter()
    voyages = vy.voyage_candidates(silver, entry_queries.RULES)
    voyages.write.parquet(f"{folder}/voyages")
    out["voyages_sec"] = time.perf_counter() - start
    start = time.perf_counter()
    gold.vessel_metadata(bronze).write.parquet(f"{folder}/metadata")
    gold.route_metrics(spark.read.parquet(f"{folder}/voyages")).write.parquet(f"{folder}/routes")
    out["metadata_routes_sec"] = time.perf_counter() - start
    spent = out["silver_sec"] + out["activity_sec"] + out["voyages_sec"]
    out["silver_gold_rows_per_sec"] = rows / spent
    return {k: round(v, 3) for k, v in out.items()}


def daily_files(frame: DataFrame, folder: str) -> None:
    """One compressed file for every source date, as they are delivered."""
    os.makedirs(folder)
    for day in frame.select("source_date").distinct().toPandas()["source_date"]:
        rows = frame.where(F.col("source_date") == day).select(*REPORT_SCHEMA.names).toPandas()
        text = rows.to_csv(index=False).encode()
        with open(f"{folder}/ais-{day}.csv.zst", "wb") as out:
            out.write(zstandard.ZstdCompressor().compress(text))


def incremental(spark: SparkSession, sf_dir: str, times: int) -> dict[str, float]:
    """Raw files to bronze, a whole run, and one day again on that history."""
    folder = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    raw, root = f"{folder}/raw", f"{folder}/lake"
    daily_files(dense(bridge.bronze(spark, sf_dir), times), raw)
    out = {}

    def clocked(name: str, step) -> None:
        start = time.perf_counter()
        step()
        out[f"{name}_sec"] = time.perf_counter() - start

    rules = entry_queries.RULES
    clocked("raw_to_bronze", lambda: ingest_pending(spark, raw, root))
    out["rows"] = read_bronze(spark, root).count()
    out["raw_to_bronze_rows_per_sec"] = out["rows"] / out["raw_to_bronze_sec"]
    clocked("run_all", lambda: daily.run_all(spark, root, rules=rules, gate=False))
    clocked("run_day", lambda: daily.run_day(spark, root, entry_queries.DAY, rules=rules, gate=False))
    return {k: round(v, 3) for k, v in out.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    times = int(os.environ.get("BENCH_COPIES", "60"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = session()
    seconds = {
        name: round(timed(lambda: entry_queries.QUERIES[name](spark, sf_dir)), 3) for name in names
    }
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if times > 1:
        result["scaled"] = scaled(spark, sf_dir, times)
        result["incremental"] = incremental(spark, sf_dir, max(2, times // 6))
    print(json.dumps(result))


if __name__ == "__main__":
    main()
