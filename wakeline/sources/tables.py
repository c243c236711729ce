"""Layers as Parquet tables under one root: scans, sinks and catalog entries."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.schema import (
    BRONZE_SCHEMA,
    TABLES,
    create_table_sql,
)

GOLD_TABLES = ["vessel_metadata", "vessel_daily_activity", "voyage_candidates", "route_metrics"]
BRONZE_PARTITIONS = ["year", "month", "day"]


def choose_root(bucket: str | None, local: str) -> str:
    """The object store when a bucket is configured, else the local folder.

    Credentials are the cluster's configuration and no business of the library.
    """
    if not bucket:
        return local.rstrip("/")
    name = bucket.removeprefix("s3://").removeprefix("s3a://").rstrip("/")
    return f"s3a://{name}"


def manifest_path(root: str) -> str:
    return state_path(root, "manifest")


def state_path(root: str, name: str) -> str:
    """Where bookkeeping and mergeable intermediate tables live."""
    return f"{root.rstrip('/')}/state/{name}"


def layer_path(root: str, table: str) -> str:
    """Where a layer lives under ``root``, a path or an object-store address."""
    folder = {"bronze": "bronze", "vessel_positions": "silver", "silver_sample": "silver_sample"}
    return f"{root.rstrip('/')}/{folder.get(table, f'gold/{table}')}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names."""
    files, at = _file_system(spark, path)
    return files.exists(at(path))


# --- scans -------------------------------------------------------------------


def read_bronze(spark: SparkSession, root: str, source_date: str | None = None) -> DataFrame:
    frame = spark.read.schema(BRONZE_SCHEMA).parquet(layer_path(root, "bronze"))
    return frame if source_date is None else on_source_date(frame, source_date)


def on_source_date(bronze: DataFrame, source_date: str) -> DataFrame:
    """Rows of one day by the partition columns, so other days are not listed or read."""
    day = dt.date.fromisoformat(source_date)
    return bronze.where(
        (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
    )


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A silver or gold layer with its declared types, partition columns included."""
    schema, _, _ = TABLES[table]
    return spark.read.schema(schema).parquet(layer_path(root, table))


def read_positions(spark: SparkSession, root: str, source_date: str | None = None) -> DataFrame:
    positions = read_table(spark, root, "vessel_positions")
    if source_date is None:
        return positions
    return positions.where(F.col("source_date") == F.lit(source_date))


def resolve_positions(spark: SparkSession, root: str) -> DataFrame:
    """The full silver layer where there is one, else the committed sample."""
    if path_exists(spark, layer_path(root, "vessel_positions")):
        return read_positions(spark, root)
    return spark.read.parquet(layer_path(root, "silver_sample")).withColumn(
        "source_date", F.col("source_date").cast("string")
    )


# --- sinks -------------------------------------------------------------------


def write_partitioned(frame: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace the partitions present in ``frame`` and leave the others."""
    (
        frame.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def replace_partitions(
    frame: DataFrame,
    path: str,
    partitions: list[str],
    requested: Iterable[Sequence],
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Replace the requested partitions, dropping those that ``frame`` has no rows for.

    ``requested`` has a value for each partition column. The rows are written to a
    staging place of this call's own and, if ``check`` lets them pass, moved from there,
    so they are written once and runs of other partitions do not meet. A run that
    breaks off while moving is mended by running it again.
    """
    spark = frame.sparkSession
    staged = staging_path(path)
    frame.write.partitionBy(*partitions).parquet(staged)
    if check is not None:
        check(spark.read.schema(frame.schema).parquet(staged))
    move_partitions(spark, staged, path, partitions, requested)
    drop_path(spark, staged)


def replace_table(
    frame: DataFrame,
    path: str,
    partitions: list[str] | None = None,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Replace the whole table by way of a staging place, if ``check`` lets it pass."""
    spark = frame.sparkSession
    staged = staging_path(path)
    write_full(frame, staged, partitions)
    if check is not None:
        check(spark.read.schema(frame.schema).parquet(staged))
    files, at = _file_system(spark, path)
    files.delete(at(path), True)
    _rename(files, at(staged), at(path))


def staging_path(path: str) -> str:
    """A new staging place beside the layers, so that no other run writes or clears it."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/staging/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    files, at = _file_system(spark, path)
    files.delete(at(path), True)


def move_partitions(
    spark: SparkSession,
    staged: str,
    path: str,
    partitions: list[str],
    requested: Iterable[Sequence],
    within: str = "",
) -> None:
    """Put staged partitions, those ``within`` a folder of the staging place, in place of the requested.

    Nothing is deleted unless the staging place is there: without it a run cannot tell a
    partition that lost its rows from one whose rows were lost on the way.
    """
    files, at = _file_system(spark, path)
    if not files.exists(at(staged)):
        raise FileNotFoundError(f"nothing is staged at {staged}")
    staged = f"{staged}/{within}".rstrip("/")
    folders = ["/".join(f"{n}={v}" for n, v in zip(partitions, values)) for values in requested]
    present = {folder for folder in folders if files.exists(at(f"{staged}/{folder}"))}
    for folder in folders:
        target = at(f"{path}/{folder}")
        files.delete(target, True)
        if folder in present:
            _rename(files, at(f"{staged}/{folder}"), target)
    # a table may be left without any partition and is still a table
    files.mkdirs(at(path))


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def _rename(files, source, target) -> None:
    files.mkdirs(target.getParent())
    if files.exists(target):  # a rename would put the rows inside it
        raise FileExistsError(f"another run has written {target} meanwhile")
    if not files.rename(source, target):
        raise OSError(f"could not move {source} to {target}")


def write_full(frame: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """Replace the whole table."""
    writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)


# --- catalog -----------------------------------------------------------------


def register_tables(spark: SparkSession, root: str, database: str | None = None) -> None:
    """Create external tables over the silver and gold layers."""
    for table in TABLES:
        spark.sql(create_table_sql(table, layer_path(root, table), database))


def repair_tables(spark: SparkSession, database: str | None = None) -> None:
    """Make the catalog see every partition on storage."""
    for table, (_, partitions, _) in TABLES.items():
        if partitions:
            name = f"{database}.{table}" if database else table
            spark.sql(f"MSCK REPAIR TABLE {name}")
