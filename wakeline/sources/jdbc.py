"""Serving database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from wakeline.schema import TABLES


@dataclass(frozen=True)
class Database:
    """Where to connect; properties hold user, password and driver."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)


def postgres(
    host: str, database: str, user: str, password: str, port: int = 5432
) -> Database:
    return Database(
        f"jdbc:postgresql://{host}:{port}/{database}",
        {"user": user, "password": password, "driver": "org.postgresql.Driver"},
    )


def write_table(
    frame: DataFrame,
    database: Database,
    table: str,
    mode: str = "overwrite",
    connections: int = 16,
) -> None:
    """Write one table.

    Overwriting truncates, which keeps the keys and indexes of the serving table.
    A known table is written with its declared columns, in their order. There are
    at most ``connections`` sessions at a time.
    """
    if table in TABLES:
        frame = frame.select(*TABLES[table][0].names)
    (
        frame.write.mode(mode)
        .option("truncate", True)
        .option("numPartitions", connections)
        .jdbc(database.url, table, properties=dict(database.properties))
    )


def load_gold_tables(database: Database, frames: Mapping[str, DataFrame | None]) -> list[str]:
    """Write the gold tables that are given; returns their names."""
    unknown = set(frames) - set(TABLES)
    if unknown:
        raise ValueError(f"not gold tables: {sorted(unknown)}")
    loaded = [table for table, frame in frames.items() if frame is not None]
    for table in loaded:
        write_table(frames[table], database, table)
    return loaded


def read_table(
    spark: SparkSession,
    database: Database,
    table: str,
    split_by: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 16,
) -> DataFrame:
    """Read one table, in parallel ranges of ``split_by`` when it is given."""
    properties = dict(database.properties)
    if split_by is None:
        return spark.read.jdbc(database.url, table, properties=properties)
    if bounds is None:
        raise ValueError("reading in ranges needs the bounds of the split column")
    lower, upper = bounds
    return spark.read.jdbc(
        database.url,
        table,
        column=split_by,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties,
    )
