"""Schemas, column names and table definitions of every layer."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_LONG, _INT, _DOUBLE = T.LongType(), T.IntegerType(), T.DoubleType()
_TEXT, _TIME, _DATE = T.StringType(), T.TimestampNTZType(), T.DateType()

REPORT_SCHEMA = _struct(
    ("mmsi", _LONG),
    ("base_date_time", _TEXT),
    ("longitude", _DOUBLE),
    ("latitude", _DOUBLE),
    ("sog", _DOUBLE),
    ("cog", _DOUBLE),
    ("heading", _DOUBLE),
    ("vessel_name", _TEXT),
    ("imo", _TEXT),
    ("call_sign", _TEXT),
    ("vessel_type", _INT),
    ("status", _INT),
    ("length", _DOUBLE),
    ("width", _DOUBLE),
    ("draft", _DOUBLE),
    ("cargo", _INT),
    ("transceiver", _TEXT),
)

# Header names of older raw files and the names used here.
LEGACY_NAMES = {
    "MMSI": "mmsi",
    "BaseDateTime": "base_date_time",
    "LAT": "latitude",
    "LON": "longitude",
    "SOG": "sog",
    "COG": "cog",
    "Heading": "heading",
    "VesselName": "vessel_name",
    "IMO": "imo",
    "CallSign": "call_sign",
    "VesselType": "vessel_type",
    "Status": "status",
    "Length": "length",
    "Width": "width",
    "Draft": "draft",
    "Cargo": "cargo",
    "TransceiverClass": "transceiver",
}

BRONZE_SCHEMA = T.StructType(
    REPORT_SCHEMA.fields
    + _struct(("source_date", _TEXT), ("year", _INT), ("month", _INT), ("day", _INT)).fields
)

POSITION_SCHEMA = _struct(
    ("mmsi", _LONG),
    ("event_time", _TIME),
    ("latitude", _DOUBLE),
    ("longitude", _DOUBLE),
    ("sog", _DOUBLE),
    ("cog", _DOUBLE),
    ("heading", _DOUBLE),
    ("vessel_type", _INT),
    ("status", _INT),
    ("draft", _DOUBLE),
    ("cargo", _INT),
    ("source_date", _TEXT),
)

METADATA_SCHEMA = _struct(
    ("mmsi", _LONG),
    ("vessel_name", _TEXT),
    ("imo", _TEXT),
    ("call_sign", _TEXT),
    ("vessel_type", _INT),
    ("length", _DOUBLE),
    ("width", _DOUBLE),
    ("transceiver", _TEXT),
)

ACTIVITY_SCHEMA = _struct(
    ("mmsi", _LONG),
    ("point_count", _LONG),
    ("avg_sog", _DOUBLE),
    ("max_sog", _DOUBLE),
    ("min_sog", _DOUBLE),
    ("first_seen_time", _TIME),
    ("last_seen_time", _TIME),
    ("activity_date", _DATE),
)

VOYAGE_SCHEMA = _struct(
    ("mmsi", _LONG),
    ("start_time", _TIME),
    ("end_time", _TIME),
    ("start_longitude", _DOUBLE),
    ("start_latitude", _DOUBLE),
    ("end_longitude", _DOUBLE),
    ("end_latitude", _DOUBLE),
    ("point_count", _LONG),
    ("avg_sog", _DOUBLE),
    ("duration_hours", _DOUBLE),
    ("candidate_route_type", _TEXT),
    ("start_date", _DATE),
)

ROUTE_SCHEMA = _struct(
    ("route_id", _TEXT),
    ("candidate_route_type", _TEXT),
    ("vessel_count", _LONG),
    ("avg_duration_hours", _DOUBLE),
    ("avg_speed", _DOUBLE),
    ("point_count", _LONG),
    ("metric_date", _DATE),
)

MANIFEST_SCHEMA = _struct(
    ("file_name", _TEXT),
    ("ingested_at", _TIME),
    ("row_count", _LONG),
    ("source_date", _TEXT),
    ("status", _TEXT),
    ("error", _TEXT),
)

STAGE_METRICS_SCHEMA = _struct(
    ("run_id", _TEXT),
    ("stage", _TEXT),
    ("started_at", _TIME),
    ("completed_at", _TIME),
    ("duration_seconds", _DOUBLE),
    ("input_rows", _LONG),
    ("output_rows", _LONG),
    ("status", _TEXT),
    ("error", _TEXT),
)

SAMPLE_COLUMNS = ["mmsi", "latitude", "longitude", "sog", "vessel_type", "event_time"]
METADATA_FIELDS = [name for name in METADATA_SCHEMA.names if name != "mmsi"]
POSITION_COLUMNS = [name for name in POSITION_SCHEMA.names if name != "source_date"]

# table -> (schema, partition columns, key columns)
TABLES: dict[str, tuple[T.StructType, list[str], list[str]]] = {
    "vessel_positions": (POSITION_SCHEMA, ["source_date"], ["mmsi", "event_time", "source_date"]),
    "vessel_metadata": (METADATA_SCHEMA, [], ["mmsi"]),
    "vessel_daily_activity": (ACTIVITY_SCHEMA, ["activity_date"], ["mmsi", "activity_date"]),
    "voyage_candidates": (VOYAGE_SCHEMA, ["start_date"], ["mmsi", "start_time"]),
    "route_metrics": (ROUTE_SCHEMA, ["metric_date"], ["route_id"]),
}


def create_table_sql(table: str, location: str, database: str | None = None) -> str:
    """DDL of an external Parquet table, generated from the layer's schema."""
    schema, partitions, _ = TABLES[table]
    name = f"{database}.{table}" if database else table
    columns = ",\n  ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f"\nPARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    escaped = location.replace("\\", "\\\\").replace("'", "\\'")
    return (
        f"CREATE TABLE IF NOT EXISTS {name} (\n  {columns}\n)\nUSING parquet"
        f"{partitioned}\nLOCATION '{escaped}'"
    )
