"""JDBC calls, checked on the writer they configure; no database is opened."""

from __future__ import annotations

import pytest

from wakeline.schema import ACTIVITY_SCHEMA
from wakeline.sources import jdbc


class Recorder:
    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


class Frame:
    def __init__(self):
        self.write = Recorder()
        self.selected = None

    def select(self, *names):
        self.selected = list(names)
        return self


DATABASE = jdbc.postgres("db", "tracks", "u", "p")


def test_overwrite_truncates_and_orders_columns():
    frame = Frame()
    jdbc.write_table(frame, DATABASE, "vessel_daily_activity")
    assert frame.selected == ACTIVITY_SCHEMA.names
    assert frame.write.calls == [
        ("mode", ("overwrite",), {}),
        ("option", ("truncate", True), {}),
        ("option", ("numPartitions", 16), {}),
        ("jdbc", ("jdbc:postgresql://db:5432/tracks", "vessel_daily_activity"),
         {"properties": {"user": "u", "password": "p", "driver": "org.postgresql.Driver"}}),
    ]


def test_load_skips_what_is_not_given():
    frames = {"route_metrics": Frame(), "vessel_metadata": None, "voyage_candidates": Frame()}
    assert jdbc.load_gold_tables(DATABASE, frames) == ["route_metrics", "voyage_candidates"]
    with pytest.raises(ValueError, match="not gold"):
        jdbc.load_gold_tables(DATABASE, {"other": Frame()})


def test_read_in_ranges_needs_bounds():
    class Spark:
        read = Recorder()

    jdbc.read_table(Spark, DATABASE, "route_metrics")
    jdbc.read_table(Spark, DATABASE, "vessel_metadata", "mmsi", (1, 9), 4)
    assert Spark.read.calls[0][2] == {"properties": dict(DATABASE.properties)}
    assert Spark.read.calls[1][2]["numPartitions"] == 4
    with pytest.raises(ValueError, match="bounds"):
        jdbc.read_table(Spark, DATABASE, "vessel_metadata", "mmsi")
