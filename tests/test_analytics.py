from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wakeline.operators import analytics as an
from wakeline.operators import gold

ACTIVITY = [
    (366000001, dt.date(2025, 8, 15), 10, 4.005, 9.0),
    (366000001, dt.date(2025, 8, 16), 30, 6.0, 40.0),
    (366000002, dt.date(2025, 8, 15), 20, None, None),
    (366000003, dt.date(2025, 8, 15), 20, 0.0, 31.0),
    (366000004, dt.date(2025, 8, 15), 5, 12.0, 30.0),
]
METADATA = [
    (366000001, "DOLE Star", 70), (366000002, "Other (1)", None), (366000003, None, 70),
]


@pytest.fixture(scope="module")
def activity(spark):
    return spark.createDataFrame(
        ACTIVITY, "mmsi long, activity_date date, point_count long, avg_sog double, max_sog double"
    ).withColumns({"first_seen_time": F.col("activity_date").cast("timestamp_ntz"),
                   "last_seen_time": F.col("activity_date").cast("timestamp_ntz")})


@pytest.fixture(scope="module")
def metadata(spark):
    return spark.createDataFrame(METADATA, "mmsi long, vessel_name string, vessel_type int")


def ids(frame):
    return sorted(r["mmsi"] % 10 for r in frame.collect())


def test_activity_filters(activity):
    assert ids(an.filter_activity(activity, low=0.0, high=12.0)) == [1, 1, 3, 4]  # unknown speed drops
    assert ids(an.filter_activity(activity, dates=["2025-08-16"])) == [1]
    assert ids(an.filter_activity(activity)) == [1, 1, 2, 3, 4]
    assert ids(an.filter_activity(activity, dates=[])) == []


def test_mmsi_lookup(activity):
    assert ids(an.filter_mmsi(activity, " 366000002 ")) == [2]
    with pytest.raises(ValueError, match="number"):
        an.filter_mmsi(activity, "DOLE")


def test_name_search(activity, metadata):
    enriched = an.activity_enriched(activity, metadata)
    assert enriched.count() == len(ACTIVITY)
    assert ids(an.search_name(enriched, "dole")) == [1, 1]
    assert ids(an.search_name(enriched, "d.le|other")) == [1, 1, 2]
    assert ids(an.search_name(enriched, "(1)", regex=False)) == [2]
    assert ids(an.search_name(enriched, "d.le", regex=False)) == []
    voyages = activity.select("mmsi").distinct()
    assert ids(an.voyages_by_name(voyages, enriched, "STAR")) == [1]


def test_top_vessels_leave_out_the_nameless(activity, metadata):
    rows = an.top_active_vessels(an.activity_enriched(activity, metadata)).collect()
    assert [(r["mmsi"] % 10, r["total_points"], r["avg_speed"], r["max_speed"], r["days_active"])
            for r in rows] == [(1, 40, 5.0, 40.0, 2), (2, 20, None, None, 1)]


def test_types_keep_the_unknown_one(activity, metadata):
    rows = an.activity_by_vessel_type(activity, metadata).collect()
    assert [(r["vessel_type"], r["vessel_count"], r["avg_daily_points"]) for r in rows] == [
        (None, 2, 13.0), (70, 2, 20.0)
    ]


def test_anomalies_and_ties(activity, metadata):
    rows = an.speed_anomalies(activity, metadata).collect()
    assert [(r["mmsi"] % 10, r["max_sog"]) for r in rows] == [(1, 40.0), (3, 31.0)]
    top = an.top_vessels_on_date(activity, metadata, "2025-08-15", limit=3).collect()
    assert [r["mmsi"] % 10 for r in top] == [2, 3, 1]


@pytest.mark.parametrize(
    "speeds", [[0.0, 1.0, 2.5, 19.99, 20.0, 20.0], [3.0, 3.0], [0.0], [1.1, 7.3, 9.9, 0.04]]
)
def test_histogram_equals_pandas(spark, speeds):
    frame = spark.createDataFrame([(s,) for s in [*speeds, None]], "avg_sog double")
    got = [r["record_count"] for r in an.speed_histogram(frame).collect()]
    want = pd.cut(pd.Series(speeds), bins=20).value_counts().sort_index().tolist()
    assert got == want


def test_histogram_of_nothing(spark):
    assert an.speed_histogram(spark.createDataFrame([], "avg_sog double")).count() == 0


def test_speed_ratio(spark):
    frame = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "sog double")
    rows = {r["sog"]: r["speed_ratio"] for r in an.with_speed_ratio(frame).collect()}
    assert rows[95.0] == rows[100.0] == 1.0 and rows[None] is None
    assert rows[19.0] == pytest.approx(0.2)
    slow = spark.createDataFrame([(0.5,), (0.2,)], "sog double")
    assert an.with_speed_ratio(slow).first()["speed_ratio"] == 0.5  # one knot at least


def test_vessel_classes(spark):
    codes = {30: "fishing", 32: "fishing", 33: "other", 36: "sailing", 52: "tug", 61: "passenger",
             72: "cargo", 81: "tanker", 89: "tanker", 82: "other", 0: "other", None: "other"}
    frame = spark.createDataFrame([(c,) for c in codes], "vessel_type int")
    assert {r[0]: r[1] for r in an.with_vessel_class(frame).collect()} == codes


def test_map_points(spark):
    frame = spark.createDataFrame(
        [(1.0, 2.0, None, None), (None, 2.0, 1.0, 70)],
        "latitude double, longitude double, sog double, vessel_type int",
    )
    assert [tuple(r) for r in an.map_points(frame).collect()] == [(1.0, 2.0, 0.0, 0)]


def test_track_points_are_ordered_and_filled(spark):
    frame = spark.createDataFrame(
        [(366000001, dt.datetime(2025, 8, 16), 1.0, 2.0, None), (366000001, dt.datetime(2025, 8, 15), 3.0, 4.0, 5.0),
         (366000002, dt.datetime(2025, 8, 15), 3.0, 4.0, 5.0)],
        "mmsi long, event_time timestamp_ntz, longitude double, latitude double, sog double",
    )
    assert [(r["longitude"], r["sog"]) for r in an.track_points(frame, "366000001").collect()] == [(3.0, 5.0), (1.0, 0.0)]


def test_metadata_prefers_complete_then_latest(spark):
    rows = [
        (366000001, "2025-08-15T00:00:00", "OLD", "IMO1", 70),
        (366000001, "2025-08-16T00:00:00", "NEW", "IMO1", 70),
        (366000001, "2025-08-17T00:00:00", "LATEST", None, 70),
        (366000002, "not-a-time", None, None, None),
        (None, "2025-08-17T00:00:00", "X", "Y", 1),
    ]
    frame = spark.createDataFrame(
        rows, "mmsi long, base_date_time string, vessel_name string, imo string, vessel_type int"
    )
    got = gold.vessel_metadata(frame)
    assert got.columns == ["mmsi", "vessel_name", "imo", "vessel_type"]  # only what is there
    assert sorted(tuple(r) for r in got.collect()) == [
        (366000001, "NEW", "IMO1", 70), (366000002, None, None, None)
    ]


def test_means_round_half_up_whatever_the_order(spark):
    from wakeline.functions.exact import exact_mean

    frame = spark.createDataFrame([(8.90,), (8.91,)], "x double")
    assert frame.agg(exact_mean(F.col("x"))).first()[0] == 8.91
    many = spark.range(100_000).select((F.rand(3) * 20).alias("x")).cache()
    plain = many.repartition(13).agg(exact_mean(F.col("x"), 6)).first()[0]
    assert plain == many.orderBy("x").coalesce(2).agg(exact_mean(F.col("x"), 6)).first()[0]
    assert many.where("x < 0").agg(exact_mean(F.col("x"))).first()[0] is None
