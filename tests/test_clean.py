from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wakeline.functions.geo import great_circle_nm, is_moving
from wakeline.functions.times import date_from_file_name, date_parts, epoch_seconds, parse_event_time
from wakeline.operators import clean
from wakeline.schema import LEGACY_NAMES, POSITION_SCHEMA, REPORT_SCHEMA


@pytest.fixture(scope="module")
def sample(spark):
    """The six rows of the rules' own unit case."""
    return spark.createDataFrame(
        [
            (123456789, 29.5, -89.5, 10.0),
            (987654321, 91.0, -89.5, 10.0),
            (111222333, 29.5, -181.0, 10.0),
            (444555666, 29.5, -89.5, 200.0),
            (None, 29.5, -89.5, 10.0),
            (12345, 29.5, -89.5, 10.0),
        ],
        "mmsi long, latitude double, longitude double, sog double",
    )


@pytest.mark.parametrize(
    "check, kept",
    [
        (clean.validate_coordinates, 4),
        (clean.validate_sog, 5),
        (clean.validate_mmsi, 4),
        (clean.validate_row, 1),
    ],
)
def test_validation_counts(sample, check, kept):
    assert check(sample).count() == kept


def test_limits_are_inclusive_where_they_should_be(spark):
    rows = [(90.0, 180.0), (-90.0, -180.0), (90.0001, 0.0), (0.0, 180.0001)]
    frame = spark.createDataFrame(rows, "latitude double, longitude double")
    assert clean.validate_coordinates(frame).count() == 2
    speeds = spark.createDataFrame([(0.0,), (102.2,), (102.3,), (-0.1,), (None,)], "sog double")
    assert clean.validate_sog(speeds).count() == 3
    courses = spark.createDataFrame([(0.0,), (360.0,), (360.1,), (-1.0,), (None,)], "cog double")
    assert clean.validate_cog(courses).count() == 2


def test_sentinel_is_nulled_not_dropped(spark):
    speeds = spark.createDataFrame([(102.3,), (150.0,), (102.2,), (None,), (float("nan"),)], "sog double")
    assert [r[0] for r in clean.null_sentinel(speeds).collect()] == [None, None, 102.2, None, None]


def test_null_island_needs_both(spark):
    frame = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 0.0)], "latitude double, longitude double")
    assert clean.drop_null_island(frame).count() == 2


def test_mapping_covers_the_schema():
    assert set(LEGACY_NAMES.values()) == set(REPORT_SCHEMA.names)


@pytest.mark.parametrize(
    "text, strict, lenient",
    [
        ("2025-08-15T01:02:03", True, True),
        ("2025-08-15 01:02:03", True, True),
        (" 2025-08-15 01:02:03 ", False, True),
        ("2025-08-15T01:02:03.25", False, True),
        ("2025-08-15 01:02:03.25", False, False),
        ("2025-08-15", False, False),
        ("2025-02-30T01:02:03", False, False),
        ("2025-08-15T24:00:00", False, False),
        ("not-a-time", False, False),
        ("", False, False),
        (None, False, False),
    ],
)
def test_report_times(spark, text, strict, lenient):
    frame = spark.createDataFrame([(text,)], "t string")
    row = frame.select(
        parse_event_time(F.col("t")).alias("s"),
        parse_event_time(F.col("t"), lenient=True).alias("l"),
    ).first()
    assert (row["s"] is not None, row["l"] is not None) == (strict, lenient)


def test_times_do_not_depend_on_the_zone(spark):
    """02:30 does not exist on this day in the session's zone."""
    texts = ["2024-03-10T01:30:00", "2024-03-10T02:30:00", "2024-03-10T03:30:00"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    times = frame.select(parse_event_time(F.col("t")).alias("t"))
    assert [r[0].isoformat() for r in times.collect()] == texts
    seconds = [r[0] for r in times.select(epoch_seconds(F.col("t"))).collect()]
    assert seconds[2] - seconds[0] == 7200
    assert seconds[0] == int(dt.datetime(2024, 3, 10, 1, 30, tzinfo=dt.UTC).timestamp())


def test_file_dates(spark):
    frame = spark.createDataFrame(
        [("ais-2025-08-15.csv.zst",), ("ais-2025-01-01.csv.zst",), ("random_file.csv",)], "n string"
    )
    dates = frame.select(date_from_file_name(F.col("n")).alias("d"))
    assert [r[0] for r in dates.collect()] == ["2025-08-15", "2025-01-01", None]
    parts = dates.select(*date_parts(F.col("d"))).first()
    assert tuple(parts) == (2025, 8, 15)


def test_codes_written_as_decimals_and_junk(spark):
    frame = spark.createDataFrame(
        [("37.0", "x", "1e3", "366000001"), ("NaN", "", "junk", "36.5")],
        "vessel_type string, status string, sog string, mmsi string",
    )
    types = {"vessel_type": "int", "status": "int", "sog": "double", "mmsi": "bigint"}
    rows = [tuple(r) for r in clean.cast_columns(frame, types).collect()]
    assert rows == [(37, None, 1000.0, 366000001), (None, None, None, None)]


def _raw(spark, rows):
    filled = [{**{n: None for n in REPORT_SCHEMA.names}, **r} for r in rows]
    return spark.createDataFrame(filled, REPORT_SCHEMA)


def _report(**values):
    base = {"mmsi": 366000001, "base_date_time": "2025-08-15T00:00:00", "latitude": 25.0, "longitude": -90.0}
    return {**base, **values}


def test_silver_schema_and_survivor(spark):
    rows = [_report(sog=5.0, status=1), _report(sog=None, status=2), _report(sog=4.0, status=1)]
    silver = clean.build_silver(_raw(spark, rows), "2025-08-15")
    assert [f.name for f in silver.schema] == POSITION_SCHEMA.names
    assert [f.dataType for f in silver.schema] == [f.dataType for f in POSITION_SCHEMA]
    only = silver.collect()
    assert len(only) == 1
    assert only[0]["sog"] == 4.0  # as complete as the other, smaller
    reordered = clean.build_silver(_raw(spark, rows[::-1]), "2025-08-15").collect()
    assert reordered == only


def test_silver_of_many_days_equals_silver_per_day(spark):
    rows = [_report(sog=1.0), _report(sog=2.0)]
    both = _raw(spark, rows).withColumn(
        "source_date", F.when(F.col("sog") == 1.0, "2025-08-15").otherwise("2025-08-16")
    )
    apart = clean.build_silver(both.where("sog = 1.0"), "2025-08-15").union(
        clean.build_silver(both.where("sog = 2.0"), "2025-08-16")
    )
    assert sorted(clean.build_silver(both).collect()) == sorted(apart.collect())


def test_silver_is_idempotent(spark):
    rows = [_report(sog=float(i % 3), base_date_time=f"2025-08-15T00:00:{i % 7:02d}") for i in range(40)]
    silver = clean.build_silver(_raw(spark, rows), "2025-08-15")
    again = clean.deduplicate_positions(silver)
    assert sorted(silver.collect(), key=str) == sorted(again.collect(), key=str)


def test_great_circle(spark):
    pairs = [
        (29.5, -89.5, 29.5, -89.5, 0.0, 0.001),
        # New York to London, 5,570 km
        (40.7128, -74.0060, 51.5074, -0.1278, 5570.2 / 1.852, 1.0),
        (0.0, 0.0, 0.0, 1.0, 60.0, 1.0),
        (0.0, 0.0, 0.0, 180.0, 3.141592653589793 * 3440.065, 0.001),
        (0.0, 0.0, 0.0, -180.0, 3.141592653589793 * 3440.065, 0.001),
    ]
    frame = spark.createDataFrame(pairs, "a double, b double, c double, d double, nm double, tol double")
    a, b, c, d = (F.col(x) for x in "abcd")
    for row in frame.select("*", great_circle_nm(a, b, c, d).alias("there"),
                            great_circle_nm(c, d, a, b).alias("back")).collect():
        assert abs(row["there"] - row["nm"]) <= row["tol"]
        assert abs(row["there"] - row["back"]) <= 0.001
    nothing = frame.select(great_circle_nm(F.lit(None).cast("double"), b, c, d)).first()[0]
    assert nothing is None


@pytest.mark.parametrize(
    "sog, threshold, moving",
    [(0.0, 0.5, False), (0.3, 0.5, False), (0.5, 0.5, False), (5.0, 0.5, True), (0.8, 1.0, False), (1.5, 1.0, True)],
)
def test_moving(spark, sog, threshold, moving):
    assert spark.range(1).select(is_moving(F.lit(sog), threshold)).first()[0] is moving
