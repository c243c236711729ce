from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wakeline.operators import quality as q


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [(1, 10.0), (1, 10.0), (None, 20.0), (None, None), (2, -5.0)], "k long, v double"
    )


def verdicts(frame, *checks):
    return [(r["name"], r["passed"], r["detail"]) for r in q.run_checks(frame, "s", checks).collect()]


def test_each_check(frame):
    assert verdicts(
        frame,
        q.row_count(5),
        q.row_count(6),
        q.null_rate("k", 0.4),
        q.null_rate("k", 0.39),
        q.duplicate_rate(["k", "v"], 0.2),
        q.duplicate_rate(["k"], 0.3),
        q.value_range("v", -5, 20),
        q.value_range("v", 0, 15),
        q.completeness(frame.columns, ["k", "x"]),
        q.completeness(frame.columns, ["k"]),
    ) == [
        ("row_count", True, "rows=5, min_required=5"),
        ("row_count", False, "rows=5, min_required=6"),
        ("null_rate_k", True, "null_rate=0.4000, max_allowed=0.4"),
        ("null_rate_k", False, "null_rate=0.4000, max_allowed=0.39"),
        ("duplicate_rate_k_v", True, "dup_rate=0.2000, max_allowed=0.2"),
        ("duplicate_rate_k", False, "dup_rate=0.4000, max_allowed=0.3"),
        ("range_v", True, "out_of_range=0, expected=[-5, 20]"),
        ("range_v", False, "out_of_range=2, expected=[0, 15]"),
        ("schema_completeness", False, "missing_columns=['x']"),
        ("schema_completeness", True, "all required columns present"),
    ]


def test_empty_frame_fails_rates_but_not_ranges(frame):
    empty = frame.where("v > 1000")
    assert [(p, d) for _, p, d in verdicts(
        empty, q.row_count(0), q.null_rate("k", 1.0), q.duplicate_rate(["k"], 1.0), q.value_range("v", 0, 1)
    )] == [
        (True, "rows=0, min_required=0"),
        (False, "empty DataFrame"),
        (False, "empty DataFrame"),
        (True, "out_of_range=0, expected=[0, 1]"),
    ]


def test_a_suite_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(
        F.col("id").alias("mmsi"), F.current_date().alias("activity_date"), F.col("id").alias("point_count")
    ).write.parquet(path)
    plan = q.activity_suite(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_missing_column_is_reported_not_raised(spark):
    report = q.bronze_suite(spark.range(3).select(F.col("id").alias("mmsi"))).collect()
    failed = {r["name"] for r in report if not r["passed"]}
    assert failed == {"row_count", "schema_completeness"}


def test_gate(frame):
    good = q.run_checks(frame, "s", [q.row_count(1)])
    assert q.require_passed(good) is good
    with pytest.raises(q.QualityError, match=r"s\.row_count: rows=5, min_required=9"):
        q.require_passed(q.run_checks(frame, "s", [q.row_count(9), q.null_rate("k", 1.0)]))


def test_summary(frame):
    checks = q.run_checks(frame, "s", [q.row_count(1), q.row_count(9), q.null_rate("k", 1.0)])
    assert q.quality_summary(checks).first().asDict() == {
        "stage": "s", "total_rows": 5, "checks_run": 3, "checks_passed": 2, "checks_failed": 1,
        "overall_passed": False,
    }


def test_key_violations(frame):
    rows = q.unique_key_violations(frame, ["k"]).collect()
    assert {(r["k"], r["row_count"]) for r in rows} == {(1, 2), (None, 2)}


def test_null_report(frame):
    report = {r["column_name"]: r for r in q.null_report(frame).collect()}
    assert (report["k"]["null_count"], report["k"]["null_rate"], report["k"]["total_rows"]) == (2, 0.4, 5)
    empty = q.null_report(frame.where("v > 1000")).collect()
    assert [(r["null_count"], r["null_rate"]) for r in empty] == [(0, 0.0), (0, 0.0)]


def test_profile(frame):
    profile = {r["column_name"]: r for r in q.profile_columns(frame).collect()}
    v = profile["v"]
    assert (v["dtype"], v["null_count"], v["null_rate"], v["unique_count"]) == ("double", 1, 0.2, 3)
    assert v["sample_values"] == ["-5.0", "10.0", "20.0"]
    assert q.profile_columns(frame.where("v > 1000")).count() == 0
    nothing = frame.select(F.lit(None).cast("string").alias("n"))
    assert q.profile_columns(nothing).first()["sample_values"] == []
