from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.operators import sampling
from wakeline.operators.quantiles import exact_quantile, exact_quantiles, ordered_bits


@pytest.fixture(scope="module")
def points(spark):
    """One date holds most of the rows."""
    return (
        spark.range(6000)
        .select(
            (F.col("id") % 50 + 366000000).alias("mmsi"),
            (F.lit("2025-08-15").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("event_time"),
            F.when(F.col("id") < 5000, "2025-08-15").when(F.col("id") < 5990, "2025-08-16")
            .otherwise("2025-08-17").alias("source_date"),
            (F.col("id") * 37 % 1000 / 10).alias("sog"),
        )
        .repartition(7)
        .cache()
    )


def smallest(rows, n):
    def rank(row):
        return hashlib.md5(f"42|{row['mmsi']}|{row['event_time']}".encode()).hexdigest()

    return {(r["mmsi"], r["event_time"]) for r in sorted(rows, key=rank)[:n]}


def keys(frame):
    return {(r["mmsi"], r["event_time"]) for r in frame.collect()}


@pytest.mark.parametrize("digits", [1, 2, 4, 8])
@pytest.mark.parametrize("n", [1, 20, 990, 4999, 10_000])
def test_stratified_takes_the_smallest_hashes(points, n, digits):
    rows = points.collect()
    got = sampling.stratified_sample(points, n, prefix_digits=digits)
    want = set()
    for date in {r["source_date"] for r in rows}:
        want |= smallest([r for r in rows if r["source_date"] == date], n)
    assert got.columns == points.columns
    collected = got.collect()
    assert len(collected) == len(want)
    assert keys(got) == want


def test_capped_and_order_independent(points):
    rows = points.collect()
    assert keys(sampling.capped_sample(points, 500)) == smallest(rows, 500)
    shuffled = points.orderBy(F.desc("sog")).repartition(3)
    assert keys(sampling.capped_sample(shuffled, 500)) == smallest(rows, 500)
    assert sampling.capped_sample(points, 10_000).count() == 6000
    assert sampling.capped_sample(points.where("sog < 0"), 5).count() == 0
    assert sampling.capped_sample(points, 0).count() == 0


def test_null_stratum_is_a_stratum(points):
    frame = points.withColumn("source_date", F.nullif("source_date", F.lit("2025-08-16")))
    got = sampling.stratified_sample(frame, 7).groupBy("source_date").count().collect()
    assert sorted(r["count"] for r in got) == [7, 7, 7]


def test_building_a_sample_starts_no_job(spark, points):
    points.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building a sample")
    sampling.stratified_sample(points, 20)
    sampling.capped_sample(points, 20)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("building")) == 0


def test_rows_equal_in_the_key_are_told_apart(spark):
    rows = [(1, "2025-08-15T00:00:00", f"2025-08-{15 + i % 3}", float(i)) for i in range(60)]
    frame = spark.createDataFrame(rows, "mmsi long, event_time string, source_date string, sog double")
    for sample in (
        lambda f: sampling.capped_sample(f, 10),
        lambda f: sampling.stratified_sample(f, 5),
        lambda f: sampling.proportional_sample(f, 12, minimum=1),
    ):
        one = sorted(sample(frame.orderBy("sog").coalesce(1)).collect())
        two = sorted(sample(frame.orderBy(F.desc("sog")).repartition(5)).collect())
        assert one == two and one


def test_daily_sample_keeps_the_layout(points):
    full = points.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(2.0), "vessel_type": F.lit(70)})
    sample = sampling.daily_position_sample(full, 30)
    assert sample.columns == [*sampling.SAMPLE_COLUMNS, "source_date"]
    assert keys(sample) == keys(sampling.stratified_sample(points, 30))


def test_proportional_share(points):
    per_date = {
        r["source_date"]: r["count"]
        for r in sampling.proportional_sample(points, 3300, minimum=100).groupBy("source_date").count().collect()
    }
    assert per_date == {"2025-08-15": 1100, "2025-08-16": 990, "2025-08-17": 10}
    assert sampling.proportional_sample(points, 300, minimum=1000).count() == 300


@pytest.mark.parametrize("fraction, bits", [(0.0, 16), (0.25, 16), (0.5, 11), (0.95, 16), (1.0, 16)])
def test_quantiles_equal_numpy(spark, fraction, bits):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 1000, 301), np.full(200, 3.25), [1e9]])
    other = rng.integers(0, 5, len(values)).astype(float)
    frame = spark.createDataFrame(
        [(float(a), float(b)) for a, b in zip(values, other)] + [(None, None), (float("nan"), None)],
        "a double, b double",
    )
    got = {r["name"]: r["quantile"] for r in exact_quantiles(frame, ["a", "b"], fraction, bits).collect()}
    assert got["a"] == pytest.approx(np.quantile(values, fraction), rel=1e-12)
    assert got["b"] == pytest.approx(np.quantile(other, fraction), rel=1e-12)


def test_quantiles_with_one_value_far_out(spark):
    """Nearly all values share the first bin and are split again."""
    values = [i / 7 for i in range(20_000)] + [1e12]
    frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    for fraction in (0.01, 0.5, 0.95, 1.0):
        got = exact_quantile(frame, "x", fraction).first()[0]
        assert got == pytest.approx(np.quantile(values, fraction), rel=1e-12)


def test_ordered_bits_are_those_of_the_double(spark):
    rng = np.random.default_rng(3)
    powers = 2.0 ** np.arange(-1074, 1024)
    values = np.concatenate(
        [rng.integers(-(2**63), 2**63, 20_000).view(np.float64), rng.normal(0, 1000, 2000), powers,
         np.nextafter(powers, 0), np.nextafter(powers, np.inf), [0.0, -0.0, np.inf, -np.inf, 5e-324, 1.7976931348623157e308]]
    )
    values = values[~np.isnan(values)]
    frame = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = frame.select("x", ordered_bits(F.col("x")).alias("bits")).collect()
    sizes = np.abs(values).view(np.int64)
    want = dict(zip(values.tolist(), np.where(values < 0, -sizes, sizes).tolist()))
    assert all(r["bits"] == want[r["x"]] for r in got)


def test_quantiles_with_values_far_out_at_every_scale(spark):
    """However the values are spread, the last pass has one value for each rank."""
    rng = np.random.default_rng(9)
    values = np.concatenate([rng.normal(0, 1, 5000), [1e30, 1e20, -1e300, 1e-300, 1e5, -1e12], rng.integers(0, 3, 50)])
    frame = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(3)
    for fraction in (0.0005, 0.5, 0.95, 0.999, 1.0):
        got = exact_quantile(frame, "x", fraction).first()[0]
        assert got == pytest.approx(np.quantile(values, fraction), rel=1e-12)
    far = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,)], "x double")
    assert exact_quantile(far, "x", 1.0).first()[0] == float("inf")


def test_quantile_of_one_value_and_of_none(spark):
    one = spark.createDataFrame([(4.5,)], "x double")
    assert exact_quantile(one, "x", 0.95).first()[0] == 4.5
    assert exact_quantile(one.where("x < 0"), "x", 0.95).first()[0] is None
