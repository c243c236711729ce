"""Summaries by day against the same figures worked out from all rows."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import entry_queries as q
from wakeline.operators import analytics as an
from wakeline.operators import gold, quality, sampling, summaries
from wakeline.plans.summaries import Profiles, Samples, VesselDays
from wakeline.sources.tables import layer_path, read_positions, replace_partitions, write_full

SF = "/root/testdata/sf0.001"


def same(left, right) -> bool:
    return Counter(left.collect()) == Counter(right.select(*left.columns).collect())


@pytest.fixture(scope="module")
def silver(spark):
    return q.silver(spark, SF).cache()


@pytest.fixture(scope="module")
def lake(spark, silver, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    write_full(silver, layer_path(root, "vessel_positions"), ["source_date"])
    write_full(q.activity(spark, SF), layer_path(root, "vessel_daily_activity"), ["activity_date"])
    write_full(q.voyages(spark, SF), layer_path(root, "voyage_candidates"), ["start_date"])
    write_full(q.metadata(spark, SF), layer_path(root, "vessel_metadata"))
    return root


def test_profile_of_merged_days(spark, silver):
    days = summaries.column_summaries(silver)
    assert days.count() == silver.select("source_date").distinct().count() * (len(silver.columns) - 1)
    got = {r["column_name"]: r for r in summaries.profile_of(days).collect()}
    want = {r["column_name"]: r for r in quality.profile_columns(silver).collect()}
    for name in set(silver.columns) - {"source_date"}:
        ends = silver.agg(*[f(F.col(name).cast("string")) for f in (F.min, F.max)]).first()
        row = got[name]
        assert (row["smallest"], row["largest"]) == tuple(ends)
        assert (row["dtype"], row["null_count"], row["null_rate"]) == (
            want[name]["dtype"], want[name]["null_count"], want[name]["null_rate"])
        assert row["total_rows"] == silver.count()
        assert abs(row["unique_estimate"] - want[name]["unique_count"]) <= 0.07 * want[name]["unique_count"]


def test_profile_of_nothing_nulls_and_empty_text(spark):
    frame = spark.createDataFrame(
        [("a", None, ""), ("a", None, "x"), ("b", None, "")], "day string, none string, text string"
    )
    got = {r["column_name"]: r for r in summaries.profile_of(summaries.column_summaries(frame, ["day"])).collect()}
    assert (got["none"]["null_count"], got["none"]["unique_estimate"], got["none"]["smallest"]) == (3, 0, None)
    assert (got["text"]["null_count"], got["text"]["unique_estimate"], got["text"]["smallest"]) == (0, 2, "")
    assert summaries.column_summaries(frame.where("false"), ["day"]).isEmpty()
    assert summaries.column_summaries(frame.where("false"), []).isEmpty()


def test_one_scan(spark, lake):
    plan = summaries.column_summaries(read_positions(spark, lake))._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Scan parquet") == 1


def test_route_metrics_and_types_from_days(spark):
    voyages, enriched = q.voyages(spark, SF), q.enriched(spark, SF)
    assert same(gold.route_metrics(voyages), summaries.route_metrics_of(summaries.route_days(voyages)))
    types = summaries.activity_by_vessel_type_of(summaries.activity_days(enriched))
    assert same(an.activity_by_vessel_type(q.activity(spark, SF), q.metadata(spark, SF)), types)


def test_vessels_are_counted_once_in_a_period(spark):
    rows = [(m, f"2025-0{month}-0{day}") for month in (1, 2) for day in (1, 2) for m in (0, -5, 7, 366000008, 40000 * day)]
    rows += [(None, "2025-01-03")]
    voyages = spark.createDataFrame(rows, "mmsi bigint, day string").select(
        "mmsi", F.col("day").cast("timestamp_ntz").alias("start_time"), F.lit("transit").alias("candidate_route_type"),
        F.lit(3).cast("bigint").alias("point_count"), F.lit(1.5).alias("duration_hours"), F.lit(None).cast("double").alias("avg_sog"),
    )
    got = summaries.route_periods(summaries.route_days(voyages)).orderBy("period").collect()
    assert [(str(r["period"]), r["vessel_count"], r["voyages"], r["point_count"]) for r in got] == [
        ("2025-01-01", 6, 11, 33), ("2025-02-01", 6, 10, 30)]
    assert {(r["avg_duration_hours"], r["avg_speed"]) for r in got} == {(1.5, None)}
    none = summaries.kpi_of(
        summaries.activity_days(q.enriched(spark, SF).where("false")), summaries.route_days(voyages.where("false"))
    ).first()
    assert tuple(none) == (0, 0, 0, 0, 0)


def test_samples_from_state_equal_those_from_silver(spark, lake):
    store = Samples(spark, lake, n=40)
    store.refresh()
    positions = read_positions(spark, lake)
    for n in (1, 25, 40):
        assert same(sampling.capped_sample(positions, n), store.capped(n))
        assert same(sampling.stratified_sample(positions, n), store.daily(n))
    assert same(sampling.proportional_sample(positions, 30, minimum=3), store.proportional(30, minimum=3))
    with pytest.raises(ValueError):
        store.capped(41)


def test_a_day_refreshes_its_partitions_only(spark, lake):
    stores = [Samples(spark, lake, n=30), Profiles(spark, lake)]
    for store in stores:
        store.refresh()
    day, other = [r[0] for r in read_positions(spark, lake).select("source_date").distinct().orderBy("source_date").limit(2).collect()]
    files = [{f for f in s.read().inputFiles() if f"source_date={other}" in f} for s in stores]
    fewer = read_positions(spark, lake, day).where("mmsi % 2 = 0").collect()
    fewer = spark.createDataFrame(fewer, read_positions(spark, lake).schema)
    replace_partitions(fewer, layer_path(lake, "vessel_positions"), ["source_date"], [(day,)])
    for store in stores:
        store.refresh([day])
    assert files == [{f for f in s.read().inputFiles() if f"source_date={other}" in f} for s in stores]
    positions = read_positions(spark, lake)
    assert same(sampling.capped_sample(positions, 30), stores[0].capped(30))
    whole, merged = summaries.profile_of(summaries.column_summaries(positions)), stores[1].profile()
    assert same(whole.drop("unique_estimate"), merged.drop("unique_estimate"))
    # the last digits of an estimate depend on the order of merging
    estimates = [{r["column_name"]: r["unique_estimate"] for r in x.collect()} for x in (whole, merged)]
    assert estimates[0] == pytest.approx(estimates[1], rel=0.03, abs=1)


def test_vessel_days_of_a_lake(spark, lake):
    store = VesselDays(spark, lake)
    store.refresh()
    day = store.activity().agg(F.min("activity_date")).first()[0]
    store.refresh([day])
    kpi = summaries.kpi_of(store.activity(), store.routes()).first()
    activity = spark.read.parquet(layer_path(lake, "vessel_daily_activity"))
    assert kpi["unique_vessels"] == activity.select("mmsi").distinct().count()
    assert kpi["daily_records"] == activity.count()
    assert kpi["available_days"] == activity.select("activity_date").distinct().count()
    assert kpi["voyage_segments"] == spark.read.parquet(layer_path(lake, "voyage_candidates")).count()
    assert kpi["total_positions"] == activity.agg(F.sum("point_count")).first()[0]
