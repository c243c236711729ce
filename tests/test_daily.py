"""Whole runs over generated raw files."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.raw import day_rows, write_day
from wakeline.operators import quality, voyages
from wakeline.plans import daily, metrics
from wakeline.rules import VoyageRules
from wakeline.schema import TABLES
from wakeline.sources.ingest import ingest_day, ingest_pending
from wakeline.sources.tables import (
    choose_root,
    layer_path,
    read_bronze,
    read_positions,
    read_table,
    register_tables,
    repair_tables,
    resolve_positions,
    state_path,
    write_partitioned,
)

VESSELS = 110  # enough rows for the gates' own limits
DAYS = ["2025-08-15", "2025-08-16", "2025-08-17"]


def make_raw(folder, days=DAYS):
    for i, day in enumerate(days):
        rows = day_rows(day, VESSELS, 60)
        # reports that fall on the day before their file's date
        early = [dict(r, base_date_time=f"{dt.date.fromisoformat(day) - dt.timedelta(days=1)}T23:59:{30 + k:02d}")
                 for k, r in enumerate(rows[:3])]
        write_day(folder, day, rows + early, legacy=i == 1)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    make_raw(folder)
    return folder


@pytest.fixture(scope="module")
def full(spark, raw, tmp_path_factory):
    """Everything loaded and built in one run."""
    root = str(tmp_path_factory.mktemp("full"))
    ingest_pending(spark, str(raw), root)
    daily.run_all(spark, root)
    return root


def same(spark, left, right, tables=TABLES):
    for table in tables:
        a, b = read_table(spark, left, table), read_table(spark, right, table)
        assert a.count() > 0, table
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0, table


def test_tables_have_their_schemas_and_keys(spark, full):
    for table, (schema, _, keys) in TABLES.items():
        frame = read_table(spark, full, table)
        assert [f.dataType for f in frame.schema] == [f.dataType for f in schema]
        assert quality.unique_key_violations(frame, keys).count() == 0


def test_day_by_day_equals_all_at_once(spark, raw, full, tmp_path):
    """Late rows of the next file belong to days that are already built."""
    root = str(tmp_path)
    for _ in DAYS:
        assert daily.run_from_raw(spark, str(raw), root, file_limit=1) is not None
    assert daily.run_from_raw(spark, str(raw), root) is None
    same(spark, full, root)
    daily.run_day(spark, root, DAYS[1])  # again, to no effect
    same(spark, full, root)


def test_voyages_span_midnight_unless_per_day(spark, raw, full, tmp_path):
    longest = read_table(spark, full, "voyage_candidates").agg(F.max("duration_hours")).first()[0]
    assert longest > 48
    root = str(tmp_path)
    ingest_pending(spark, str(raw), root)
    daily.run_all(spark, root, per_day=True)
    cut = read_table(spark, root, "voyage_candidates")
    assert cut.agg(F.max("duration_hours")).first()[0] <= 24.01
    direct = voyages.voyage_candidates(read_positions(spark, root), per_day=True)
    assert cut.select(*direct.columns).exceptAll(direct).count() == 0


def test_corrected_day_replaces_the_old_one(spark, tmp_path):
    """A corrected file may empty a day it reached before."""
    raw, root, clean_root = tmp_path / "raw", str(tmp_path / "a"), str(tmp_path / "b")
    rows = day_rows("2025-08-16", VESSELS, 60)
    stray = [dict(r, base_date_time=f"2025-08-10T00:00:{k:02d}") for k, r in enumerate(rows[:20])]
    write_day(raw, "2025-08-16", rows + stray)
    write_day(raw, "2025-08-17", day_rows("2025-08-17", VESSELS, 60))
    ingest_pending(spark, str(raw), root)
    daily.run_all(spark, root)
    emptied = "activity_date = '2025-08-10'"
    assert read_table(spark, root, "vessel_daily_activity").where(emptied).count() == 1

    write_day(raw, "2025-08-16", rows)
    ingest_day(spark, str(raw / "ais-2025-08-16.csv.zst"), root)
    daily.run_day(spark, root, "2025-08-16")
    assert read_table(spark, root, "vessel_daily_activity").where(emptied).count() == 0

    ingest_pending(spark, str(raw), clean_root)
    daily.run_all(spark, clean_root)
    same(spark, root, clean_root)


def test_emptied_day_equals_a_rebuild(spark, tmp_path):
    raw, root, clean_root = tmp_path / "raw", str(tmp_path / "a"), str(tmp_path / "b")
    make_raw(raw)
    ingest_pending(spark, str(raw), root)
    daily.run_all(spark, root)
    write_day(raw, DAYS[1], [])
    ingest_day(spark, str(raw / f"ais-{DAYS[1]}.csv.zst"), root)
    daily.run_day(spark, root, DAYS[1], gate=False)
    assert read_bronze(spark, root, DAYS[1]).count() == 0
    assert read_positions(spark, root, DAYS[1]).count() == 0
    ingest_pending(spark, str(raw), clean_root)
    daily.run_all(spark, clean_root, gate=False)
    same(spark, root, clean_root)


def test_another_gap_does_not_mix_with_stored_fragments(spark, raw, tmp_path):
    root, clean_root = str(tmp_path / "a"), str(tmp_path / "b")
    ingest_pending(spark, str(raw), root)
    daily.run_all(spark, root)
    short = VoyageRules(gap_hours=2.0)
    daily.run_day(spark, root, DAYS[2], rules=short)
    ingest_pending(spark, str(raw), clean_root)
    daily.run_all(spark, clean_root, rules=short)
    same(spark, root, clean_root)


def test_a_day_opens_and_replaces_what_it_concerns(spark, raw, tmp_path):
    root = str(tmp_path)
    ingest_pending(spark, str(raw), root)
    daily.run_all(spark, root)
    days = {dt.date.fromisoformat(DAYS[2])}
    near = daily._on_event_days(spark, root, read_positions(spark, root), days)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [source_date" in plan.replace("isnotnull(source_date#", "source_date")
    assert {r[0] for r in near.select("source_date").distinct().collect()} == {DAYS[2]}

    def files(table):
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "gold" / table).rglob("*.parquet")}

    before = files("voyage_candidates"), files("vessel_daily_activity")
    daily.run_day(spark, root, DAYS[2])
    assert files("voyage_candidates") == before[0]
    kept = {p for p, at in files("vessel_daily_activity").items() if before[1].get(p) == at}
    assert any("2025-08-15" in p for p in kept) and not any(DAYS[2] in p for p in kept)


def test_failed_serving_does_not_undo_the_run(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path)
    ingest_pending(spark, str(raw), root, file_limit=1)

    def refuse(*_):
        raise OSError("no route to the database")

    monkeypatch.setattr(daily, "load_gold_tables", refuse)
    daily.run_all(spark, root, database=object(), run_id="served")
    stages = spark.read.parquet(state_path(root, "stage_metrics")).where("stage = 'gold_to_database'")
    assert [(s["status"], s["error"]) for s in stages.collect()] == [("failed", "no route to the database")]
    assert read_table(spark, root, "route_metrics").count() > 0


def test_failed_gate_leaves_the_table(spark, raw, tmp_path):
    root = str(tmp_path)
    ingest_pending(spark, str(raw), root, file_limit=1)
    daily.run_all(spark, root)
    before = read_positions(spark, root).count()
    ingest_pending(spark, str(raw), root)
    strict = {"vessel_positions": lambda f: quality.run_checks(f, "silver", [quality.row_count(10**9)])}
    with pytest.raises(quality.QualityError, match="silver.row_count"):
        daily.run_all(spark, root, suites=strict, run_id="bad")
    assert read_positions(spark, root).count() == before
    stages = spark.read.parquet(state_path(root, "stage_metrics")).where("run_id = 'bad'").collect()
    assert [(s["stage"], s["status"]) for s in stages] == [("bronze_to_silver", "failed")]
    assert "row_count" in stages[0]["error"]


def test_stage_metrics(spark, full):
    stages = spark.read.parquet(state_path(full, "stage_metrics"))
    rows = {s["stage"]: s for s in stages.collect()}
    assert rows["bronze_to_silver"]["output_rows"] == read_positions(spark, full).count()
    assert rows["bronze_to_silver"]["input_rows"] == read_bronze(spark, full).count()
    assert rows["voyages_to_routes"]["output_rows"] == read_table(spark, full, "route_metrics").count()
    summary = metrics.run_summary(stages).first()
    assert (summary["total_stages"], summary["stages_passed"], summary["stages_failed"]) == (6, 5, 0)
    for name in ("silver_to_activity", "silver_to_voyages"):
        assert rows[name]["input_rows"] == read_positions(spark, full).count()
    assert rows["bronze_to_metadata"]["input_rows"] == read_bronze(spark, full).count()
    assert rows["voyages_to_routes"]["input_rows"] == read_table(spark, full, "voyage_candidates").count()
    served = rows["gold_to_database"]
    assert (served["status"], served["error"]) == ("skipped", "no database is configured")
    assert metrics.run_stages(stages).first()["stage"] == "bronze_to_silver"


def test_partition_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "x int, d string")
    write_partitioned(one, path, ["d"])
    write_partitioned(spark.createDataFrame([(3, "b")], "x int, d string"), path, ["d"])
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [1, 3]


def test_external_tables(spark, full):
    spark.sql("CREATE DATABASE IF NOT EXISTS tracks_test")
    register_tables(spark, full, "tracks_test")
    repair_tables(spark, "tracks_test")
    for table in TABLES:
        assert spark.table(f"tracks_test.{table}").count() == read_table(spark, full, table).count()
    by_type = spark.sql(
        "SELECT m.vessel_type, count(DISTINCT a.mmsi) AS n FROM tracks_test.vessel_daily_activity a"
        " LEFT JOIN tracks_test.vessel_metadata m ON a.mmsi = m.mmsi GROUP BY 1"
    )
    assert sum(r["n"] for r in by_type.collect()) == VESSELS
    spark.sql("DROP DATABASE tracks_test CASCADE")


def test_source_resolution(spark, full, tmp_path):
    assert choose_root("s3://vessels/", "/data") == "s3a://vessels"
    assert choose_root("", "/data/") == "/data"
    assert resolve_positions(spark, full).count() == read_positions(spark, full).count()
    root = str(tmp_path)
    sample = read_positions(spark, full).select("mmsi", "source_date").limit(5)
    write_partitioned(sample, layer_path(root, "silver_sample"), ["source_date"])
    assert resolve_positions(spark, root).count() == 5


def test_day_scans_prune_partitions(spark, full):
    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    bronze = plan(read_bronze(spark, full, DAYS[0]).select("mmsi"))
    assert "PartitionFilters: [isnotnull(year" in bronze
    assert "ReadSchema: struct<mmsi:bigint>" in bronze
    silver = plan(read_positions(spark, full, DAYS[0]).where("mmsi > 5").select("sog"))
    assert "PartitionFilters: [isnotnull(source_date" in silver
    assert "PushedFilters: [IsNotNull(mmsi), GreaterThan(mmsi,5)]" in silver
    assert "ReadSchema: struct<mmsi:bigint,sog:double>" in silver
