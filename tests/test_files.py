from __future__ import annotations

import pytest
import zstandard
from pyspark.sql import functions as F

from tests.raw import MODERN, day_rows, write_day
from wakeline.schema import REPORT_SCHEMA
from wakeline.sources import files, ingest
from wakeline.sources import manifest as mf
from wakeline.sources.tables import manifest_path, read_bronze
from wakeline.streaming.ingest import stream_ingest


def test_discover_sorted_with_dates(spark, tmp_path):
    write_day(tmp_path, "2025-08-16", [])
    write_day(tmp_path, "2025-08-15", [])
    write_day(tmp_path, "", [], name="ais-nodate.csv.zst")
    (tmp_path / "random_file.csv").write_text("a\n1\n")
    found = files.discover_files(spark, str(tmp_path)).collect()
    assert [(f["file_name"], f["source_date"]) for f in found] == [
        ("ais-2025-08-15.csv.zst", "2025-08-15"),
        ("ais-2025-08-16.csv.zst", "2025-08-16"),
        ("ais-nodate.csv.zst", None),
    ]


def test_discover_empty_directory(spark, tmp_path):
    assert files.discover_files(spark, str(tmp_path)).count() == 0


def test_both_header_styles_bind_by_name(spark, tmp_path):
    rows = day_rows("2025-08-15", vessels=2)
    a = write_day(tmp_path, "2025-08-15", rows)
    b = write_day(tmp_path, "2025-08-16", rows, legacy=True)
    scanned = files.scan_reports(spark, [str(a), str(b)])
    assert scanned.drop("file_name").schema == REPORT_SCHEMA
    one = scanned.where(F.col("file_name") == a.name).drop("file_name")
    two = scanned.where(F.col("file_name") == b.name).drop("file_name")
    assert one.count() == two.count() == len(rows)
    assert one.exceptAll(two).count() == 0
    assert scanned.where("latitude < 0 or longitude > 0").count() == 0
    assert scanned.where("vessel_type is null").count() == 0  # 70.0 is the code 70


def test_many_files_of_one_style_are_one_scan(spark, tmp_path):
    paths = [str(write_day(tmp_path, f"2025-08-{d}", day_rows(f"2025-08-{d}", 1))) for d in (15, 16, 17)]
    plan = files.scan_reports(spark, paths)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1


def test_bad_lines_are_quarantined(spark, tmp_path):
    good = day_rows("2025-08-15", vessels=1)[:5]
    too_many = "1,2025-08-15T00:00:00" + ",x" * 20
    too_few = "366000001,2025-08-15T00:00:01,-90.0"
    quoted = (
        '366000002,2025-08-15T00:00:02,-90.0,25.0,1.0,2.0,3.0,"SHIP, THE",IMO1,WD1,70,1,10,5,3,70,A'
    )
    wrong_type = "abc,2025-08-15T00:00:03,-90.0,25.0" + "," * 13
    path = write_day(tmp_path, "2025-08-15", good, extra_lines=[too_many, too_few, quoted, wrong_type])
    clean, bad = files.scan_reports_quarantine(spark, str(path))
    assert [r["line"] for r in bad.collect()] == [too_many]
    assert clean.count() == len(good) + 3
    assert clean.where("mmsi = 366000002").first()["vessel_name"] == "SHIP, THE"
    padded = clean.where("mmsi = 366000001").first()
    assert padded["longitude"] == -90.0 and padded["latitude"] is None
    assert clean.where("mmsi is null").count() == 1


def test_broken_bytes_are_dropped(spark, tmp_path):
    line = "366000001,2025-08-15T00:00:01,-90.0,25.0,1,2,3,".encode() + b"SH\xffIP" + b"," * 9 + b"\n"
    path = tmp_path / "ais-2025-08-15.csv.zst"
    path.write_bytes(zstandard.ZstdCompressor().compress(MODERN.encode() + b"\n" + line))
    clean, _ = files.scan_reports_quarantine(spark, str(path))
    assert clean.first()["vessel_name"] == "SHIP"


def test_sample_head(spark, tmp_path):
    path = write_day(tmp_path, "2025-08-15", day_rows("2025-08-15", vessels=2), legacy=True)
    head = files.sample_head(spark, str(path), 50)
    assert head.count() == 50
    assert {"MMSI", "BaseDateTime", "LAT", "LON", "SOG", "COG"} <= set(head.columns)
    assert dict(head.dtypes)["LAT"] == "double"


def test_ingest_day_writes_unpadded_partitions(spark, tmp_path):
    raw, root = tmp_path / "raw", tmp_path / "root"
    rows = day_rows("2025-08-05", vessels=2)
    path = write_day(raw, "2025-08-05", rows)
    ingest.ingest_day(spark, str(path), str(root))
    ingest.ingest_day(spark, str(path), str(root))
    assert (root / "bronze" / "year=2025" / "month=8" / "day=5").is_dir()
    bronze = read_bronze(spark, str(root), "2025-08-05")
    assert bronze.count() == len(rows)
    assert bronze.select("source_date").distinct().first()[0] == "2025-08-05"


def test_undated_file_is_an_error_in_ingest(spark, tmp_path):
    path = write_day(tmp_path, "", day_rows("2025-08-05", 1)[:3], name="ais-nodate.csv.zst")
    with pytest.raises(Exception, match="no date in file name"):
        ingest.ingest_day(spark, str(path), str(tmp_path / "root"))


def test_pending_manifest_limit_and_failures(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "root")
    sizes = {}
    for day in ("2025-08-15", "2025-08-16", "2025-08-17"):
        rows = day_rows(day, vessels=2)
        sizes[day] = len(rows)
        write_day(raw, day, rows)
    (raw / "ais-2025-08-18.csv.zst").write_bytes(b"this is no zstd frame")
    write_day(raw, "", [], name="ais-nodate.csv.zst")

    first = ingest.ingest_pending(spark, str(raw), root, file_limit=1)
    assert [r["source_date"] for r in first.collect()] == ["2025-08-15"]
    # the limit counts pending files, so later days do come
    second = ingest.ingest_pending(spark, str(raw), root, file_limit=1)
    assert [(r["source_date"], r["row_count"]) for r in second.collect()] == [
        ("2025-08-16", sizes["2025-08-16"])
    ]
    rest = {r["file_name"]: r for r in ingest.ingest_pending(spark, str(raw), root).collect()}
    assert rest["ais-2025-08-17.csv.zst"]["status"] == "success"
    assert rest["ais-2025-08-18.csv.zst"]["status"] == "failed"
    assert rest["ais-nodate.csv.zst"]["error"] == "no date in file name"

    manifest = mf.read_manifest(spark, manifest_path(root))
    summary = mf.manifest_summary(manifest).first()
    assert (summary["total_tracked"], summary["successful"], summary["failed"]) == (5, 3, 2)
    assert summary["total_rows"] == sum(sizes.values())
    assert [r[0] for r in mf.ingested_dates(manifest).collect()] == sorted(sizes)
    assert mf.is_ingested(manifest, "ais-2025-08-17.csv.zst").first()[0] is True
    assert mf.is_ingested(manifest, "ais-2025-08-18.csv.zst").first()[0] is False
    again = ingest.ingest_pending(spark, str(raw), root).collect()
    assert {r["status"] for r in again} == {"failed"}
    assert read_bronze(spark, root).count() == sum(sizes.values())

    mf.reset_manifest(spark, manifest_path(root))
    assert mf.read_manifest(spark, manifest_path(root)).count() == 0


def test_late_second_file_of_a_day_joins_the_first(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "root")
    rows = day_rows("2025-08-15", vessels=2)
    write_day(raw, "2025-08-15", rows[:100])
    ingest.ingest_pending(spark, str(raw), root)
    write_day(raw, "2025-08-15", rows[100:], name="ais-2025-08-15-late.csv.zst")
    late = {r["file_name"]: r["row_count"] for r in ingest.ingest_pending(spark, str(raw), root).collect()}
    assert late["ais-2025-08-15-late.csv.zst"] == len(rows) - 100
    assert read_bronze(spark, root).count() == len(rows)


def test_stream_takes_each_file_once(spark, tmp_path):
    raw, root, checkpoint = tmp_path / "raw", str(tmp_path / "root"), str(tmp_path / "cp")
    a, b = day_rows("2025-08-15", 1), day_rows("2025-08-14", 1)

    def run():
        stream_ingest(spark, str(raw), root, checkpoint).awaitTermination(120)
        return read_bronze(spark, root).count()

    write_day(raw, "2025-08-15", a)
    assert run() == len(a)
    assert run() == len(a)
    write_day(raw, "2025-08-14", b, legacy=True)
    write_day(raw, "", [], name="ais-nodate.csv.zst")
    assert run() == len(a) + len(b)
    assert read_bronze(spark, root).where("longitude > 0").count() == 0


def test_headers_of_many_files_are_one_query(spark, tmp_path):
    paths = [str(write_day(tmp_path, f"2025-0{1 + i // 25}-{1 + i % 25:02d}", day_rows("2025-08-15", 1)[:2],
                           legacy=i % 2 == 0)) for i in range(50)]
    spark.sparkContext.setJobGroup("headers", "headers")
    groups, failed = files.headers_of(spark, paths)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(map(len, groups.values())) == [25, 25] and not failed
    # adaptive execution runs a query's shuffle as a job of its own
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) <= 2


def test_an_emptied_day_leaves_bronze(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "root")
    for day in ("2025-08-15", "2025-08-16"):
        write_day(raw, day, day_rows(day, 1))
    ingest.ingest_pending(spark, str(raw), root)
    write_day(raw, "2025-08-15", [])
    mf.append_attempts(
        mf.failure(spark.createDataFrame([("ais-2025-08-15.csv.zst", "again")], "file_name string, error string")),
        manifest_path(root),
    )
    attempt = ingest.ingest_pending(spark, str(raw), root).first()
    assert (attempt["status"], attempt["row_count"]) == ("success", 0)
    assert {r[0] for r in read_bronze(spark, root).select("source_date").distinct().collect()} == {"2025-08-16"}


def test_a_broken_file_keeps_only_itself_out(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "root")
    rows = day_rows("2025-08-15", 1)
    write_day(raw, "2025-08-15", rows)
    cut = write_day(raw, "2025-08-15", rows * 30, name="ais-2025-08-15-cut.csv.zst")
    cut.write_bytes(cut.read_bytes()[:-200])
    write_day(raw, "2025-08-16", rows[:7], name="ais-2025-08-16.csv.zst")
    got = {r["file_name"]: r for r in ingest.ingest_pending(spark, str(raw), root).collect()}
    assert {n for n, r in got.items() if r["status"] == "failed"} == {cut.name}
    assert got["ais-2025-08-15.csv.zst"]["row_count"] == len(rows)
    assert read_bronze(spark, root).count() == len(rows) + 7


def test_bad_lines_go_beside_bronze(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "root")
    bad = "1,2025-08-15T00:00:00" + ",x" * 20
    rows = day_rows("2025-08-15", 1)
    write_day(raw, "2025-08-15", rows, extra_lines=[bad])
    ingest.ingest_pending(spark, str(raw), root)
    assert read_bronze(spark, root).count() == len(rows)
    assert [(r["line"], r["source_date"]) for r in ingest.read_quarantine(spark, root).collect()] == [
        (bad, "2025-08-15")
    ]


def test_streamed_files_are_not_pending(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "root")
    write_day(raw, "2025-08-15", day_rows("2025-08-15", 1))
    write_day(raw, "", [], name="ais-nodate.csv.zst")
    (raw / "ais-2025-08-18.csv.zst").write_bytes(b"this is no zstd frame")
    stream_ingest(spark, str(raw), root, str(tmp_path / "cp")).awaitTermination(120)
    latest = {r["file_name"]: r["status"] for r in mf.latest_attempts(mf.read_manifest(spark, manifest_path(root))).collect()}
    assert latest == {
        "ais-2025-08-15.csv.zst": "success", "ais-nodate.csv.zst": "failed", "ais-2025-08-18.csv.zst": "failed",
    }


def test_manifest_time_does_not_depend_on_the_zone(spark, tmp_path):
    path = str(tmp_path / "manifest")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for own, status in (("Asia/Tokyo", "first"), ("America/New_York", "second")):
            spark.conf.set("spark.sql.session.timeZone", own)
            rows = spark.createDataFrame([("f", status)], "file_name string, error string")
            mf.append_attempts(mf.failure(rows), path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert mf.latest_attempts(mf.read_manifest(spark, path)).first()["error"] == "second"
