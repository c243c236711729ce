"""Every registered query: a library operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import bridge
from wakeline.functions import times
from wakeline.operators import analytics as an
from wakeline.operators import clean, gold, quality, sampling, summaries, tracks
from wakeline.operators import voyages as vy
from wakeline.plans import daily, metrics
from wakeline.rules import VoyageRules
from wakeline.schema import BRONZE_SCHEMA, REPORT_SCHEMA
from wakeline.sources import files, ingest, tables
from wakeline.sources import manifest as mf
from wakeline.streaming import ingest as streaming

Query = Callable[[SparkSession, str], DataFrame]

RULES = VoyageRules(
    gap_hours=24.0, min_points=3, stationary_knots=10.0, short_hours=24.0, coastal_hours=48.0
)
FLAGSHIP_RULES = VoyageRules(gap_hours=24.0, min_points=3)
DAY = "2024-01-15"
VESSEL = 366000008
NAME = "vessel 1"

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- layers ------------------------------------------------------------------


def reports(spark, sf_dir):
    return bridge.reports(spark, sf_dir)


def silver(spark, sf_dir):
    return clean.build_silver(bridge.reports(spark, sf_dir))


def activity(spark, sf_dir):
    return gold.daily_activity(silver(spark, sf_dir))


def voyages(spark, sf_dir):
    return vy.voyage_candidates(silver(spark, sf_dir), RULES)


def metadata(spark, sf_dir):
    return gold.vessel_metadata(bridge.reports(spark, sf_dir))


def routes(spark, sf_dir):
    return gold.route_metrics(voyages(spark, sf_dir))


def enriched(spark, sf_dir):
    return an.activity_enriched(activity(spark, sf_dir), metadata(spark, sf_dir))


def typed(spark, sf_dir):
    """Reports with parsed time and cast columns, before any rule drops a row."""
    return clean.cast_reports(clean.normalize_timestamp(reports(spark, sf_dir)))


# --- sources -----------------------------------------------------------------


@query
def normalize_columns(spark, sf_dir):
    legacy = {new: old for old, new in clean.LEGACY_NAMES.items()}
    return clean.rename_legacy_columns(reports(spark, sf_dir).withColumnsRenamed(legacy))


@query
def scan_reports(spark, sf_dir):
    """All reports written as CSV, each half under another header style, and read back."""
    folder, sent = bridge.scratch(spark), reports(spark, sf_dir)
    current = sent.where("transceiver = 'A'").select(*REPORT_SCHEMA.names)
    older = sent.where("transceiver = 'B'").select(
        *[F.col(new).alias(old) for old, new in clean.LEGACY_NAMES.items()]
    )
    paths = [f"{folder}/current", f"{folder}/older"]
    for frame, path in zip((current, older), paths):
        frame.write.option("header", True).option("compression", "gzip").csv(path)
    return files.scan_reports(spark, paths).drop("file_name")


def _with_surplus(spark, sf_dir) -> str:
    """All reports written as text, every seventh with two fields too many."""
    header = ",".join(REPORT_SCHEMA.names)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in REPORT_SCHEMA.names]
    surplus = F.when(F.col("report_id") % 7 == 0, ",x,y").otherwise("")
    lines = reports(spark, sf_dir).select(F.concat(F.concat_ws(",", *fields), surplus).alias(header))
    path = bridge.scratch(spark)
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(path)
    return path


@query
def scan_reports_quarantine(spark, sf_dir):
    """Lines with fields too many, out of all reports written as text."""
    _, bad = files.scan_reports_quarantine(spark, _with_surplus(spark, sf_dir))
    return bad.select("line")


@query
def scan_reports_clean(spark, sf_dir):
    """What quarantine leaves, out of all reports written as text."""
    clean, _ = files.scan_reports_quarantine(spark, _with_surplus(spark, sf_dir))
    return clean.drop("file_name")


@query
def discover_files(spark, sf_dir):
    """Daily files written from all reports, as they are found."""
    found = files.discover_files(spark, bridge.raw_files(spark, sf_dir), bridge.RAW_PATTERN)
    return found.select("file_name", "source_date", (F.col("size_bytes") > 0).alias("has_bytes"))


@query
def ingest_run(spark, sf_dir):
    """Daily files of all reports loaded into bronze and read back."""
    root = bridge.scratch(spark)
    ingest.ingest_pending(spark, bridge.raw_files(spark, sf_dir), root, pattern=bridge.RAW_PATTERN)
    return tables.read_bronze(spark, root)


@query
def ingest_manifest(spark, sf_dir):
    """What the manifest says of a load with lines that have fields too many."""
    root = bridge.scratch(spark)
    raw = bridge.raw_files(spark, sf_dir, broken=True)
    ingest.ingest_pending(spark, raw, root, pattern=bridge.RAW_PATTERN)
    written = mf.read_manifest(spark, tables.manifest_path(root))
    return written.select("file_name", "row_count", "source_date", "status")


@query
def ingest_quarantine(spark, sf_dir):
    """Lines that a load kept out of bronze, by day."""
    root = bridge.scratch(spark)
    raw = bridge.raw_files(spark, sf_dir, broken=True)
    ingest.ingest_pending(spark, raw, root, pattern=bridge.RAW_PATTERN)
    return ingest.read_quarantine(spark, root).select("line", "source_date")


@query
def stream_ingest(spark, sf_dir):
    """The same files loaded by a stream, some at a time, and read back."""
    root, raw = bridge.scratch(spark), bridge.raw_files(spark, sf_dir)
    started = streaming.stream_ingest(
        spark, raw, root, f"{root}/checkpoint", pattern=bridge.RAW_PATTERN, files_per_trigger=20
    )
    started.awaitTermination()
    return tables.read_bronze(spark, root)


@query
def external_tables(spark, sf_dir):
    """Route metrics of a run, read through the catalog after a repair."""
    root = bridge.scratch(spark)
    bronze = bridge.bronze(spark, sf_dir).select(*BRONZE_SCHEMA.names)
    tables.write_partitioned(bronze, tables.layer_path(root, "bronze"), tables.BRONZE_PARTITIONS)
    daily.run_all(spark, root, rules=RULES, gate=False)
    database = f"tracks_{root.rsplit('/', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/catalog'")
    tables.register_tables(spark, root, database)
    tables.repair_tables(spark, database)
    return spark.table(f"{database}.route_metrics")


@query
def gold_scan(spark, sf_dir):
    """Activity written by date, one date replaced, and read back with its types."""
    root, per_day = bridge.scratch(spark), activity(spark, sf_dir)
    path = tables.layer_path(root, "vessel_daily_activity")
    tables.write_full(per_day, path, ["activity_date"])
    one = per_day.where(F.col("activity_date") == F.lit(DAY).cast("date"))
    tables.write_partitioned(one, path, ["activity_date"])
    return tables.read_table(spark, root, "vessel_daily_activity")


@query
def bronze_to_gold_run(spark, sf_dir):
    """A whole run over bronze partitions, then one day again; its route metrics."""
    root = bridge.scratch(spark)
    bronze = bridge.bronze(spark, sf_dir).select(*BRONZE_SCHEMA.names)
    tables.write_partitioned(bronze, tables.layer_path(root, "bronze"), tables.BRONZE_PARTITIONS)
    daily.run_all(spark, root, rules=RULES, gate=False)
    daily.run_day(spark, root, DAY, rules=RULES, gate=False)
    return tables.read_table(spark, root, "route_metrics")


@query
def gated_run(spark, sf_dir):
    """A run whose layers pass their checks in staging; its activity."""
    root = bridge.scratch(spark)
    bronze = bridge.bronze(spark, sf_dir).select(*BRONZE_SCHEMA.names)
    tables.write_partitioned(bronze, tables.layer_path(root, "bronze"), tables.BRONZE_PARTITIONS)
    suites = {
        "bronze": lambda f: quality.run_checks(f, "bronze", [quality.row_count(1)]),
        "vessel_positions": lambda f: quality.run_checks(
            f,
            "vessel_positions",
            [quality.null_rate("mmsi", 0.0), quality.value_range("latitude", -90.0, 90.0)],
        ),
        "vessel_daily_activity": lambda f: quality.run_checks(
            f, "vessel_daily_activity", [quality.duplicate_rate(["mmsi", "activity_date"], 0.0)]
        ),
    }
    daily.run_all(spark, root, rules=RULES, gate=True, suites=suites)
    return tables.read_table(spark, root, "vessel_daily_activity")


@query
def rerun_empty_day(spark, sf_dir):
    """A whole run, then the run of a day that has lost all its reports; its activity."""
    root = bridge.scratch(spark)
    bronze = bridge.bronze(spark, sf_dir).select(*BRONZE_SCHEMA.names)
    path = tables.layer_path(root, "bronze")
    tables.write_partitioned(bronze, path, tables.BRONZE_PARTITIONS)
    daily.run_all(spark, root, rules=RULES, gate=False)
    none = bronze.where("source_date = 'none'")
    year, month, day = map(int, DAY.split("-"))
    tables.replace_partitions(none, path, tables.BRONZE_PARTITIONS, [(year, month, day)])
    daily.run_day(spark, root, DAY, rules=RULES, gate=False)
    return tables.read_table(spark, root, "vessel_daily_activity")


@query
def sample_layer(spark, sf_dir):
    """The position sample written by date and found where there is no silver layer."""
    root = bridge.scratch(spark)
    sampling.write_position_sample(silver(spark, sf_dir), root, rows_per_day=20)
    return tables.resolve_positions(spark, root)


@query
def file_dates(spark, sf_dir):
    return bridge.attempts(spark, sf_dir).select(
        "attempt_id", "file_name", times.date_from_file_name(F.col("file_name")).alias("file_date")
    )


@query
def date_parts(spark, sf_dir):
    return reports(spark, sf_dir).select("report_id", *times.date_parts(F.col("source_date")))


@query
def manifest_latest(spark, sf_dir):
    return mf.latest_attempts(bridge.attempts(spark, sf_dir).drop("attempt_id"))


@query
def manifest_pending(spark, sf_dir):
    """Files of every event, and of the next user on its day, who may have had no load yet."""
    day = F.substring(F.col("ts").cast("string"), 1, 10)
    users = F.explode(F.array("user_id", F.col("user_id") + 1)).alias("user_id")
    name = F.concat(F.lit("ais-"), "day", F.lit("-"), F.col("user_id").cast("string"), F.lit(".csv.zst"))
    seen = bridge.events(spark, sf_dir).select(day.alias("day"), users)
    files_seen = seen.select(name.alias("file_name")).distinct()
    return mf.pending_files(files_seen, bridge.attempts(spark, sf_dir))


@query
def manifest_dates(spark, sf_dir):
    return mf.ingested_dates(bridge.attempts(spark, sf_dir))


@query
def manifest_summary(spark, sf_dir):
    return mf.manifest_summary(bridge.attempts(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    return metrics.run_summary(bridge.stages(spark, sf_dir))


@query
def run_stages(spark, sf_dir):
    return metrics.run_stages(bridge.stages(spark, sf_dir))


@query
def bronze_scan(spark, sf_dir):
    return tables.on_source_date(bridge.bronze(spark, sf_dir), DAY)


@query
def silver_scan_day(spark, sf_dir):
    return silver(spark, sf_dir).where(F.col("source_date") == DAY)


@query
def unique_key_violations(spark, sf_dir):
    return quality.unique_key_violations(typed(spark, sf_dir), ["mmsi", "event_time"])


# --- cleaning ----------------------------------------------------------------


@query
def normalize_timestamp(spark, sf_dir):
    return clean.normalize_timestamp(reports(spark, sf_dir)).select(
        "report_id", "base_date_time", "event_time"
    )


@query
def normalize_timestamp_lenient(spark, sf_dir):
    text = F.concat(F.lit(" "), F.regexp_replace(F.col("ts").cast("string"), " ", "T"), F.lit(" "))
    raw = bridge.events(spark, sf_dir).select("event_id", text.alias("base_date_time"))
    return clean.normalize_timestamp(raw, lenient=True)


@query
def cast_reports(spark, sf_dir):
    """Every typed column from its text, codes written as decimals."""
    source = reports(spark, sf_dir)
    as_text = source.select(
        "report_id",
        *[
            F.col(c).cast("double" if c in ("vessel_type", "status", "cargo") else "string")
            .cast("string")
            .alias(c)
            for c in clean.POSITION_COLUMNS
            if c != "event_time"
        ],
    )
    return clean.cast_reports(as_text)


@query
def drop_null_critical(spark, sf_dir):
    return clean.drop_null_critical(typed(spark, sf_dir)).select(
        "report_id", *clean.CRITICAL_COLUMNS
    )


@query
def null_sentinel(spark, sf_dir):
    return clean.null_sentinel(reports(spark, sf_dir)).select("report_id", "sog")


def _validated(check):
    def run(spark, sf_dir):
        return check(reports(spark, sf_dir)).select(
            "report_id", "mmsi", "latitude", "longitude", "sog", "cog"
        )

    return run


QUERIES |= {
    check.__name__: _validated(check)
    for check in (
        clean.drop_null_island,
        clean.validate_mmsi,
        clean.validate_coordinates,
        clean.validate_sog,
        clean.validate_cog,
        clean.validate_row,
    )
}


@query
def dedup_positions(spark, sf_dir):
    columns = ["mmsi", "event_time", "latitude", "longitude", "sog", "status", "draft"]
    return clean.deduplicate_positions(typed(spark, sf_dir).select(*columns))


@query
def build_silver(spark, sf_dir):
    return silver(spark, sf_dir)


# --- tracks and voyages ------------------------------------------------------


@query
def time_gaps(spark, sf_dir):
    return tracks.time_gaps(
        silver(spark, sf_dir).select("mmsi", "event_time", "longitude", "latitude")
    )


@query
def distance_nm(spark, sf_dir):
    points = silver(spark, sf_dir).select("mmsi", "event_time", "longitude", "latitude")
    return tracks.distances(points).withColumn("distance_nm", F.round("distance_nm", 4))


@query
def voyage_segments(spark, sf_dir):
    points = silver(spark, sf_dir).select("mmsi", "event_time", "longitude", "latitude")
    return tracks.voyage_segments(points, RULES)


@query
def voyage_candidates(spark, sf_dir):
    return vy.voyage_candidates(silver(spark, sf_dir), FLAGSHIP_RULES)


@query
def voyage_route_type(spark, sf_dir):
    return voyages(spark, sf_dir)


@query
def voyage_candidates_per_day(spark, sf_dir):
    rules = VoyageRules(gap_hours=4.0, min_points=2)
    return vy.voyage_candidates(silver(spark, sf_dir), rules, per_day=True)


@query
def voyage_sessions(spark, sf_dir):
    return vy.voyage_sessions(silver(spark, sf_dir), RULES)


@query
def voyage_distance_nm(spark, sf_dir):
    far = vy.voyage_distances(voyages(spark, sf_dir))
    return far.select("mmsi", "start_time", F.round("distance_nm", 4).alias("distance_nm"))


@query
def vessel_track(spark, sf_dir):
    """Every path by its length, ends and an order-sensitive sum."""
    paths = tracks.vessel_track(silver(spark, sf_dir))
    first, last = F.element_at("path", 1), F.element_at("path", -1)
    weighted = F.transform(
        "path",
        lambda p, i: (i + 1) * F.round((p["longitude"] + p["latitude"]) * 1000).cast("bigint"),
    )
    return paths.select(
        "mmsi",
        "track_date",
        F.col("point_count").cast("bigint").alias("point_count"),
        first["longitude"].alias("first_longitude"),
        first["latitude"].alias("first_latitude"),
        last["longitude"].alias("last_longitude"),
        last["latitude"].alias("last_latitude"),
        F.aggregate(weighted, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("order_sum"),
    )


# --- gold --------------------------------------------------------------------


@query
def daily_activity(spark, sf_dir):
    return activity(spark, sf_dir)


@query
def vessel_metadata(spark, sf_dir):
    return metadata(spark, sf_dir)


@query
def route_metrics(spark, sf_dir):
    return routes(spark, sf_dir)


# --- analyst queries ---------------------------------------------------------


@query
def moving_flag(spark, sf_dir):
    return an.with_moving(silver(spark, sf_dir)).select("mmsi", "event_time", "sog", "is_moving")


@query
def vessel_class(spark, sf_dir):
    return an.with_vessel_class(silver(spark, sf_dir)).select(
        "mmsi", "event_time", "vessel_type", "vessel_class"
    )


@query
def map_points(spark, sf_dir):
    return an.map_points(silver(spark, sf_dir)).select(
        "mmsi", "event_time", "latitude", "longitude", "sog", "vessel_type"
    )


@query
def speed_ratio(spark, sf_dir):
    points = an.map_points(silver(spark, sf_dir)).select("mmsi", "event_time", "sog")
    return an.with_speed_ratio(points).withColumn("speed_ratio", F.round("speed_ratio", 6))


@query
def map_center(spark, sf_dir):
    center = an.map_center(silver(spark, sf_dir))
    return center.select(*[F.round(c, 4).alias(c) for c in center.columns])


@query
def filter_activity(spark, sf_dir):
    return an.filter_activity(activity(spark, sf_dir), low=5.0, high=20.0)


@query
def filter_voyages(spark, sf_dir):
    return an.filter_route_types(voyages(spark, sf_dir), ["transit", "coastal"])


@query
def filter_mmsi(spark, sf_dir):
    return an.filter_mmsi(silver(spark, sf_dir), f" {VESSEL} ")


@query
def search_name(spark, sf_dir):
    return an.search_name(enriched(spark, sf_dir), NAME)


@query
def search_name_literal(spark, sf_dir):
    return an.search_name(enriched(spark, sf_dir), "vessel 1", regex=False)


@query
def voyages_by_name(spark, sf_dir):
    return an.voyages_by_name(voyages(spark, sf_dir), enriched(spark, sf_dir), NAME)


@query
def voyage_arcs(spark, sf_dir):
    return an.voyage_arcs(voyages(spark, sf_dir))


@query
def voyage_arcs_drawn(spark, sf_dir):
    """As many arcs as one map draws."""
    arcs = an.voyage_arcs(voyages(spark, sf_dir))
    return sampling.capped_sample(arcs, 300, key=("mmsi", "start_time"))


@query
def activity_enriched(spark, sf_dir):
    return enriched(spark, sf_dir)


@query
def activity_by_vessel_type(spark, sf_dir):
    return an.activity_by_vessel_type(activity(spark, sf_dir), metadata(spark, sf_dir))


@query
def route_type_breakdown(spark, sf_dir):
    return an.route_type_breakdown(routes(spark, sf_dir))


@query
def top_active_vessels(spark, sf_dir):
    return an.top_active_vessels(enriched(spark, sf_dir))


@query
def route_type_counts(spark, sf_dir):
    return an.route_type_counts(voyages(spark, sf_dir))


@query
def speed_histogram(spark, sf_dir):
    return an.speed_histogram(activity(spark, sf_dir))


@query
def kpi_summary(spark, sf_dir):
    per_day = activity(spark, sf_dir)
    return an.kpi_summary(
        per_day,
        metadata(spark, sf_dir),
        an.filter_activity(per_day, low=5.0, high=20.0),
        an.filter_route_types(voyages(spark, sf_dir), ["transit", "coastal"]),
    )


@query
def filter_options(spark, sf_dir):
    return an.filter_options(activity(spark, sf_dir), voyages(spark, sf_dir))


@query
def top_vessels_on_date(spark, sf_dir):
    return an.top_vessels_on_date(activity(spark, sf_dir), metadata(spark, sf_dir), DAY)


@query
def speed_anomalies(spark, sf_dir):
    return an.speed_anomalies(activity(spark, sf_dir), metadata(spark, sf_dir))


@query
def route_distribution(spark, sf_dir):
    return an.route_distribution(routes(spark, sf_dir))


@query
def transit_trend(spark, sf_dir):
    return an.transit_trend(routes(spark, sf_dir))


@query
def longest_voyages(spark, sf_dir):
    return an.longest_voyages(voyages(spark, sf_dir))


@query
def vessel_lookup_meta(spark, sf_dir):
    return an.vessel_info(metadata(spark, sf_dir), VESSEL)


@query
def vessel_lookup_activity(spark, sf_dir):
    return an.vessel_activity(activity(spark, sf_dir), VESSEL)


@query
def vessel_lookup_voyages(spark, sf_dir):
    return an.vessel_voyages(voyages(spark, sf_dir), VESSEL)


@query
def vessel_lookup_track(spark, sf_dir):
    return an.track_points(silver(spark, sf_dir), VESSEL)


# --- samples -----------------------------------------------------------------


@query
def stratified_sample(spark, sf_dir):
    return sampling.daily_position_sample(silver(spark, sf_dir), rows_per_day=20)


@query
def proportional_sample(spark, sf_dir):
    points = silver(spark, sf_dir).select("mmsi", "event_time", "source_date", "sog")
    return sampling.proportional_sample(points, 500)


@query
def capped_sample(spark, sf_dir):
    points = silver(spark, sf_dir).select("mmsi", "event_time", "latitude", "longitude")
    return sampling.capped_sample(points, 500)


# --- quality -----------------------------------------------------------------


def _checked(build):
    def run(spark, sf_dir):
        frame = typed(spark, sf_dir)
        return quality.run_checks(frame, "reports", build(frame))

    return run


QUERIES |= {
    "check_row_count": _checked(
        lambda _: [quality.row_count(1000), quality.row_count(10_000_000_000)]
    ),
    "check_null_rate": _checked(
        lambda f: [quality.null_rate(c, 0.05) for c in ("mmsi", "sog", "vessel_name", "event_time")]
    ),
    "check_duplicate_rate": _checked(
        lambda _: [quality.duplicate_rate(["mmsi", "event_time"], 0.01)]
    ),
    "check_value_range": _checked(
        lambda _: [
            quality.value_range("latitude", -90.0, 90.0),
            quality.value_range("longitude", -180.0, 180.0),
            quality.value_range("sog", 0, 102.3),
        ]
    ),
    "check_completeness": _checked(
        lambda f: [
            quality.completeness(f.columns, ["mmsi", "sog"]),
            quality.completeness(f.columns, ["mmsi", "speed", "port"]),
        ]
    ),
}


@query
def quality_bronze(spark, sf_dir):
    return quality.bronze_suite(reports(spark, sf_dir))


@query
def quality_silver(spark, sf_dir):
    return quality.silver_suite(silver(spark, sf_dir))


@query
def quality_activity(spark, sf_dir):
    return quality.activity_suite(activity(spark, sf_dir))


@query
def quality_summary(spark, sf_dir):
    checks = (
        quality.bronze_suite(reports(spark, sf_dir))
        .union(quality.silver_suite(silver(spark, sf_dir)))
        .union(quality.activity_suite(activity(spark, sf_dir)))
    )
    return quality.quality_summary(checks)


@query
def null_report(spark, sf_dir):
    return quality.null_report(reports(spark, sf_dir))


@query
def profile_columns(spark, sf_dir):
    profile = quality.profile_columns(reports(spark, sf_dir))
    return profile.withColumn("sample_values", F.concat_ws("|", "sample_values"))


# --- summaries of days ---------------------------------------------------------


@query
def profile_from_days(spark, sf_dir):
    """The exact part of a profile merged from days; the estimate beside it has a test."""
    days = summaries.column_summaries(reports(spark, sf_dir), ["source_date"])
    return summaries.profile_of(days).drop("unique_estimate")


@query
def route_metrics_from_days(spark, sf_dir):
    return summaries.route_metrics_of(summaries.route_days(voyages(spark, sf_dir)))


@query
def route_periods(spark, sf_dir):
    return summaries.route_periods(summaries.route_days(voyages(spark, sf_dir)), "month")


@query
def vessel_types_from_days(spark, sf_dir):
    return summaries.activity_by_vessel_type_of(summaries.activity_days(enriched(spark, sf_dir)))


@query
def kpi_from_days(spark, sf_dir):
    return summaries.kpi_of(
        summaries.activity_days(enriched(spark, sf_dir)), summaries.route_days(voyages(spark, sf_dir))
    )
