"""The registered queries once more, as SQL for the oracle."""

from __future__ import annotations

import bridge
from wakeline.schema import LEGACY_NAMES

DAY = "2024-01-15"
VESSEL = 366000008
NAME = "vessel 1"


def mean(expression: str, places: int = 2) -> str:
    """Mean in decimals, rounded half up."""
    total = f"cast(sum(cast({expression} as decimal(18,6))) as double)"
    ratio = f"cast({total} / count({expression}) as decimal(18,10))"
    return f"cast(round({ratio}, {places}) as double)"


def half_up(expression: str, places: int = 2) -> str:
    return f"cast(round(cast({expression} as decimal(18,6)), {places}) as double)"


TIME = (
    "coalesce(try_strptime(base_date_time, '%Y-%m-%dT%H:%M:%S'),"
    " try_strptime(base_date_time, '%Y-%m-%d %H:%M:%S'))"
)

SILVER_COLUMNS = (
    "mmsi, event_time, latitude, longitude, sog, cog, heading, vessel_type, status, draft, cargo"
)


def distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"case when {lat1} is null then null else"
        f" round(2 * 3440.065 * asin(least(1.0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2)))), 4) end"
    )


def voyages_sql(gap_seconds: int, points: int, slow: float, short: float, coastal: float,
                keys: str = "mmsi") -> str:
    return f"""
  select mmsi, start_time, end_time, start_longitude, start_latitude, end_longitude,
         end_latitude, point_count, avg_sog, duration_hours,
         case when avg_sog < {slow} then 'stationary'
              when duration_hours < {short} then 'short_move'
              when duration_hours < {coastal} then 'coastal'
              else 'transit' end as candidate_route_type,
         cast(start_time as date) as start_date
  from (
    select mmsi, min(event_time) as start_time, max(event_time) as end_time,
           arg_min(longitude, event_time) as start_longitude,
           arg_min(latitude, event_time) as start_latitude,
           arg_max(longitude, event_time) as end_longitude,
           arg_max(latitude, event_time) as end_latitude,
           count(*) as point_count, {mean("sog")} as avg_sog,
           cast((date_diff('second', min(event_time), max(event_time)) + 18) // 36 as double)
             / 100.0 as duration_hours
    from (
      select *, sum(opens) over (partition by {keys} order by event_time
                                 rows unbounded preceding) as voyage_id
      from (
        select *, case when date_diff('second', lag(event_time) over
                     (partition by {keys} order by event_time), event_time) <= {gap_seconds}
                  then 0 else 1 end as opens
        from silver)
    ) group by {keys}, voyage_id
  ) where point_count >= {points}"""


def activity_sql(positions: str) -> str:
    return f"""
  select mmsi, cast(event_time as date) as activity_date, count(*) as point_count,
         {mean("sog")} as avg_sog, {half_up("max(sog)")} as max_sog,
         {half_up("min(sog)")} as min_sog, min(event_time) as first_seen_time,
         max(event_time) as last_seen_time
  from {positions} group by 1, 2"""


# Named steps and the steps each one reads.
STEPS: dict[str, tuple[str, list[str]]] = {
    "base": (bridge.BASE_SQL.format(events="events"), []),
    "reports": (bridge.REPORTS_SQL.format(base="base"), ["base"]),
    "attempts": (bridge.ATTEMPTS_SQL.format(events="events"), []),
    "stages": (bridge.STAGES_SQL.format(events="events"), []),
    "typed": (f"select *, {TIME} as event_time from reports", ["reports"]),
    "valid": (
        f"""
  select {SILVER_COLUMNS.replace(" sog,", " case when sog >= 102.3 then null else sog end as sog,")},
         source_date
  from typed
  where mmsi > 99999999 and mmsi < 1000000000 and event_time is not null
    and latitude between -90 and 90 and longitude between -180 and 180
    and not (latitude = 0 and longitude = 0) and (sog is null or sog >= 0)""",
        ["typed"],
    ),
    "silver": (
        """
  select * from valid
  qualify row_number() over (
    partition by mmsi, event_time, source_date
    order by (latitude is null)::int + (longitude is null)::int + (sog is null)::int
        + (cog is null)::int + (heading is null)::int + (vessel_type is null)::int
        + (status is null)::int + (draft is null)::int + (cargo is null)::int,
      latitude nulls first, longitude nulls first, sog nulls first, cog nulls first,
      heading nulls first, vessel_type nulls first, status nulls first, draft nulls first,
      cargo nulls first) = 1""",
        ["valid"],
    ),
    "activity": (activity_sql("silver"), ["silver"]),
    "activity_without_a_day": (
        activity_sql(f"(select * from silver where source_date <> '{DAY}')"),
        ["silver"],
    ),
    "metadata": (
        """
  select mmsi, vessel_name, imo, call_sign, vessel_type, length, width, transceiver
  from typed where mmsi is not null
  qualify row_number() over (
    partition by mmsi
    order by (vessel_name is not null)::int + (imo is not null)::int
        + (call_sign is not null)::int + (vessel_type is not null)::int
        + (length is not null)::int + (width is not null)::int
        + (transceiver is not null)::int desc,
      event_time desc nulls last, vessel_name desc nulls last, imo desc nulls last,
      call_sign desc nulls last, vessel_type desc nulls last, length desc nulls last,
      width desc nulls last, transceiver desc nulls last) = 1""",
        ["typed"],
    ),
    "voyages": (voyages_sql(86400, 3, 10, 24, 48), ["silver"]),
    "routes": (
        f"""
  select sha256(concat(candidate_route_type, '_', cast(start_date as varchar))) as route_id,
         start_date as metric_date, candidate_route_type,
         count(distinct mmsi) as vessel_count, {mean("duration_hours")} as avg_duration_hours,
         {mean("avg_sog")} as avg_speed, cast(sum(point_count) as bigint) as point_count
  from voyages group by candidate_route_type, start_date""",
        ["voyages"],
    ),
    "enriched": (
        """
  select a.*, m.vessel_name, m.vessel_type from activity a
  left join metadata m on a.mmsi = m.mmsi""",
        ["activity", "metadata"],
    ),
    "latest": (
        """
  select file_name, ingested_at, row_count, source_date, status, error from attempts
  qualify row_number() over (partition by file_name order by ingested_at desc,
    row_count desc nulls last, source_date desc nulls last, status desc nulls last,
    error desc nulls last) = 1""",
        ["attempts"],
    ),
    "arcs": (
        """
  select mmsi, start_time, coalesce(start_latitude, 0) as start_latitude,
         coalesce(start_longitude, 0) as start_longitude,
         coalesce(end_latitude, 0) as end_latitude, coalesce(end_longitude, 0) as end_longitude,
         candidate_route_type, duration_hours, coalesce(avg_sog, 0) as avg_sog
  from voyages where candidate_route_type in ('transit', 'coastal') and duration_hours >= 1
    and start_latitude is not null and start_longitude is not null
    and end_latitude is not null and end_longitude is not null""",
        ["voyages"],
    ),
}


def statement(select: str, *steps: str) -> str:
    """``select`` with the steps it reads, in order, as common table expressions."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in STEPS[name][1]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for step in steps:
        visit(step)
    if not ordered:
        return select
    body = ",\n".join(f"{name} as ({STEPS[name][0]})" for name in ordered)
    return f"with {body}\n{select}"


def row_hash(*key: str) -> str:
    return f"md5(concat_ws('|', '42', {', '.join(f'cast({k} as varchar)' for k in key)}))"


REPORT_COLUMNS = [
    "mmsi", "base_date_time", "longitude", "latitude", "sog", "cog", "heading", "vessel_name",
    "imo", "call_sign", "vessel_type", "status", "length", "width", "draft", "cargo",
    "transceiver",
]
ALL_COLUMNS = {
    "report_id": "bigint", "source_date": "string", "mmsi": "bigint", "base_date_time": "string",
    "longitude": "double", "latitude": "double", "sog": "double", "cog": "double",
    "heading": "double", "vessel_name": "string", "imo": "string", "call_sign": "string",
    "vessel_type": "int", "status": "int", "length": "double", "width": "double",
    "draft": "double", "cargo": "int", "transceiver": "string",
}

RANGES = {
    "latitude": ("-90.0", "90.0"),
    "longitude": ("-180.0", "180.0"),
    "sog": ("0", "102.3"),
    "point_count": ("1", "100000"),
}


def check_rows(stage: str, table: str, checks: list[tuple[str, str, str]]) -> str:
    """Union of checks, each (name, passed, detail) over the same aggregate."""
    return " union all ".join(
        f"select '{stage}' as stage, total_rows, {i} as check_no, '{name}' as name,"
        f" {passed} as passed, {detail} as detail from {table}"
        for i, (name, passed, detail) in enumerate(checks, 1)
    )


def rows_check(minimum: int) -> tuple[str, str, str]:
    return (
        "row_count",
        f"total_rows >= {minimum}",
        f"concat('rows=', total_rows, ', min_required={minimum}')",
    )


def null_check(column: str, rate: str) -> tuple[str, str, str]:
    return (
        f"null_rate_{column}",
        f"total_rows > 0 and null_{column} / total_rows <= {rate}",
        f"concat('null_rate=', printf('%.4f', null_{column} / total_rows),"
        f" ', max_allowed={rate}')",
    )


def range_check(column: str) -> tuple[str, str, str]:
    low, high = RANGES[column]
    return (
        f"range_{column}",
        f"out_{column} = 0",
        f"concat('out_of_range=', out_{column}, ', expected=[{low}, {high}]')",
    )


def duplicate_check(rate: str) -> tuple[str, str, str]:
    return (
        "duplicate_rate_mmsi_event_time",
        f"total_rows > 0 and 1 - unique_keys / total_rows <= {rate}",
        f"concat('dup_rate=', printf('%.4f', 1 - unique_keys / total_rows),"
        f" ', max_allowed={rate}')",
    )


def measured(table: str, nulls: list[str], ranges: list[str], unique: bool = False) -> str:
    parts = ["count(*) as total_rows"]
    parts += [f"count(*) filter (where {c} is null) as null_{c}" for c in nulls]
    parts += [
        f"count(*) filter (where {c} < {RANGES[c][0]} or {c} > {RANGES[c][1]}) as out_{c}"
        for c in ranges
    ]
    keys = f"(select count(*) from (select distinct mmsi, event_time from {table}))"
    if unique:
        parts.append(f"{keys} as unique_keys")
    return f"(select {', '.join(parts)} from {table})"


REPORT_CHECKS = measured(
    "typed", ["mmsi", "sog", "vessel_name", "event_time"], ["latitude", "longitude", "sog"], True
)
BRONZE = check_rows(
    "bronze",
    measured("reports", ["mmsi", "latitude"], []),
    [
        rows_check(1000),
        ("schema_completeness", "true", "'all required columns present'"),
        null_check("mmsi", "0.01"),
        null_check("latitude", "0.05"),
    ],
)
SILVER = check_rows(
    "silver",
    measured("silver", ["mmsi", "event_time"], ["latitude", "longitude", "sog"], True),
    [
        rows_check(1000),
        null_check("mmsi", "0.0"),
        null_check("event_time", "0.0"),
        duplicate_check("0.0"),
        range_check("latitude"),
        range_check("longitude"),
        range_check("sog"),
    ],
)
ACTIVITY = check_rows(
    "gold_activity",
    measured("activity", ["mmsi", "activity_date"], ["point_count"]),
    [
        rows_check(100),
        null_check("mmsi", "0.0"),
        null_check("activity_date", "0.0"),
        range_check("point_count"),
    ],
)


def histogram() -> str:
    edge = "lo + ((hi - lo) / 20.0::double) * {}::double"
    passed = " + ".join(f"(avg_sog > {edge.format(i)})::int" for i in range(1, 20))
    return statement(
        f"""
, span as (
  select case when mn = mx then mn - (case when mn = 0 then 0.001 else abs(mn) * 0.001 end)
         else mn end as lo,
         case when mn = mx then mx + (case when mn = 0 then 0.001 else abs(mn) * 0.001 end)
         else mx end as hi
  from (select min(avg_sog) as mn, max(avg_sog) as mx from activity)),
binned as (
  select {passed} as bin, count(*) as n from activity, span where avg_sog is not null group by 1)
select cast(b.bin as int) as bin, round({edge.format("b.bin")}, 4) as above,
       round({edge.format("(b.bin + 1)")}, 4) as upto,
       cast(coalesce(n, 0) as bigint) as record_count
from (select unnest(range(20)) as bin) b cross join span left join binned using (bin)
order by bin""",
        "activity",
    ).replace(")\n\n,", "),", 1)


BRONZE_SQL = (
    f"select {', '.join(REPORT_COLUMNS)}, source_date, cast(year(cast(source_date as date)) as int) as year,"
    " cast(month(cast(source_date as date)) as int) as month,"
    " cast(day(cast(source_date as date)) as int) as day from reports"
)


def oracle() -> dict[str, str]:
    s = statement
    report_fields = "report_id, mmsi, latitude, longitude, sog, cog"
    legacy = {new: old for old, new in LEGACY_NAMES.items()}
    assert set(legacy) == set(REPORT_COLUMNS)
    return {
        "normalize_columns": s("select * from reports", "reports"),
        "scan_reports": s(f"select {', '.join(REPORT_COLUMNS)} from reports", "reports"),
        "scan_reports_quarantine": s(
            "select concat("
            + ", ',', ".join(f"coalesce(cast({c} as varchar), '')" for c in REPORT_COLUMNS)
            + ", ',x,y') as line from reports where report_id % 7 = 0",
            "reports",
        ),
        "scan_reports_clean": s(
            f"select {', '.join(REPORT_COLUMNS)} from reports where report_id % 7 <> 0", "reports"
        ),
        "discover_files": s(
            "select distinct concat('ais-', source_date, '.csv.gz') as file_name, source_date,"
            " true as has_bytes from reports",
            "reports",
        ),
        **{name: s(BRONZE_SQL, "reports") for name in ("ingest_run", "stream_ingest")},
        "ingest_manifest": s(
            "select concat('ais-', source_date, '.csv.gz') as file_name,"
            " count(*) filter (report_id % 7 <> 0) as row_count, source_date, 'success' as status"
            " from reports group by source_date",
            "reports",
        ),
        "ingest_quarantine": s(
            "select concat("
            + ", ',', ".join(f"coalesce(cast({c} as varchar), '')" for c in REPORT_COLUMNS)
            + ", ',x,y') as line, source_date from reports where report_id % 7 = 0",
            "reports",
        ),
        "external_tables": s("select * from routes", "routes"),
        "gold_scan": s("select * from activity", "activity"),
        "gated_run": s("select * from activity", "activity"),
        "rerun_empty_day": s("select * from activity_without_a_day", "activity_without_a_day"),
        "sample_layer": s(
            "select mmsi, latitude, longitude, sog, vessel_type, event_time, source_date"
            " from silver qualify row_number() over (partition by source_date"
            f" order by {row_hash('mmsi', 'event_time')}, mmsi, event_time) <= 20",
            "silver",
        ),
        "bronze_to_gold_run": s("select * from routes", "routes"),
        "file_dates": s(
            "select attempt_id, file_name, nullif(regexp_extract(file_name,"
            " '(\\d{4}-\\d{2}-\\d{2})', 1), '') as file_date from attempts",
            "attempts",
        ),
        "date_parts": s(
            "select report_id, cast(year(cast(source_date as date)) as int) as year,"
            " cast(month(cast(source_date as date)) as int) as month,"
            " cast(day(cast(source_date as date)) as int) as day from reports",
            "reports",
        ),
        "manifest_latest": s("select * from latest", "latest"),
        "manifest_pending": s(
            "select distinct concat('ais-', substr(cast(ts as varchar), 1, 10), '-', user_id + k,"
            " '.csv.zst') as file_name from events, (values (0), (1)) as t(k) except"
            " select file_name from latest where status = 'success'",
            "latest",
        ),
        "manifest_dates": s(
            "select source_date, file_name from latest where status = 'success' order by 1, 2",
            "latest",
        ),
        "manifest_summary": s(
            "select count(*) as total_tracked,"
            " count(*) filter (where status = 'success') as successful,"
            " count(*) filter (where status = 'failed') as failed,"
            " cast(sum(row_count) as bigint) as total_rows,"
            " max(ingested_at) filter (where status = 'success') as last_run from latest",
            "latest",
        ),
        "run_summary": s(
            "select run_id, min(started_at) as started_at, count(*) as total_stages,"
            " cast(round(sum(cast(duration_seconds as decimal(18,6))), 2) as double)"
            " as total_duration_seconds,"
            " count(*) filter (where status = 'success') as stages_passed,"
            " count(*) filter (where status = 'failed') as stages_failed"
            " from stages group by run_id",
            "stages",
        ),
        "run_stages": s(
            "select run_id, stage, started_at, duration_seconds, status from stages"
            " order by 1, 3",
            "stages",
        ),
        "bronze_scan": s(
            "select *, 2024 as year, 1 as month, 15 as day from reports"
            f" where source_date = '{DAY}'",
            "reports",
        ),
        "silver_scan_day": s(f"select * from silver where source_date = '{DAY}'", "silver"),
        "unique_key_violations": s(
            "select mmsi, event_time, count(*) as row_count from typed group by 1, 2"
            " having count(*) > 1",
            "typed",
        ),
        "normalize_timestamp": s("select report_id, base_date_time, event_time from typed", "typed"),
        "normalize_timestamp_lenient":
            "select event_id, concat(' ', replace(cast(ts as varchar), ' ', 'T'), ' ')"
            " as base_date_time, ts as event_time from events",
        "cast_reports": s(
            "select report_id, mmsi, latitude, longitude, sog, cog, heading, vessel_type, status,"
            " draft, cargo from reports",
            "reports",
        ),
        "drop_null_critical": s(
            "select report_id, mmsi, event_time, latitude, longitude from typed"
            " where mmsi is not null and event_time is not null and latitude is not null"
            " and longitude is not null",
            "typed",
        ),
        "null_sentinel": s(
            "select report_id, case when sog >= 102.3 then null else sog end as sog from reports",
            "reports",
        ),
        "drop_null_island": s(
            f"select {report_fields} from reports where not (latitude = 0 and longitude = 0)",
            "reports",
        ),
        "validate_mmsi": s(
            f"select {report_fields} from reports where mmsi > 99999999 and mmsi < 1000000000",
            "reports",
        ),
        "validate_coordinates": s(
            f"select {report_fields} from reports where latitude between -90 and 90"
            " and longitude between -180 and 180",
            "reports",
        ),
        "validate_sog": s(
            f"select {report_fields} from reports where sog is null or (sog >= 0 and sog < 102.3)",
            "reports",
        ),
        "validate_cog": s(
            f"select {report_fields} from reports where cog >= 0 and cog <= 360", "reports"
        ),
        "validate_row": s(
            f"select {report_fields} from reports where mmsi > 99999999 and mmsi < 1000000000"
            " and latitude between -90 and 90 and longitude between -180 and 180"
            " and (sog is null or (sog >= 0 and sog < 102.3))",
            "reports",
        ),
        "dedup_positions": s(
            "select mmsi, event_time, latitude, longitude, sog, status, draft from typed"
            " qualify row_number() over (partition by mmsi, event_time order by"
            " (latitude is null)::int + (longitude is null)::int + (sog is null)::int"
            " + (status is null)::int + (draft is null)::int, latitude nulls first,"
            " longitude nulls first, sog nulls first, status nulls first, draft nulls first) = 1",
            "typed",
        ),
        "build_silver": s("select * from silver", "silver"),
        "time_gaps": s(
            "select mmsi, event_time, longitude, latitude, prev_time,"
            " date_diff('second', prev_time, event_time) / 3600.0::double as time_gap_hours"
            " from (select *, lag(event_time) over (partition by mmsi order by event_time)"
            " as prev_time from silver)",
            "silver",
        ),
        "distance_nm": s(
            "select mmsi, event_time, longitude, latitude, prev_latitude, prev_longitude, "
            + distance("prev_latitude", "prev_longitude", "latitude", "longitude")
            + " as distance_nm from (select *,"
            " lag(latitude) over (partition by mmsi order by event_time) as prev_latitude,"
            " lag(longitude) over (partition by mmsi order by event_time) as prev_longitude"
            " from silver)",
            "silver",
        ),
        "voyage_segments": s(
            "select mmsi, event_time, longitude, latitude, cast(sum(opens) over (partition by mmsi"
            " order by event_time rows unbounded preceding) as bigint) as voyage_id from ("
            "select *, case when date_diff('second', lag(event_time) over (partition by mmsi"
            " order by event_time), event_time) <= 86400 then 0 else 1 end as opens from silver)",
            "silver",
        ),
        "voyage_candidates": s(voyages_sql(86400, 3, 0.5, 1, 12), "silver"),
        "voyage_route_type": s("select * from voyages", "voyages"),
        "voyage_candidates_per_day": s(
            voyages_sql(14400, 2, 0.5, 1, 12, "mmsi, source_date"), "silver"
        ),
        "voyage_sessions": s("select * from voyages", "voyages"),
        "voyage_distance_nm": s(
            "select mmsi, start_time, "
            + distance("start_latitude", "start_longitude", "end_latitude", "end_longitude")
            + " as distance_nm from voyages",
            "voyages",
        ),
        "vessel_track": s(
            "select mmsi, track_date, count(*) as point_count,"
            " arg_min(longitude, event_time) as first_longitude,"
            " arg_min(latitude, event_time) as first_latitude,"
            " arg_max(longitude, event_time) as last_longitude,"
            " arg_max(latitude, event_time) as last_latitude,"
            " cast(sum(place * cast(round((longitude + latitude) * 1000) as bigint)) as bigint)"
            " as order_sum from (select *, cast(event_time as date) as track_date, row_number()"
            " over (partition by mmsi, cast(event_time as date) order by event_time) as place"
            " from silver) group by mmsi, track_date",
            "silver",
        ),
        "daily_activity": s("select * from activity", "activity"),
        "vessel_metadata": s("select * from metadata", "metadata"),
        "route_metrics": s("select * from routes", "routes"),
        "moving_flag": s(
            "select mmsi, event_time, sog, sog > 0.5 as is_moving from silver", "silver"
        ),
        "vessel_class": s(
            "select mmsi, event_time, vessel_type,"
            " case when vessel_type in (30, 31, 32) then 'fishing'"
            " when vessel_type in (36, 37) then 'sailing' when vessel_type = 52 then 'tug'"
            " when vessel_type in (60, 61) then 'passenger'"
            " when vessel_type in (70, 71, 72) then 'cargo'"
            " when vessel_type in (80, 81, 89) then 'tanker' else 'other' end as vessel_class"
            " from silver",
            "silver",
        ),
        "map_points": s(
            "select mmsi, event_time, latitude, longitude, coalesce(sog, 0) as sog,"
            " coalesce(vessel_type, 0) as vessel_type from silver",
            "silver",
        ),
        "speed_ratio": s(
            "select mmsi, event_time, coalesce(sog, 0) as sog,"
            " round(least(greatest(coalesce(sog, 0), 0), top) / top, 6) as speed_ratio"
            " from silver, (select greatest(quantile_cont(coalesce(sog, 0), 0.95), 1) as top"
            " from silver)",
            "silver",
        ),
        "map_center": s(
            "select round(quantile_cont(latitude, 0.5), 4) as center_latitude,"
            " round(quantile_cont(longitude, 0.5), 4) as center_longitude from silver",
            "silver",
        ),
        "filter_activity": s("select * from activity where avg_sog between 5 and 20", "activity"),
        "filter_voyages": s(
            "select * from voyages where candidate_route_type in ('transit', 'coastal')", "voyages"
        ),
        "filter_mmsi": s(f"select * from silver where mmsi = {VESSEL}", "silver"),
        "search_name": s(
            f"select * from enriched where lower(coalesce(vessel_name, '')) like '%{NAME}%'",
            "enriched",
        ),
        "search_name_literal": s(
            f"select * from enriched where lower(coalesce(vessel_name, '')) like '%{NAME}%'",
            "enriched",
        ),
        "voyages_by_name": s(
            "select * from voyages where mmsi in (select mmsi from enriched"
            f" where lower(coalesce(vessel_name, '')) like '%{NAME}%')",
            "voyages",
            "enriched",
        ),
        "voyage_arcs": s("select * from arcs", "arcs"),
        "voyage_arcs_drawn": s(
            f"select * from arcs order by {row_hash('mmsi', 'start_time')}, mmsi, start_time"
            " limit 300",
            "arcs",
        ),
        "activity_enriched": s("select * from enriched", "enriched"),
        "activity_by_vessel_type": s(
            f"select vessel_type, count(distinct mmsi) as vessel_count,"
            f" {mean('point_count', 0)} as avg_daily_points, {mean('avg_sog')} as avg_speed"
            " from enriched group by vessel_type",
            "enriched",
        ),
        "route_type_breakdown": s(
            "select candidate_route_type, count(*) as day_count,"
            f" {mean('vessel_count', 0)} as avg_daily_vessels,"
            f" {mean('avg_duration_hours')} as avg_duration, {mean('avg_speed')} as avg_speed"
            " from routes group by candidate_route_type",
            "routes",
        ),
        "top_active_vessels": s(
            "select mmsi, vessel_name, cast(sum(point_count) as bigint) as total_points,"
            f" {mean('avg_sog')} as avg_speed, {half_up('max(max_sog)')} as max_speed,"
            " count(distinct activity_date) as days_active from enriched"
            " where vessel_name is not null group by 1, 2"
            " order by total_points desc, mmsi limit 50",
            "enriched",
        ),
        "route_type_counts": s(
            "select candidate_route_type, count(*) as voyages from voyages group by 1", "voyages"
        ),
        "speed_histogram": histogram(),
        "kpi_summary": s(
            "select (select count(distinct mmsi) from metadata) as unique_vessels,"
            " (select count(*) from voyages where candidate_route_type in ('transit', 'coastal'))"
            " as voyage_segments,"
            " (select count(*) from activity where avg_sog between 5 and 20) as daily_records,"
            " cast(sum(point_count) as bigint) as total_positions,"
            " count(distinct activity_date) as available_days from activity",
            "metadata",
            "voyages",
            "activity",
        ),
        "filter_options": s(
            "select distinct 'activity_date' as option, cast(activity_date as varchar) as value"
            " from activity union all select distinct 'candidate_route_type',"
            " candidate_route_type from voyages union all"
            " select 'max_avg_sog', cast(max(avg_sog) as varchar) from activity",
            "activity",
            "voyages",
        ),
        "top_vessels_on_date": s(
            "select mmsi, vessel_name, vessel_type, activity_date, point_count, avg_sog, max_sog,"
            f" first_seen_time, last_seen_time from enriched where activity_date = date '{DAY}'"
            " order by point_count desc, mmsi limit 20",
            "enriched",
        ),
        "speed_anomalies": s(
            "select mmsi, vessel_name, activity_date, avg_sog, max_sog, point_count from enriched"
            " where max_sog > 30 order by max_sog desc, mmsi, activity_date limit 50",
            "enriched",
        ),
        "route_distribution": s(
            "select metric_date, candidate_route_type, vessel_count, avg_duration_hours,"
            " avg_speed, point_count from routes order by metric_date, vessel_count desc",
            "routes",
        ),
        "transit_trend": s(
            "select metric_date, vessel_count, avg_duration_hours, avg_speed from routes"
            " where candidate_route_type = 'transit' order by metric_date",
            "routes",
        ),
        "longest_voyages": s(
            "select mmsi, start_time, end_time, duration_hours, avg_sog, candidate_route_type,"
            " point_count, start_latitude, start_longitude, end_latitude, end_longitude"
            " from voyages order by duration_hours desc, mmsi, start_time limit 100",
            "voyages",
        ),
        "vessel_lookup_meta": s(f"select * from metadata where mmsi = {VESSEL}", "metadata"),
        "vessel_lookup_activity": s(
            "select activity_date, point_count, avg_sog, max_sog, first_seen_time, last_seen_time"
            f" from activity where mmsi = {VESSEL} order by activity_date",
            "activity",
        ),
        "vessel_lookup_voyages": s(
            "select start_time, end_time, duration_hours, avg_sog, candidate_route_type"
            f" from voyages where mmsi = {VESSEL} order by start_time",
            "voyages",
        ),
        "vessel_lookup_track": s(
            "select mmsi, event_time, latitude, longitude, coalesce(sog, 0) as sog, cog, heading,"
            " coalesce(vessel_type, 0) as vessel_type, status, draft, cargo, source_date"
            f" from silver where mmsi = {VESSEL} order by event_time",
            "silver",
        ),
        "stratified_sample": s(
            "select mmsi, latitude, longitude, sog, vessel_type, event_time, source_date"
            " from silver qualify row_number() over (partition by source_date"
            f" order by {row_hash('mmsi', 'event_time')}, mmsi, event_time) <= 20",
            "silver",
        ),
        "proportional_sample": s(
            "select mmsi, event_time, source_date, sog from (select * from silver"
            " qualify row_number() over (partition by source_date"
            f" order by {row_hash('mmsi', 'event_time')}, mmsi, event_time) <= greatest("
            "500 // (select count(distinct source_date) from silver), 1000))"
            f" order by {row_hash('mmsi', 'event_time')}, mmsi, event_time limit 500",
            "silver",
        ),
        "capped_sample": s(
            "select mmsi, event_time, latitude, longitude from silver"
            f" order by {row_hash('mmsi', 'event_time')}, mmsi, event_time limit 500",
            "silver",
        ),
        "check_row_count": s(
            check_rows("reports", REPORT_CHECKS, [rows_check(1000), rows_check(10_000_000_000)]),
            "typed",
        ),
        "check_null_rate": s(
            check_rows(
                "reports",
                REPORT_CHECKS,
                [null_check(c, "0.05") for c in ("mmsi", "sog", "vessel_name", "event_time")],
            ),
            "typed",
        ),
        "check_duplicate_rate": s(
            check_rows("reports", REPORT_CHECKS, [duplicate_check("0.01")]), "typed"
        ),
        "check_value_range": s(
            check_rows(
                "reports",
                REPORT_CHECKS,
                [range_check(c) for c in ("latitude", "longitude", "sog")],
            ),
            "typed",
        ),
        "check_completeness": s(
            check_rows(
                "reports",
                REPORT_CHECKS,
                [
                    ("schema_completeness", "true", "'all required columns present'"),
                    (
                        "schema_completeness",
                        "false",
                        "'missing_columns=[''speed'', ''port'']'",
                    ),
                ],
            ),
            "typed",
        ),
        "quality_bronze": s(BRONZE, "reports"),
        "quality_silver": s(SILVER, "silver"),
        "quality_activity": s(ACTIVITY, "activity"),
        "quality_summary": s(
            "select stage, max(total_rows) as total_rows, count(*) as checks_run,"
            " count(*) filter (where passed) as checks_passed,"
            " count(*) filter (where not passed) as checks_failed,"
            " bool_and(passed) as overall_passed"
            f" from ({BRONZE} union all {SILVER} union all {ACTIVITY}) group by stage",
            "reports",
            "silver",
            "activity",
        ),
        "null_report": s(
            " union all ".join(
                f"select '{c}' as column_name, count(*) as total_rows,"
                f" count(*) filter (where {c} is null) as null_count,"
                f" round(count(*) filter (where {c} is null) / count(*), 4) as null_rate"
                " from reports"
                for c in ALL_COLUMNS
            ),
            "reports",
        ),
        "profile_columns": s(
            " union all ".join(
                f"select '{c}' as column_name, '{kind}' as dtype,"
                f" count(*) filter (where {c} is null) as null_count,"
                f" round(count(*) filter (where {c} is null) / count(*), 4) as null_rate,"
                f" count(distinct {c}) as unique_count,"
                f" (select string_agg(v, '|' order by v) from (select distinct"
                f" cast({c} as varchar) as v from reports where {c} is not null"
                " order by v limit 3)) as sample_values from reports"
                for c, kind in ALL_COLUMNS.items()
            ),
            "reports",
        ),
        "profile_from_days": s(
            " union all ".join(
                f"select '{c}' as column_name, '{kind}' as dtype, count(*) as total_rows,"
                f" count(*) filter (where {c} is null) as null_count,"
                f" round(count(*) filter (where {c} is null) / count(*), 4) as null_rate,"
                f" min(cast({c} as varchar)) as smallest, max(cast({c} as varchar)) as largest"
                " from reports"
                for c, kind in ALL_COLUMNS.items()
                if c != "source_date"
            ),
            "reports",
        ),
        "route_metrics_from_days": s("select * from routes", "routes"),
        "route_periods": s(
            "select candidate_route_type, cast(date_trunc('month', start_time) as date) as period,"
            " count(distinct mmsi) as vessel_count, count(*) as voyages,"
            " cast(sum(point_count) as bigint) as point_count,"
            f" {mean('duration_hours')} as avg_duration_hours, {mean('avg_sog')} as avg_speed"
            " from voyages group by 1, 2",
            "voyages",
        ),
        "vessel_types_from_days": s(
            f"select vessel_type, count(distinct mmsi) as vessel_count,"
            f" {mean('point_count', 0)} as avg_daily_points, {mean('avg_sog')} as avg_speed"
            " from enriched group by vessel_type",
            "enriched",
        ),
        "kpi_from_days": s(
            "select (select count(distinct mmsi) from activity) as unique_vessels,"
            " (select count(*) from voyages) as voyage_segments, count(*) as daily_records,"
            " cast(sum(point_count) as bigint) as total_positions,"
            " count(distinct activity_date) as available_days from activity",
            "voyages",
            "activity",
        ),
    }
