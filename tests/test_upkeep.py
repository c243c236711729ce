"""Tables kept up to date by days, against tables built anew."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wakeline.functions.times import date_parts
from wakeline.operators.gold import best_descriptions
from wakeline.operators.voyages import FRAGMENT_FIELDS, voyage_summaries, voyages_of
from wakeline.plans import daily, upkeep
from wakeline.rules import VoyageRules
from wakeline.schema import BRONZE_SCHEMA, TABLES
from wakeline.sources.tables import (
    BRONZE_PARTITIONS,
    layer_path,
    read_bronze,
    read_table,
    replace_partitions,
    staging_path,
    state_path,
    write_partitioned,
)

START = dt.datetime(2025, 1, 1)
RULES = VoyageRules(gap_hours=4.0, min_points=3)
FRAGMENT = (
    "mmsi long, track_date date, start_time timestamp_ntz, end_time timestamp_ntz, start_longitude double,"
    " start_latitude double, end_longitude double, end_latitude double, point_count long, sog_micro long, sog_count long"
)


def reports(spark, days, vessels=8):
    """Hourly reports; vessels rest at night, but for the last, which never does."""
    hours = spark.range(days * 24 * vessels).select(
        (F.lit(366000000) + F.col("id") % vessels).alias("mmsi"), (F.col("id") / vessels).cast("long").alias("hour")
    )
    time = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hour").cast("int"))
    rows = hours.where((F.col("hour") % 24 < 17) | (F.col("mmsi") == 366000000 + vessels - 1)).select(
        "mmsi",
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss").alias("base_date_time"),
        ((F.col("hour") % 100) / 10 - 90).alias("longitude"),
        ((F.col("hour") % 77) / 10 + 20).alias("latitude"),
        (F.col("hour") % 9 + 0.5).alias("sog"),
        F.concat(F.lit("SHIP "), F.col("mmsi").cast("string")).alias("vessel_name"),
        F.date_format(time, "yyyy-MM-dd").alias("source_date"),
    )
    rows = rows.select("*", *date_parts(F.col("source_date")))
    missing = [f for f in BRONZE_SCHEMA.fields if f.name not in rows.columns]
    rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    return rows.select(*BRONZE_SCHEMA.names)


def rows_read(spark, action):
    """Rows that all tasks of an action read from tables."""
    sc = spark.sparkContext
    store, none = sc._jsc.sc().statusStore(), sc._gateway.new_array(sc._jvm.double, 0)

    def stages():
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        found = store.stageList(None, False, False, none, None)
        return {found.apply(i).stageId(): found.apply(i).inputRecords() for i in range(found.size())}

    before = max(stages(), default=-1)
    action()
    return sum(n for stage, n in stages().items() if stage > before)


def same(spark, left, right, tables=TABLES):
    for table in tables:
        a, b = read_table(spark, left, table), read_table(spark, right, table)
        assert a.count() > 0, table
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0, table


def test_a_day_costs_its_day(spark, tmp_path):
    """As many rows are read after 120 days as after 15, for a new day and for one run again."""
    read = {}
    for days in (15, 120):
        root = str(tmp_path / str(days))
        bronze = reports(spark, days)
        last = (START + dt.timedelta(days=days - 1)).strftime("%Y-%m-%d")
        write_partitioned(bronze.where(F.col("source_date") < last), layer_path(root, "bronze"), BRONZE_PARTITIONS)
        daily.run_all(spark, root, rules=RULES, gate=False)
        write_partitioned(bronze.where(F.col("source_date") == last), layer_path(root, "bronze"), BRONZE_PARTITIONS)
        new = rows_read(spark, lambda: daily.run_day(spark, root, last, rules=RULES, gate=False))
        again = rows_read(spark, lambda: daily.run_day(spark, root, last, rules=RULES, gate=False))
        read[days] = new, again
        voyages = read_table(spark, root, "voyage_candidates")
        assert voyages.agg(F.max("duration_hours")).first()[0] == days * 24 - 1
    assert all(later <= 1.05 * earlier for earlier, later in zip(read[15], read[120])), read
    root, whole = str(tmp_path / "15"), str(tmp_path / "whole")
    write_partitioned(read_bronze(spark, root), layer_path(whole, "bronze"), BRONZE_PARTITIONS)
    daily.run_all(spark, whole, rules=RULES, gate=False)
    same(spark, root, whole)


def random_day(draw, vessel, day, near=0.3):
    """A vessel's fragments of a day, apart by more than a pause; some reach the ends of the day."""
    out, hour = [], draw.choice([0, 0, 0, 1, 5, 9])
    while hour < 24 and draw.random() < 0.85:
        end = min(23.9, hour + draw.choice([0, 0.5, 3, 8, 23.9]))
        at = START + dt.timedelta(days=day)
        n = draw.randint(1, 9)
        out.append(
            (vessel, at.date(), at + dt.timedelta(hours=hour), at + dt.timedelta(hours=end),
             *[float(draw.randint(-90, 90)) for _ in range(4)], n, draw.randint(0, 10**7), draw.randint(0, n))
        )
        hour = end + 4.1 + draw.random()
    return out


@pytest.mark.parametrize("gap", [4.0, 30.0])
def test_revised_voyages_equal_rebuilt_ones(spark, tmp_path, gap):
    """Random days change: voyages join, split, shrink and go, long ones in their middle too."""
    draw, rules = random.Random(int(gap)), VoyageRules(gap_hours=gap, min_points=3)
    days = 24
    state = {(v, d): random_day(draw, v, d) for v in range(6) for d in range(days)}
    for v in (6, 7):  # never at rest
        for d in range(days):
            at = START + dt.timedelta(days=d)
            state[v, d] = [(v, at.date(), at, at + dt.timedelta(hours=23.5), 1.0 * d, 2.0, 3.0, 1.0 * d, 9, 5 * d, 9)]
    root, days_run = str(tmp_path), []

    def publish(frame, dates):
        days_run.append(dates)
        schema, partitions, _ = TABLES["voyage_candidates"]
        path = layer_path(root, "voyage_candidates")
        return upkeep.write_counted(frame.select(*schema.names), path, partitions, dates)

    def fragments(keep=lambda d: True):
        rows = [r for (_, d), own in state.items() if keep(d) for r in own]
        return spark.createDataFrame(rows, FRAGMENT)

    def check():
        want = voyages_of(voyage_summaries(fragments(), rules), rules)
        got = read_table(spark, root, "voyage_candidates").select(*want.columns)
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
        kept = spark.read.schema(FRAGMENT).parquet(state_path(root, f"voyage_fragments_{rules.gap_seconds:g}s"))
        kept = kept.select(*fragments().columns)
        assert kept.exceptAll(fragments()).count() == 0 == fragments().exceptAll(kept).count()

    def voyages():
        return upkeep.Voyages(spark, root, rules, ["mmsi"], "run", publish)

    assert not voyages().ready()
    voyages().rebuild(fragments())
    assert voyages().ready()
    check()
    changes = [
        {11: None},  # a day in the middle is lost, so the two long voyages break
        {11: (0, 7)},  # and found again
        {23: (0, 1, 2, 3), 24: (0, 1, 7)},  # the last day again, and a new one
        {2: (0, 3), 3: (4, 5), 15: (0, 1, 2, 3, 4, 5)},  # days far apart
        {0: None},
    ]
    for change in changes if gap < 24 else changes[:2]:
        for day, who in change.items():
            for v in range(8):
                if who is None or v in who:
                    state[v, day] = [] if who is None else random_day(draw, v, day)
        before = len(days_run)
        rows, starts = voyages().revise(fragments(lambda d: d in change), [(START + dt.timedelta(days=d)).date() for d in change])
        assert {day for run in days_run[before:] for day in run} == set(starts)
        check()
    # nothing changes: nothing is written
    before = len(days_run)
    assert voyages().revise(fragments(lambda d: d == 5), [(START + dt.timedelta(days=5)).date()]) == (0, [])
    assert len(days_run) == before
    # a run that broke off, or rules that differ, are no ground to build on
    voyages()._write_note("broken off")
    assert not voyages().ready()
    other = VoyageRules(gap_hours=gap, min_points=4)
    assert not upkeep.Voyages(spark, root, other, ["mmsi"], "run", publish).ready()


def test_another_run_at_the_same_time(spark, tmp_path):
    """A run that finds another's note in place of its own rebuilds from all fragments."""
    draw, root = random.Random(1), str(tmp_path)
    state = {(v, d): random_day(draw, v, d) for v in range(3) for d in range(6)}
    table = {}

    def publish(frame, dates):
        if dates is not None and not table.get("met"):
            table["met"] = True
            # the other run has brought its day in and is done
            other = upkeep.Voyages(spark, root, RULES, ["mmsi"], "other", publish)
            state[0, 4] = []
            other.revise(day(4), [(START + dt.timedelta(days=4)).date()])
        schema, partitions, _ = TABLES["voyage_candidates"]
        return upkeep.write_counted(
            frame.select(*schema.names), layer_path(root, "voyage_candidates"), partitions, dates
        )

    def day(n):
        return spark.createDataFrame([r for (_, d), own in state.items() if d == n for r in own], FRAGMENT)

    def every():
        return spark.createDataFrame([r for own in state.values() for r in own], FRAGMENT)

    upkeep.Voyages(spark, root, RULES, ["mmsi"], "first", publish).rebuild(every())
    state[0, 1] = random_day(draw, 0, 1)
    state[1, 1] = []
    run = upkeep.Voyages(spark, root, RULES, ["mmsi"], "one", publish)
    _, starts = run.revise(day(1), [(START + dt.timedelta(days=1)).date()])
    assert table["met"] and starts is None
    want = voyages_of(voyage_summaries(every(), RULES), RULES)
    got = read_table(spark, root, "voyage_candidates").select(*want.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert upkeep.Voyages(spark, root, RULES, ["mmsi"], "next", publish).ready()


def test_best_descriptions_follow_days(spark, tmp_path):
    schema = "mmsi long, source_date string, vessel_name string, imo string, latest timestamp_ntz"
    root, out = str(tmp_path), {}
    at = [START + dt.timedelta(hours=h) for h in range(9)]
    state = {
        "2025-01-01": [(1, "a", None, at[0]), (2, "b", "x", at[1]), (3, None, None, None)],
        "2025-01-02": [(1, "a", "y", at[2]), (2, "b", None, at[3]), (4, "d", "z", at[3])],
        "2025-01-03": [(2, "c", "x", at[4])],
    }

    def folded(dates):
        rows = [(m, d, *r) for d in dates for m, *r in state.get(d, [])]
        return spark.createDataFrame(rows, schema)

    def publish(frame, _):
        out["rows"] = sorted(map(tuple, frame.collect()), key=str)
        return len(out["rows"])

    tables = upkeep.Descriptions(spark, root, publish)
    assert not tables.ready()
    tables.rebuild(folded(state), None)
    changes = [
        {"2025-01-03": []},  # what was best is gone, an older one is best again
        {"2025-01-04": [(3, "e", None, at[5]), (5, None, None, at[5])]},
        {"2025-01-02": [(1, "a", None, at[6])], "2025-01-03": [(4, None, None, at[1])]},
        {"2025-01-01": []},
    ]
    for change in changes:
        state |= change
        assert tables.ready()
        tables.revise(folded(change), list(change))
        want = best_descriptions(folded(state)).select("mmsi", "best.vessel_name", "best.imo").collect()
        assert out["rows"] == sorted(map(tuple, want), key=str)


def test_runs_of_other_partitions_do_not_meet(spark, tmp_path):
    """Each has a staging place of its own, and a lost one is an error, not an empty day."""
    path = str(tmp_path / "t")
    days = ["2025-01-01", "2025-01-02"]
    frame = spark.createDataFrame([(1, days[0]), (2, days[1])], "x int, d string")
    write_partitioned(frame, path, ["d"])

    def meanwhile(_):
        other = spark.createDataFrame([(30, days[0])], "x int, d string")
        replace_partitions(other, path, ["d"], [(days[0],)])

    later = spark.createDataFrame([(40, days[1])], "x int, d string")
    replace_partitions(later, path, ["d"], [(days[1],)], meanwhile)
    rows = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert [r[0] for r in rows] == [30, 40]
    assert not list((tmp_path / "staging").iterdir())
    assert staging_path(path) != staging_path(path)

    def cleared(_):
        for place in (tmp_path / "staging").iterdir():
            place.rename(tmp_path / "elsewhere")

    with pytest.raises(FileNotFoundError):
        replace_partitions(later, path, ["d"], [(days[1],)], cleared)
    assert spark.read.parquet(path).count() == 2


def test_fields_of_fragments_are_those_of_summaries():
    assert FRAGMENT_FIELDS[-3:] == ["point_count", "sog_micro", "sog_count"]
