"""Every registered query against its SQL, and the shape of every plan."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import entry_oracle
import entry_queries
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(entry_queries.QUERIES) == set(entry_oracle.oracle())
    assert set(entry_queries.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry_queries.QUERIES))
def test_query_equals_oracle(spark, con, name):
    problem, _ = compare(spark, con, name, SF)
    assert problem is None


@pytest.mark.parametrize("name", sorted(entry_queries.QUERIES))
def test_plan_has_nothing_that_does_not_scale(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                 "InPandas", "ExistingRDD"):
        assert word not in plan


def test_entry(spark):
    assert entry.entry(spark).count() == 93


def test_class_coverage(spark):
    """Counts known for these tables and limits."""
    voyages = entry_queries.voyages(spark, SF)
    counts = {r["candidate_route_type"]: r["count"] for r in voyages.groupBy("candidate_route_type").count().collect()}
    assert counts == {"stationary": 29, "short_move": 11, "coastal": 11, "transit": 42}


def windows(spark, frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Window [" in line]


def test_no_window_over_a_whole_track_of_points(spark):
    """Points are only ordered within a vessel and day."""
    q = entry_queries

    for name in ("time_gaps", "distance_nm", "voyage_segments", "voyage_candidates"):
        for line in windows(spark, q.QUERIES[name](spark, SF)):
            assert "track_date" in line or "start_time" in line, (name, line)


def test_two_exchanges_lead_to_fragments(spark):
    q = entry_queries

    plan = q.voyages(spark, SF)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # unique positions, points by vessel and day, fragments by vessel
    assert len(exchanges) == 3
