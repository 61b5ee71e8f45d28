"""Plan shape of every registered query (what would hurt at scale)."""

import re

import pytest

from conftest import SF_SMALL
from headway.plans import registry

# Queries that run actions while being built (a streaming replay, a model fit).
EAGER = {"cascade_flags_stream", "route_speed_stream", "model_metrics", "refresh_models",
         "upsert_table_state", "upsert_profiles", "trip_delay_stream", "running_cascades_stream",
         "cascade_features_stream", "cascade_labels_stream", "ingest_counts_stream", "quality_stream",
         "ingest_totals_stream"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - EAGER))
def test_no_nested_loops_or_python(spark, name):
    plan = _plan(registry.QUERIES[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node} in plan"


def test_messages_are_parsed_once(spark):
    df = registry.QUERIES["trip_delay"](spark, SF_SMALL)
    plan = _plan(df)
    # One from_json, inside the generator; none re-inlined into filters.
    assert len(re.findall(r"from_json\(", plan)) == 1
    assert re.search(r"Generate explode\(array\(from_json", plan)
    # Partial aggregate before the shuffle on the window keys.
    assert "partial_max(arrival_delay_sec" in plan


@pytest.mark.parametrize("name", ["route_delay_hourly", "route_profiles"])
def test_rollups_read_their_input_once(spark, name):
    """All measures come from one histogram: no self-join, one scan of the trips."""
    plan = _plan(registry.QUERIES[name](spark, SF_SMALL))
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") <= (name == "route_delay_hourly")
    assert len(re.findall(r"from_json\(", plan)) <= 1


def test_kpi_scans_are_limited_in_time(spark):
    plan = _plan(registry.QUERIES["kpi_summary"](spark, SF_SMALL))
    assert plan.count("GreaterThanOrEqual(ts,") >= 3
