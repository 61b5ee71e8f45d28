"""Every registered query against its DuckDB twin (sf0.001)."""

import pytest

import __spark_entry__ as entry
from headway.plans import registry
from conftest import SF_SMALL
from parity import compare, duck

ORACLE = registry.oracle()
QUERIES = registry.QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], con)
    assert ok, f"{name}: {msg}"


def test_every_query_has_oracle_or_is_known():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"model_metrics"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "route_id", "agency", "total_trips", "delayed_trips",
                          "delayed_pct", "is_cascade", "cascade_score"]
    assert df.count() > 0
