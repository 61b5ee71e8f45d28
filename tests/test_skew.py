"""A third of all events on one user (one trip, vehicle and key): results
still equal the oracle on the same skewed tables."""

import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from parity import compare, duck

QUERIES = ["trip_delay", "cascade_flags", "route_reliability", "latest_route_state",
           "hotspots_like", "merge_upsert", "route_profiles", "kpi_summary"]


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skewed"))
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(7).cast("bigint")).otherwise(F.col("user_id"))
    (ev.withColumn("user_id", hot).coalesce(1).write.parquet(f"{d}/events.parquet"))
    for t in ("supplier", "region", "nation", "customer", "part", "orders", "lineitem",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_matches_oracle(spark, skewed_dir, name):
    ok, msg = compare(entry.queries()[name](spark, skewed_dir), entry.oracle_sql()[name],
                      duck(skewed_dir))
    assert ok, f"{name}: {msg}"
