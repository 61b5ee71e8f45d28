"""Registered queries: one per operator row of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input tables.  Computed columns carry the same names as in the
DuckDB twins of :mod:`headway.plans.oracle`.
"""

from __future__ import annotations

from headway.functions.columns import round_dec
from headway.plans import batch, live, oracle_live
from headway.plans import oracle as duck_sql


def _r9(df, *cols):
    """Raw averages and percentiles rounded to 9 places for the parity
    check (engines differ in the last bit of a mean of means)."""
    return df.select(*[round_dec(c, 9).alias(c) if c in cols else c for c in df.columns])

QUERIES = {
    "trip_delay": batch.trip_delay_windows,
    "cascade_flags": batch.cascade_windows,
    "stg_trip_delay_events": batch.stg_trips,
    "stg_cascade_flags": batch.stg_flags,
    "route_delay_hourly": lambda s, d: _r9(batch.hourly(s, d), "avg_delay_sec",
                                           "p50_delay_sec", "p95_delay_sec"),
    "route_reliability": lambda s, d: _r9(batch.reliability(s, d), "daily_avg_delay_sec",
                                          "typical_p95_delay_sec"),
    "feed_vehicle_positions": batch.feed_vehicle_positions,
    "vehicle_positions": batch.vehicles,
    "feed_trip_updates": batch.feed_trip_updates,
    "trip_topic_messages": batch.trip_topic_text,
    "stop_updates": batch.stop_rows,
    "ingest_counts": batch.topic_ingest_counts,
    "route_speed_agg": lambda s, d: _r9(batch.speed_windows(s, d), "avg_speed_mph",
                                        "speed_stddev"),
    "latest_route_state": batch.route_state,
    "incremental_filter": batch.incremental_q,
    "incremental_filter_lookback": batch.incremental_lookback_q,
    "merge_upsert": batch.merge_q,
    "quality_report": batch.quality_q,
    "freshness": batch.freshness_q,
    "kpi_summary": batch.kpi_q,
    "delay_distribution": batch.distribution_q,
    "active_cascades": batch.active_cascades_q,
    "route_status": batch.route_status_q,
    "route_trend": batch.route_trend_q,
    "reliability_latest": batch.reliability_latest_q,
    "ingest_throughput": batch.throughput_q,
    "route_profiles": lambda s, d: _r9(batch.profiles_q(s, d), "avg_delay_sec",
                                       "stddev_delay_sec", "p50_delay_sec", "p95_delay_sec",
                                       "severe_share"),
    "cascade_features": lambda s, d: _r9(batch.features_q(s, d), "profile_avg_delay_sec",
                                         "profile_p95_delay_sec"),
    "cascade_labels": batch.labels_q,
    "model_metrics": batch.model_metrics_q,
    "route_delay_hourly_by_agency": lambda s, d: _r9(
        batch.hourly(s, d, by_agency=True, distinct_trips=True), "avg_delay_sec",
        "p50_delay_sec", "p95_delay_sec"),
    "route_reliability_by_agency_range": lambda s, d: _r9(
        batch.reliability(s, d, by_agency=True, frame="range", null_score="propagate"),
        "daily_avg_delay_sec", "typical_p95_delay_sec"),
    "cascade_flags_wide": batch.cascade_wide,
    "cascade_flags_stream": batch.cascade_stream_q,
    "hotspots_like": batch.hotspots_like_q,
    "hotspots_by_stop": batch.hotspots_by_stop_q,
    "route_speed_stream": lambda s, d: _r9(batch.speed_stream_q(s, d), "avg_speed_mph",
                                           "speed_stddev"),
    "upsert_table_state": batch.upsert_state_q,
    "upsert_profiles": lambda s, d: _r9(batch.upsert_profiles_q(s, d), "avg_delay_sec",
                                        "stddev_delay_sec", "p50_delay_sec", "p95_delay_sec",
                                        "severe_share"),
    "refresh_models": lambda s, d: _r9(batch.refresh_q(s, d), "daily_avg_delay_sec",
                                       "typical_p95_delay_sec"),
    "table_freshness": batch.table_freshness_q,
    "score_metrics": batch.score_metrics_q,
    "trip_delay_stream": live.trips_stream_q,
    "running_cascades_stream": live.running_cascades_q,
    "cascade_features_stream": live.features_stream_q,
    "cascade_labels_stream": live.labels_stream_q,
    "ingest_counts_stream": live.counts_in_flight_q,
    "quality_stream": live.quality_in_flight_q,
    "ingest_totals_stream": live.totals_stream_q,
    "route_trend_full": batch.route_trend_full_q,
    "active_vehicles_sketch": batch.active_vehicles_q,
    "delay_percentiles_sketch": batch.sketched_percentiles_q,
}


def oracle() -> dict[str, str]:
    sql = duck_sql.all_sql() | oracle_live.all_sql()
    return {k: v for k, v in sql.items() if k in QUERIES}
