"""DuckDB SQL twins of the streaming and sketch queries: what the batch semantics
give for the windows that a replay closes."""

from __future__ import annotations

from headway.plans.oracle import ADAPTER, AS_OF, BASE, round_dec, rush, stg_ctes, with_

#: Trip windows that the final watermark (newest event less 5 minutes) has passed.
CLOSED = "window_start + INTERVAL '10 minutes' <= (SELECT max(event_ts) FROM stu) - INTERVAL '5 minutes'"
NEWEST = f"(SELECT max(window_start) FROM cascade WHERE {CLOSED})"


def all_sql() -> dict[str, str]:
    return {
        "trip_delay_stream": with_(*BASE) + f"""
SELECT * FROM trip_delay WHERE {CLOSED}""",
        # Open windows too: the newest running counts are those of all rows.
        "running_cascades_stream": with_(*BASE) + """
SELECT * FROM cascade""",
        "cascade_features_stream": with_(*BASE) + f"""
SELECT t.*, CAST(hour(t.window_start) AS INTEGER) AS hour_of_day, {rush('hour(t.window_start)')} AS is_rush_hour,
       t.max_arrival_delay_sec / 3600.0 AS delay_norm, c.total_trips AS route_load
FROM (SELECT * FROM trip_delay WHERE {CLOSED}) t
LEFT JOIN cascade c
  ON t.route_id = c.route_id AND t.agency = c.agency AND t.window_start = c.window_start""",
        "cascade_labels_stream": with_(*BASE) + f"""
SELECT t.*, COALESCE(CAST(c.is_cascade AS DOUBLE), 0.0) AS label
FROM (SELECT * FROM trip_delay WHERE window_start < date_trunc('hour', {NEWEST}) - INTERVAL '1 hour') t
LEFT JOIN (SELECT * FROM cascade WHERE {CLOSED}) c
  ON t.route_id = c.route_id AND t.agency = c.agency
 AND t.window_start = c.window_start - INTERVAL '10 minutes'""",
        "ingest_counts_stream": with_(ADAPTER) + """
SELECT topic, agency, CAST(count(*) AS BIGINT) AS published
FROM (SELECT agency FROM tu), (VALUES ('gtfs.vehicle_positions'), ('gtfs.trip_updates')) t(topic)
GROUP BY topic, agency""",
        "quality_stream": with_(*BASE) + f""",
w AS (SELECT * FROM trip_delay WHERE {CLOSED})
SELECT 'trip_delay_events' AS table_name, 'max_null_pct_route_id' AS check_name,
       count(*) FILTER (WHERE route_id IS NULL) / greatest(CAST(count(*) AS DOUBLE), 1.0) AS observed,
       CAST(0.01 AS DOUBLE) AS threshold,
       count(*) FILTER (WHERE route_id IS NULL) <= 0.01 * count(*) AS passed FROM w
UNION ALL
SELECT 'trip_delay_events', 'max_delay_sec', CAST(count(*) FILTER (WHERE max_arrival_delay_sec > 7200) AS DOUBLE),
       CAST(7200 AS DOUBLE), count(*) FILTER (WHERE max_arrival_delay_sec > 7200) = 0 FROM w""",
        "ingest_totals_stream": with_(ADAPTER) + """
SELECT window_start, topic, messages,
       CAST(sum(messages) OVER (PARTITION BY topic ORDER BY window_start
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_messages
FROM (SELECT time_bucket(INTERVAL '1 hour', event_ts, TIMESTAMP '1970-01-01') AS window_start,
             topic, count(*) AS messages
      FROM tu, (VALUES ('gtfs.vehicle_positions'), ('gtfs.trip_updates')) t(topic) GROUP BY 1, 2)
WHERE window_start + INTERVAL '1 hour' <= (SELECT max(event_ts) FROM tu) - INTERVAL '10 minutes'""",
        "route_trend_full": with_(*BASE) + f""",
b AS (SELECT route_id, agency, CAST(floor((epoch_us(window_start) - epoch_us(TIMESTAMP '2024-01-30 00:00:00'))
                                          / 8640000000) AS INTEGER) AS bucket,
             {round_dec('avg(max_arrival_delay_sec)', 9)} AS a, count(*) AS n
      FROM trip_delay WHERE window_start >= TIMESTAMP '2024-01-30 00:00:00' AND window_start < {AS_OF}
      GROUP BY 1, 2, 3),
g AS (SELECT r.route_id, r.agency, CAST(i AS INTEGER) AS bucket
      FROM (SELECT DISTINCT route_id, agency FROM b) r, generate_series(0, 9) s(i))
SELECT g.route_id, g.agency, g.bucket,
       (SELECT arg_max(x.a, x.bucket) FROM b x
        WHERE x.route_id = g.route_id AND x.agency = g.agency AND x.bucket <= g.bucket) AS avg_delay_sec,
       coalesce(b.n, 0) AS trip_windows
FROM g LEFT JOIN b USING (route_id, agency, bucket)""",
        "active_vehicles_sketch": with_(ADAPTER) + f"""
SELECT CAST(m AS INTEGER) AS horizon_minutes,
       (SELECT count(DISTINCT vehicle_id) FROM vp WHERE event_ts >= {AS_OF} - to_minutes(m)) AS vehicles, true AS within
FROM (VALUES (60), (1440), (10080)) t(m)""",
        "delay_percentiles_sketch": with_(*BASE, stg_ctes(False)) + """
SELECT route_id, event_date, count(*) AS n, true AS p50_within, true AS p95_within
FROM stg GROUP BY route_id, event_date""",
    }
