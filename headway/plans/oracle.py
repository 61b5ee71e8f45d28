"""DuckDB SQL twins of the registered queries (independent parity oracle).

Written straight from the semantics (not generated from the Spark plans).
Parity rules between the engines: DuckDB ``dayofweek`` is 0 = Sunday
(add 1); ``ln`` is the natural log; integer sums are cast to BIGINT;
double -> int casts truncate first; ``ROUND_DEC`` mirrors ``round_dec``.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def pad(x: str, width: int) -> str:
    """Zero-pad to at least ``width`` (lpad alone truncates longer ids)."""
    return (f"CASE WHEN length(CAST({x} AS VARCHAR)) >= {width} THEN CAST({x} AS VARCHAR) "
            f"ELSE lpad(CAST({x} AS VARCHAR), {width}, '0') END")


def round_dec(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def safe_ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / CAST(NULLIF({den}, 0) AS DOUBLE))"


def severity(x: str) -> str:
    return (f"CASE WHEN {x} >= 300 THEN 'SEVERE' WHEN {x} >= 180 THEN 'MODERATE' "
            f"WHEN {x} > 0 THEN 'MINOR' ELSE 'ON_TIME' END")


def rush(h: str) -> str:
    return f"(({h}) BETWEEN 7 AND 9 OR ({h}) BETWEEN 16 AND 19)"


# ---------------------------------------------------------------------------
# Adapter: events / supplier -> transit rows (see headway.sources.testdata).
# ---------------------------------------------------------------------------
ADAPTER = """
ev AS (
    SELECT event_id, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           date_trunc('second', CAST(ts AS TIMESTAMP)) AS event_ts
    FROM events
),
tu AS (
    SELECT 'T' || {pad_uid} AS trip_id,
           event_type AS route_id,
           'V' || {pad_uid} AS vehicle_id,
           CASE WHEN user_id % 2 = 0 THEN 'wmata' ELSE 'mta' END AS agency,
           event_id, event_ts, k, value,
           greatest(CAST(floor(value * 3) AS INTEGER) - 200, -60) AS base,
           CASE WHEN k = 99 THEN 9000 WHEN k = 98 THEN -500 ELSE 0 END AS bump
    FROM ev
),
stu AS (
    SELECT trip_id, route_id, vehicle_id, agency, event_ts,
           {pad_ki} AS stop_id,
           CAST(base + 30 * (i - 1) + bump AS INTEGER) AS arrival_delay_sec,
           CAST(base + 30 * (i - 1) + bump + 30 AS INTEGER) AS departure_delay_sec,
           'SCHEDULED' AS schedule_relationship
    FROM (SELECT *, unnest(generate_series(1, k % 4)) AS i FROM tu WHERE k % 4 > 0)
),
vp AS (
    SELECT vehicle_id, trip_id, route_id,
           38.9 + k / 1000 AS latitude,
           -77.0 - k / 1000 AS longitude,
           k * 36 / 10 AS bearing,
           CASE WHEN value / 2.237 <> 0 THEN round(value / 2.237 * 2.237, 2) ELSE 0.0 END
               AS speed_mph,
           {pad_k} AS current_stop,
           CAST(k % 40 + 1 AS INTEGER) AS stop_sequence,
           strftime(event_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS timestamp,
           agency, event_ts
    FROM tu
),
stops AS (
    SELECT {pad_s} AS stop_id,
           s_name AS stop_name,
           38.9 + s_nationkey / 100 AS latitude,
           -77.0 - s_nationkey / 100 AS longitude,
           (['click', 'error', 'purchase', 'signup', 'view'])[s_nationkey % 5 + 1] AS route_id
    FROM supplier
)"""
ADAPTER = (ADAPTER.replace("{pad_uid}", pad("user_id", 4))
           .replace("{pad_ki}", pad("k + i", 3))
           .replace("{pad_k}", pad("k", 3))
           .replace("{pad_s}", pad("s_suppkey", 3)))


def sliding(src: str, cols: str, size_min: int, slide_min: int) -> str:
    """Rows of ``src`` repeated once per sliding window that holds them."""
    n = size_min // slide_min
    return f"""
    SELECT time_bucket(INTERVAL '{slide_min} minutes', event_ts, TIMESTAMP '1970-01-01')
               - j * INTERVAL '{slide_min} minutes' AS window_start,
           {cols}
    FROM {src}, range(0, {n}) AS r(j)"""


def cascade_sql(size_min: int, slide_min: int) -> str:
    return with_(ADAPTER, trip_delay_cte(size_min, slide_min), CASCADE_CTE) + \
        "\nSELECT * FROM cascade"


def trip_delay_cte(size_min: int = 10, slide_min: int = 2) -> str:
    return f"""
tw AS ({sliding('stu', 'trip_id, route_id, vehicle_id, agency, stop_id, arrival_delay_sec',
                size_min, slide_min)}
),
trip_delay AS (
    SELECT trip_id, route_id, vehicle_id, agency,
           max(arrival_delay_sec) AS max_arrival_delay_sec,
           avg(arrival_delay_sec) AS avg_arrival_delay_sec,
           count(stop_id) AS stops_reporting,
           {severity('max(arrival_delay_sec)')} AS delay_severity,
           window_start
    FROM tw
    GROUP BY window_start, trip_id, route_id, vehicle_id, agency
)"""


CASCADE_CTE = """
cascade AS (
    SELECT window_start, route_id, agency, total_trips, delayed_trips, delayed_pct,
           delayed_pct >= 0.35 AS is_cascade,
           CAST(trunc(least(100.0, delayed_pct * 100 * (total_trips / 10))) AS INTEGER)
               AS cascade_score
    FROM (
        SELECT window_start, route_id, agency,
               count(*) AS total_trips,
               CAST(sum(CASE WHEN max_arrival_delay_sec >= 180 THEN 1 ELSE 0 END) AS BIGINT)
                   AS delayed_trips,
               CAST(sum(CASE WHEN max_arrival_delay_sec >= 180 THEN 1 ELSE 0 END) AS DOUBLE)
                   / count(*) AS delayed_pct
        FROM trip_delay
        GROUP BY window_start, route_id, agency
    )
)"""


def stg_ctes(with_flags: bool = True) -> str:
    text = stg_trip_cte()
    return text + STGC if with_flags else text


def stg_trip_cte() -> str:
    mx = "max_arrival_delay_sec"
    return f"""
stg AS (
    SELECT trip_id, route_id, vehicle_id, agency,
           CAST(window_start AS TIMESTAMP) AS window_start,
           CAST({mx} AS INTEGER) AS {mx},
           CAST(avg_arrival_delay_sec AS DOUBLE) AS avg_arrival_delay_sec,
           CAST(stops_reporting AS INTEGER) AS stops_reporting,
           upper(trim(delay_severity)) AS delay_severity,
           {mx} >= 300 AS is_severe,
           {mx} BETWEEN 60 AND 299 AS is_moderate,
           {mx} <= 0 AS is_on_time,
           CAST(window_start AS DATE) AS event_date,
           CAST(hour(window_start) AS INTEGER) AS hour_of_day,
           CAST(dayofweek(window_start) + 1 AS INTEGER) AS day_of_week,
           {rush('hour(window_start)')} AS is_rush_hour
    FROM trip_delay
    WHERE trip_id IS NOT NULL AND route_id IS NOT NULL AND window_start IS NOT NULL
      AND {mx} BETWEEN -120 AND 7200
)"""


STGC = f""",
stgc AS (
    SELECT route_id, agency, CAST(window_start AS TIMESTAMP) AS window_start,
           CAST(total_trips AS INTEGER) AS total_trips,
           CAST(delayed_trips AS INTEGER) AS delayed_trips,
           {round_dec('CAST(delayed_pct AS DOUBLE)', 4)} AS delayed_pct,
           CAST(is_cascade AS BOOLEAN) AS is_cascade,
           CAST(cascade_score AS INTEGER) AS cascade_score,
           CAST(window_start AS DATE) AS event_date
    FROM cascade
)"""


def hourly_cte(by_agency: bool = False) -> str:
    """One sorted list of delays per route, agency and hour; every measure is read
    off the list, and the cascades of the hour are looked up per row."""
    same = "c.route_id = h.route_id AND date_trunc('hour', c.window_start) = h.hour_start"
    if by_agency:
        same += " AND c.agency = h.agency"
    hour = "date_part('hour', hour_start)"
    return f"""
per_hour AS (
    SELECT route_id, agency, date_trunc('hour', window_start) AS hour_start,
           list({'CAST(max_arrival_delay_sec AS BIGINT)'} ORDER BY max_arrival_delay_sec) AS v,
           count(DISTINCT trip_id) AS distinct_trips
    FROM stg GROUP BY ALL
),
hourly AS (
    SELECT route_id, agency, CAST(hour_start AS DATE) AS event_date, CAST({hour} AS INTEGER) AS hour_of_day,
           {hour} IN (7, 8, 9, 16, 17, 18, 19) AS is_rush_hour,
           len(v) AS total_trips,
           len(list_filter(v, lambda x: x >= 300)) AS severe_trips,
           len(list_filter(v, lambda x: x >= 60 AND x < 300)) AS moderate_trips,
           len(list_filter(v, lambda x: x <= 0)) AS on_time_trips,
           CAST(list_sum(v) AS DOUBLE) / len(v) AS avg_delay_sec,
           {quantile('v', 0.5)} AS p50_delay_sec, {quantile('v', 0.95)} AS p95_delay_sec,
           CAST(v[-1] AS INTEGER) AS max_delay_sec,{'distinct_trips,' if by_agency else ''}
           (SELECT CAST(count(*) FILTER (is_cascade) > 0 AS INTEGER) FROM cascade c WHERE {same}) AS had_cascade,
           coalesce((SELECT max(cascade_score) FROM cascade c WHERE {same}), 0) AS max_cascade_score,
           (SELECT count(*) FILTER (is_cascade) FROM cascade c WHERE {same}) AS cascade_count,
           {round_dec('len(list_filter(v, lambda x: x >= 300)) / CAST(len(v) AS DOUBLE)', 4)} AS severe_pct,
           {round_dec('len(list_filter(v, lambda x: x <= 0)) / CAST(len(v) AS DOUBLE)', 4)} AS on_time_pct
    FROM per_hour h
)"""


def mart_cte(calendar: bool = False) -> str:
    """Days as lists of their hours; the rolling week as a self-join: of the
    seven latest rows of the route, or (``calendar``) of the seven latest dates
    of the route and agency."""
    week = ("b.agency = a.agency AND date_diff('day', b.event_date, a.event_date) BETWEEN 0 AND 6"
            if calendar else "b.place BETWEEN a.place - 6 AND a.place")
    pct = "100 * CAST({} AS DOUBLE) / nullif({}, 0)"
    return f"""
days AS (
    SELECT route_id, agency, event_date, list(h) AS hs,
           row_number() OVER (PARTITION BY route_id ORDER BY event_date, agency) AS place
    FROM hourly h GROUP BY route_id, agency, event_date
),
daily AS (
    SELECT route_id, agency, event_date, place,
           CAST(list_sum(list_transform(hs, lambda h: h.total_trips)) AS BIGINT) AS daily_trips,
           CAST(list_sum(list_transform(hs, lambda h: h.on_time_trips)) AS BIGINT) AS daily_on_time,
           CAST(list_sum(list_transform(hs, lambda h: h.severe_trips)) AS BIGINT) AS daily_severe,
           list_sum(list_transform(hs, lambda h: h.avg_delay_sec)) / len(hs) AS daily_avg_delay_sec,
           list_max(list_transform(hs, lambda h: h.max_delay_sec)) AS daily_max_delay_sec,
           list_sort(list_transform(hs, lambda h: h.p95_delay_sec)) AS p95s,
           list_max(list_transform(hs, lambda h: h.had_cascade)) AS had_cascade_event,
           CAST(list_sum(list_transform(hs, lambda h: h.cascade_count)) AS BIGINT) AS total_cascade_windows,
           CAST(coalesce(list_sum(list_transform(list_filter(hs, lambda h: h.is_rush_hour), lambda h: h.severe_trips)), 0)
                AS BIGINT) AS rush_hour_severe,
           CAST(coalesce(list_sum(list_transform(list_filter(hs, lambda h: h.is_rush_hour), lambda h: h.total_trips)), 0)
                AS BIGINT) AS rush_hour_trips
    FROM days
),
shares AS (
    SELECT *, {round_dec(pct.format('daily_on_time', 'daily_trips'), 1)} AS on_time_pct,
           {round_dec(pct.format('daily_severe', 'daily_trips'), 1)} AS severe_pct,
           {round_dec(pct.format('rush_hour_severe', 'rush_hour_trips'), 1)} AS rush_hour_severe_pct,
           {quantile('p95s', 0.5)} AS typical_p95_delay_sec
    FROM daily
),
weeks AS (
    SELECT a.route_id, a.agency, a.event_date,
           {round_dec('sum(b.on_time_pct) / count(b.on_time_pct)', 1)} AS rolling_7d_on_time_pct,
           {round_dec('sum(b.daily_avg_delay_sec) / count(*)', 1)} AS rolling_7d_avg_delay_sec,
           CAST(sum(b.had_cascade_event) AS BIGINT) AS rolling_7d_cascade_count
    FROM shares a JOIN shares b ON b.route_id = a.route_id AND {week}
    GROUP BY ALL
),
scored AS (
    SELECT *, {round_dec('rolling_7d_on_time_pct - 5 * rolling_7d_cascade_count - rolling_7d_avg_delay_sec / 60', 1)}
               AS raw_score
    FROM shares JOIN weeks USING (route_id, agency, event_date)
),
mart AS (
    SELECT route_id, agency, event_date, daily_trips, daily_on_time, daily_severe, on_time_pct, severe_pct,
           daily_avg_delay_sec, daily_max_delay_sec, typical_p95_delay_sec, had_cascade_event,
           total_cascade_windows, rush_hour_severe, rush_hour_trips, rush_hour_severe_pct,
           rolling_7d_on_time_pct, rolling_7d_avg_delay_sec, rolling_7d_cascade_count,
           CASE WHEN raw_score < 0 THEN 0.0 WHEN raw_score > 100 OR raw_score IS NULL THEN 100.0
                ELSE raw_score END AS reliability_score
    FROM scored
)"""


def hotspot_select(events: str, match: str, delay: str) -> str:
    """Hotspots from the list of each stop's recent delays."""
    mean = "CAST(list_sum(v) AS DOUBLE) / len(v)"
    return f"""
    SELECT stop_id, stop_name, latitude, longitude, route_id, len(v) AS delay_events, {mean} AS avg_delay_sec,
           list_max(v) AS max_delay_sec, len(list_filter(v, lambda x: x >= 300)) AS severe_events,
           {round_dec(mean + ' / 60', 1)} AS avg_delay_min,
           {round_dec('ln(1 + len(v)) * (' + mean + ') / 60', 2)} AS hotspot_score
    FROM (SELECT s.*, (SELECT list(e.{delay}) FROM {events} e WHERE {match}) AS v
          FROM (SELECT DISTINCT * FROM stops) s)
    WHERE len(v) >= 5"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def q_trip_delay() -> str:
    return with_(ADAPTER, trip_delay_cte()) + "\nSELECT * FROM trip_delay"


def q_cascade_flags() -> str:
    return with_(ADAPTER, trip_delay_cte(), CASCADE_CTE) + "\nSELECT * FROM cascade"


BASE = (ADAPTER, trip_delay_cte(), CASCADE_CTE)

TRIP_ROWS = """,
trip_rows AS (
    SELECT t.trip_id, t.route_id, t.vehicle_id,
           strftime(t.event_ts, '%Y%m%d') AS start_date,
           COALESCE((SELECT list({'stop_id': s.stop_id, 'stop_sequence': CAST(s.i AS INTEGER),
                                  'arrival_delay_sec': s.a, 'departure_delay_sec': s.a + 30,
                                  'schedule_relationship': 'SCHEDULED'} ORDER BY s.i)
                     FROM (SELECT i, {pad_tki} AS stop_id,
                                  CAST(t.base + 30 * (i - 1) + t.bump AS INTEGER) AS a
                           FROM generate_series(1, t.k % 4) g(i)) s), []) AS stop_time_updates,
           strftime(t.event_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS timestamp,
           t.agency, t.event_ts
    FROM tu t
)"""
TRIP_ROWS = TRIP_ROWS.replace("{pad_tki}", pad("t.k + i", 3))


def staged_chain(sfx: str, where: str) -> str:
    """Adapter -> trip delay -> staging over a subset of events, with every
    CTE name suffixed so two chains can share one query."""
    text = ",".join([ADAPTER.replace("FROM events", f"FROM events WHERE {where}"),
                     trip_delay_cte(), stg_trip_cte()])
    for name in ("ev", "tu", "stu", "vp", "stops", "tw", "trip_delay", "stg"):
        text = re.sub(rf"\b{name}\b", f"{name}{sfx}", text)
    return text


SPEED_CTE = f"""
speed AS (
    SELECT route_id, agency, avg(speed_mph) AS avg_speed_mph, min(speed_mph) AS min_speed_mph,
           count(*) AS vehicle_count, stddev_samp(speed_mph) AS speed_stddev,
           avg(speed_mph) < 5.0 AS is_slow_route,
           window_start, window_start + INTERVAL '5 minutes' AS window_end
    FROM ({sliding('vp', 'route_id, agency, speed_mph', 5, 1)})
    GROUP BY window_start, route_id, agency
)"""

STATE_CTE = """
state AS (
    SELECT route_id, agency,
           arg_max(delayed_pct, window_start) AS delayed_pct,
           arg_max(is_cascade, window_start) AS is_cascade,
           arg_max(cascade_score, window_start) AS cascade_score,
           arg_max(total_trips, window_start) AS total_trips,
           arg_max(delayed_trips, window_start) AS delayed_trips,
           max(window_start) AS window_start
    FROM cascade
    GROUP BY route_id, agency
)"""

def quantile(values: str, p: float) -> str:
    """Linear interpolation between the order statistics of a sorted list."""
    pos = f"((len({values}) - 1) * {p})"
    return (f"({values}[CAST(floor({pos}) AS BIGINT) + 1] * (1 - ({pos} - floor({pos})))"
            f" + {values}[CAST(ceil({pos}) AS BIGINT) + 1] * ({pos} - floor({pos})))")


def profile_cte(name: str, where: str) -> str:
    return f"""
{name} AS (
    SELECT route_id, agency, day_of_week, hour_of_day, n, m AS avg_delay_sec,
           CASE WHEN n > 1 THEN sqrt(list_sum(list_transform(v, lambda x: (x - m) * (x - m))) / (n - 1)) END
               AS stddev_delay_sec,
           {quantile('v', 0.5)} AS p50_delay_sec, {quantile('v', 0.95)} AS p95_delay_sec,
           len(list_filter(v, lambda x: x >= 300)) / CAST(n AS DOUBLE) AS severe_share
    FROM (SELECT route_id, agency, day_of_week, hour_of_day, count(*) AS n,
                 sum(max_arrival_delay_sec) / CAST(count(*) AS DOUBLE) AS m,
                 list(CAST(max_arrival_delay_sec AS DOUBLE) ORDER BY max_arrival_delay_sec) AS v
          FROM stg WHERE {where} GROUP BY ALL)
)"""


PROFILE_CTE = profile_cte("profiles", f"window_start >= {AS_OF} - INTERVAL '84 days'")


def qrow(table: str, check: str, col: str, observed: str, thr: float, passed: str,
         src: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{col}' AS column_name, "
            f"CAST({observed} AS DOUBLE) AS observed, CAST({thr} AS DOUBLE) AS threshold, "
            f"CAST({observed} AS DOUBLE) {passed} AS passed FROM {src}")


def quality_sql() -> str:
    recent = f"count(*) FILTER (WHERE window_start >= {AS_OF} - INTERVAL '1 hour')"
    nulls = "count(*) FILTER (WHERE route_id IS NULL) / greatest(count(*), 1)"
    rows = [
        qrow("trip_delay_events", "min_rows_per_hour", "window_start", recent, 1000,
             ">= 1000.0", "trip_delay"),
        qrow("trip_delay_events", "max_null_pct_route_id", "route_id", nulls, 0.01,
             "<= 0.01", "trip_delay"),
        qrow("trip_delay_events", "max_delay_sec", "max_arrival_delay_sec",
             "count(*) FILTER (WHERE max_arrival_delay_sec > 7200)", 7200, "= 0", "trip_delay"),
        qrow("route_speed_agg", "min_rows_per_hour", "window_start", recent, 200,
             ">= 200.0", "speed"),
        qrow("route_speed_agg", "max_null_pct_route_id", "route_id", nulls, 0.0,
             "<= 0.0", "speed"),
        qrow("route_speed_agg", "min_speed_mph", "min_speed_mph",
             "count(*) FILTER (WHERE min_speed_mph < -1.0)", -1.0, "= 0", "speed"),
        qrow("cascade_flags", "min_rows_per_hour", "window_start", recent, 50,
             ">= 50.0", "cascade"),
        qrow("cascade_flags", "max_cascade_score", "cascade_score",
             "count(*) FILTER (WHERE cascade_score > 100)", 100, "= 0", "cascade"),
    ]
    return with_(*BASE, SPEED_CTE) + "\n" + "\nUNION ALL\n".join(rows)


def kpi_sql(minutes: int = 60) -> str:
    since = f"{AS_OF} - INTERVAL '{minutes} minutes'"
    return with_(*BASE, STATE_CTE) + f"""
SELECT 'active_vehicles' AS metric, CAST(count(DISTINCT vehicle_id) AS DOUBLE) AS value
FROM vp WHERE event_ts >= {since}
UNION ALL
SELECT 'on_time_rate', {round_dec("avg(CASE WHEN delay_severity = 'ON_TIME' THEN 1.0 ELSE 0.0 END)", 9)}
FROM trip_delay WHERE window_start >= {since}
UNION ALL
SELECT 'avg_delay_min', {round_dec('avg(max_arrival_delay_sec) / 60', 9)}
FROM trip_delay WHERE window_start >= {since}
UNION ALL
SELECT 'routes_in_cascade', CAST(count(*) FILTER (WHERE is_cascade) AS DOUBLE) FROM state
UNION ALL
SELECT 'events_per_min', {round_dec(f'count(*) / {float(minutes)}', 9)}
FROM tu WHERE event_ts >= {since}"""


def r9(c: str) -> str:
    return f"{round_dec(c, 9)} AS {c}"


def all_sql() -> dict[str, str]:
    stg_full = with_(*BASE, stg_ctes())
    hourly = with_(*BASE, stg_ctes(), hourly_cte())
    mart = with_(*BASE, stg_ctes(), hourly_cte(), mart_cte())
    recent = "DATE '2024-01-31' - 7"
    return {
        "trip_delay": q_trip_delay(),
        "cascade_flags": q_cascade_flags(),
        "stg_trip_delay_events": stg_full + "\nSELECT * FROM stg",
        "stg_cascade_flags": stg_full + "\nSELECT * FROM stgc",
        "route_delay_hourly": hourly + f"""
SELECT * EXCLUDE (avg_delay_sec, p50_delay_sec, p95_delay_sec),
       {r9('avg_delay_sec')}, {r9('p50_delay_sec')}, {r9('p95_delay_sec')}
FROM hourly""",
        "route_reliability": mart + f"""
SELECT * EXCLUDE (daily_avg_delay_sec, typical_p95_delay_sec), {r9('daily_avg_delay_sec')},
       {r9('typical_p95_delay_sec')}
FROM mart""",
        "feed_vehicle_positions": with_(ADAPTER) + f"""
SELECT * EXCLUDE (event_ts) FROM vp""",
        "vehicle_positions": with_(ADAPTER) + f"""
SELECT *, event_ts AS kafka_ts FROM vp""",
        "feed_trip_updates": with_(ADAPTER) + TRIP_ROWS + """
SELECT trip_id, route_id, vehicle_id, start_date, to_json(stop_time_updates) AS stop_time_updates,
       timestamp, agency
FROM trip_rows""",
        "trip_topic_messages": with_(ADAPTER) + TRIP_ROWS + """
SELECT agency || ':' || trip_id AS key,
       to_json({'trip_id': trip_id, 'route_id': route_id, 'vehicle_id': vehicle_id,
                'start_date': start_date, 'stop_time_updates': stop_time_updates,
                'timestamp': timestamp, 'agency': agency}) AS value,
       'gtfs.trip_updates' AS topic,
       event_ts AS timestamp
FROM trip_rows""",
        "stop_updates": with_(ADAPTER) + "\nSELECT * FROM stu",
        "ingest_counts": with_(ADAPTER) + """
SELECT topic, agency, CAST(count(*) AS BIGINT) AS published
FROM (SELECT agency FROM tu), (VALUES ('gtfs.vehicle_positions'), ('gtfs.trip_updates')) t(topic)
GROUP BY topic, agency""",
        "route_speed_agg": with_(ADAPTER) + f"""
SELECT route_id, agency,
       {round_dec('avg(speed_mph)', 9)} AS avg_speed_mph,
       min(speed_mph) AS min_speed_mph,
       count(*) AS vehicle_count,
       {round_dec('stddev_samp(speed_mph)', 9)} AS speed_stddev,
       avg(speed_mph) < 5.0 AS is_slow_route,
       window_start, window_start + INTERVAL '5 minutes' AS window_end
FROM ({sliding('vp', 'route_id, agency, speed_mph', 5, 1)})
GROUP BY window_start, route_id, agency""",
        "latest_route_state": with_(*BASE) + """
SELECT route_id, agency,
       arg_max(delayed_pct, window_start) AS delayed_pct,
       arg_max(is_cascade, window_start) AS is_cascade,
       arg_max(cascade_score, window_start) AS cascade_score,
       arg_max(total_trips, window_start) AS total_trips,
       arg_max(delayed_trips, window_start) AS delayed_trips,
       max(window_start) AS window_start
FROM cascade
GROUP BY route_id, agency""",
        "route_delay_hourly_by_agency": with_(*BASE, stg_ctes(), hourly_cte(by_agency=True)) + f"""
SELECT * EXCLUDE (avg_delay_sec, p50_delay_sec, p95_delay_sec),
       {r9('avg_delay_sec')}, {r9('p50_delay_sec')}, {r9('p95_delay_sec')}
FROM hourly""",
        "route_reliability_by_agency_range": with_(
            *BASE, stg_ctes(), hourly_cte(by_agency=True), mart_cte(calendar=True)) + f"""
SELECT * EXCLUDE (daily_avg_delay_sec, typical_p95_delay_sec, reliability_score),
       {r9('daily_avg_delay_sec')}, {r9('typical_p95_delay_sec')},
       CASE WHEN rolling_7d_on_time_pct IS NULL OR rolling_7d_cascade_count IS NULL
                 OR rolling_7d_avg_delay_sec IS NULL THEN NULL ELSE reliability_score END
           AS reliability_score
FROM mart""",
        "cascade_flags_wide": cascade_sql(600, 120),
        "cascade_flags_stream": with_(*BASE) + """
SELECT * FROM cascade
WHERE window_start + INTERVAL '10 minutes'
      <= (SELECT max(event_ts) FROM stu) - INTERVAL '5 minutes'""",
        "incremental_filter": stg_full + """
SELECT * FROM stg
WHERE window_start > (SELECT max(window_start) FROM stg
                      WHERE window_start < TIMESTAMP '2024-01-16')""",
        "incremental_filter_lookback": stg_full + """
SELECT * FROM stg
WHERE window_start >= (SELECT max(window_start) FROM stg
                       WHERE window_start < TIMESTAMP '2024-01-16') - INTERVAL '2 hours'""",
        "merge_upsert": "WITH " + staged_chain("_a", "ts < TIMESTAMP '2024-01-20'") + ","
        + staged_chain("_b", "ts >= TIMESTAMP '2024-01-19'") + """
SELECT * FROM stg_a a
WHERE NOT EXISTS (SELECT 1 FROM stg_b b
                  WHERE a.trip_id = b.trip_id AND a.route_id = b.route_id
                    AND a.vehicle_id IS NOT DISTINCT FROM b.vehicle_id
                    AND a.agency IS NOT DISTINCT FROM b.agency
                    AND a.window_start = b.window_start)
UNION ALL
SELECT * FROM stg_b""",
        "quality_report": quality_sql(),
        "freshness": with_(*BASE) + f"""
SELECT max(window_start) AS last_write,
       (epoch_us({AS_OF}) - epoch_us(max(window_start))) / 3.6e9 AS lag_hours,
       COALESCE((epoch_us({AS_OF}) - epoch_us(max(window_start))) / 3.6e9 < 2.0, false)
           AS passed
FROM trip_delay""",
        "kpi_summary": kpi_sql(60),
        "delay_distribution": with_(*BASE) + """
SELECT time_bucket(INTERVAL '1 minute', window_start, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '1 minute', window_start, TIMESTAMP '1970-01-01')
           + INTERVAL '1 minute' AS window_end,
       count(*) FILTER (WHERE delay_severity = 'SEVERE') AS "SEVERE",
       count(*) FILTER (WHERE delay_severity = 'MODERATE') AS "MODERATE",
       count(*) FILTER (WHERE delay_severity = 'MINOR') AS "MINOR",
       count(*) FILTER (WHERE delay_severity = 'ON_TIME') AS "ON_TIME"
FROM trip_delay
GROUP BY 1, 2""",
        "active_cascades": with_(*BASE, STATE_CTE) + f"""
SELECT s.route_id, s.agency, s.window_start, s.cascade_score,
       {round_dec('d.a / 60', 1)} AS avg_delay_min,
       {round_dec('s.delayed_pct * 100', 1)} AS pct_affected,
       CASE WHEN s.cascade_score > 60 THEN 'high' ELSE 'moderate' END AS alert_level
FROM state s
LEFT JOIN (SELECT route_id, agency, window_start, avg(max_arrival_delay_sec) AS a
           FROM trip_delay GROUP BY 1, 2, 3) d
  ON s.route_id = d.route_id AND s.agency = d.agency AND s.window_start = d.window_start
WHERE s.is_cascade""",
        "route_status": with_(*BASE) + f"""
SELECT route_id, agency, trip_windows, on_time_pct, avg_delay_min,
       CASE WHEN avg_delay_min > 6 THEN 'SEVERE' WHEN avg_delay_min > 3 THEN 'MODERATE'
            WHEN avg_delay_min > 1 THEN 'MINOR' ELSE 'ON_TIME' END AS display_severity,
       CASE WHEN on_time_pct > 80 THEN 'good' WHEN on_time_pct > 60 THEN 'warn'
            ELSE 'bad' END AS band
FROM (
    SELECT route_id, agency, count(*) AS trip_windows,
           {round_dec("avg(CASE WHEN delay_severity = 'ON_TIME' THEN 1.0 ELSE 0.0 END) * 100", 1)}
               AS on_time_pct,
           {round_dec('avg(max_arrival_delay_sec) / 60', 1)} AS avg_delay_min
    FROM trip_delay GROUP BY route_id, agency
)""",
        "route_trend": with_(*BASE) + f"""
SELECT route_id, agency,
       CAST(floor((epoch_us(window_start) - epoch_us(TIMESTAMP '2024-01-30 00:00:00'))
                  / 8640000000) AS INTEGER) AS bucket,
       {round_dec('avg(max_arrival_delay_sec)', 9)} AS avg_delay_sec,
       count(*) AS trip_windows
FROM trip_delay
WHERE window_start >= TIMESTAMP '2024-01-30 00:00:00' AND window_start < {AS_OF}
GROUP BY 1, 2, 3""",
        "reliability_latest": mart + """
SELECT route_id, agency, event_date, reliability_score, rolling_7d_on_time_pct,
       CASE WHEN reliability_score > 75 THEN 'good' WHEN reliability_score > 55 THEN 'fair'
            ELSE 'poor' END AS band
FROM (SELECT *, row_number() OVER (PARTITION BY route_id, agency ORDER BY event_date DESC) AS rn
      FROM mart)
WHERE rn = 1""",
        "ingest_throughput": with_(ADAPTER) + """
SELECT window_start, topic, messages,
       CAST(sum(messages) OVER (PARTITION BY topic ORDER BY window_start
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
           AS total_messages
FROM (
    SELECT time_bucket(INTERVAL '1 hour', event_ts, TIMESTAMP '1970-01-01') AS window_start,
           topic, count(*) AS messages
    FROM tu, (VALUES ('gtfs.vehicle_positions'), ('gtfs.trip_updates')) t(topic)
    GROUP BY 1, 2
)""",
        "route_profiles": with_(*BASE, stg_ctes(False), PROFILE_CTE) + f"""
SELECT route_id, agency, day_of_week, hour_of_day, n,
       {r9('avg_delay_sec')}, {r9('stddev_delay_sec')}, {r9('p50_delay_sec')},
       {r9('p95_delay_sec')}, {r9('severe_share')}
FROM profiles""",
        "cascade_features": with_(*BASE, stg_ctes(False), PROFILE_CTE) + f"""
SELECT t.*,
       CAST(hour(t.window_start) AS INTEGER) AS hour_of_day,
       {rush('hour(t.window_start)')} AS is_rush_hour,
       t.max_arrival_delay_sec / 3600.0 AS delay_norm,
       CAST(dayofweek(t.window_start) + 1 AS INTEGER) AS day_of_week,
       {round_dec('p.avg_delay_sec', 9)} AS profile_avg_delay_sec,
       {round_dec('p.p95_delay_sec', 9)} AS profile_p95_delay_sec,
       c.total_trips AS route_load
FROM trip_delay t
LEFT JOIN profiles p
  ON t.route_id = p.route_id AND t.agency = p.agency
 AND CAST(dayofweek(t.window_start) + 1 AS INTEGER) = p.day_of_week
 AND CAST(hour(t.window_start) AS INTEGER) = p.hour_of_day
LEFT JOIN cascade c
  ON t.route_id = c.route_id AND t.agency = c.agency AND t.window_start = c.window_start""",
        "cascade_labels": with_(*BASE) + """
SELECT t.*, COALESCE(CAST(c.is_cascade AS DOUBLE), 0.0) AS label
FROM trip_delay t
LEFT JOIN cascade c
  ON t.route_id = c.route_id AND t.agency = c.agency
 AND t.window_start = c.window_start - INTERVAL '10 minutes'""",
        "route_speed_stream": with_(ADAPTER, SPEED_CTE) + f"""
SELECT * EXCLUDE (avg_speed_mph, speed_stddev), {r9('avg_speed_mph')}, {r9('speed_stddev')}
FROM speed WHERE window_end <= (SELECT max(event_ts) FROM vp) - INTERVAL '2 minutes'""",
        "upsert_table_state": with_(*BASE, STATE_CTE) + "\nSELECT * FROM state",
        "upsert_profiles": with_(*BASE, stg_ctes(False),
                                 profile_cte("old_p", "window_start >= " + AS_OF + " - INTERVAL '91 days' "
                                             "AND window_start < " + AS_OF + " - INTERVAL '7 days'"),
                                 profile_cte("new_p", "window_start >= " + AS_OF + " - INTERVAL '7 days'")) + f"""
SELECT route_id, agency, day_of_week, hour_of_day, n, {r9('avg_delay_sec')}, {r9('stddev_delay_sec')},
       {r9('p50_delay_sec')}, {r9('p95_delay_sec')}, {r9('severe_share')}
FROM (SELECT * FROM new_p
      UNION ALL
      SELECT * FROM old_p o WHERE NOT EXISTS (
          SELECT 1 FROM new_p w WHERE w.route_id IS NOT DISTINCT FROM o.route_id
             AND w.agency IS NOT DISTINCT FROM o.agency AND w.day_of_week = o.day_of_week
             AND w.hour_of_day = o.hour_of_day))""",
        "refresh_models": mart + f"""
SELECT * EXCLUDE (daily_avg_delay_sec, typical_p95_delay_sec), {r9('daily_avg_delay_sec')},
       {r9('typical_p95_delay_sec')}
FROM mart""",
        "table_freshness": with_(*BASE) + "\nSELECT count(*) AS rows, true AS passed FROM trip_delay",
        "score_metrics": with_(*BASE) + f""",
lab AS (
    SELECT t.max_arrival_delay_sec / 3600.0 AS score,
           EXISTS (SELECT 1 FROM cascade c WHERE c.route_id = t.route_id AND c.agency = t.agency AND c.is_cascade
                     AND c.window_start = t.window_start + INTERVAL '10 minutes') AS y
    FROM trip_delay t WHERE t.window_start >= {AS_OF} - INTERVAL '30 days'),
ranked AS (SELECT y, score, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM lab),
n AS (SELECT count(*) FILTER (y) AS p, count(*) FILTER (NOT y) AS q, sum(r) FILTER (y) AS s,
             count(*) FILTER (y AND score >= 0.05) AS tp, count(*) FILTER (NOT y AND score >= 0.05) AS fp,
             count(*) FILTER (y AND NOT score >= 0.05) AS fn FROM ranked),
m AS (SELECT CAST(s - p * (p + 1) / 2.0 AS DOUBLE) / nullif(CAST(p AS DOUBLE) * q, 0) AS auc_roc,
             tp / CAST(greatest(tp + fp, 1) AS DOUBLE) AS precision_at_50,
             tp / CAST(greatest(tp + fn, 1) AS DOUBLE) AS recall_at_50 FROM n)
SELECT *, coalesce(auc_roc >= 0.78, false) AS auc_ok, coalesce(precision_at_50 >= 0.7, false) AS precision_ok,
       coalesce(auc_roc >= 0.78 AND precision_at_50 >= 0.7, false) AS promote FROM m""",
        "hotspots_like": with_(*BASE, stg_ctes()) + hotspot_select(
            "stg", f"e.trip_id LIKE '%' || s.stop_id || '%' AND e.event_date >= {recent}",
            "max_arrival_delay_sec"),
        "hotspots_by_stop": with_(ADAPTER) + hotspot_select(
            "stu", f"e.stop_id = s.stop_id AND e.route_id = s.route_id AND CAST(e.event_ts AS DATE) >= {recent} "
            "AND e.arrival_delay_sec BETWEEN -120 AND 7200", "arrival_delay_sec"),
    }
