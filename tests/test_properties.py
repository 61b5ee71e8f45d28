"""Property checks on generated stop updates (hypothesis)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators.aggregates import cascade_flags, trip_delay
from headway.operators.models import route_delay_hourly, route_reliability, stg_cascade_flags, \
    stg_trip_delay_events

T0 = dt.datetime(2024, 1, 1, 6, 0, 0)

rows = st.lists(
    st.tuples(st.integers(0, 5), st.integers(0, 2), st.integers(0, 3000),
              st.integers(-300, 9000) | st.none()),
    min_size=1, max_size=60)


def _stops(spark, data):
    recs = [(f"T{t}", f"R{r}", f"V{t}", "a" if t % 2 else "b",
             T0 + dt.timedelta(seconds=s * 7), f"S{t}", d) for t, r, s, d in data]
    return spark.createDataFrame(
        recs, "trip_id string, route_id string, vehicle_id string, agency string, "
              "event_ts timestamp, stop_id string, arrival_delay_sec int")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows)
def test_window_and_cascade_invariants(spark, data):
    stops = _stops(spark, data)
    td = trip_delay(stops).cache()
    # Each stop update lands in exactly size/slide = 5 windows.
    assert td.agg(F.sum("stops_reporting")).first()[0] == 5 * len(data)
    # Severity classes partition the windows.
    assert td.filter(F.col("delay_severity").isin(
        "SEVERE", "MODERATE", "MINOR", "ON_TIME")).count() == td.count()
    flags = cascade_flags(td)
    bad = flags.filter((F.col("delayed_pct") < 0) | (F.col("delayed_pct") > 1)
                       | (F.col("cascade_score") < 0) | (F.col("cascade_score") > 100)
                       | (F.col("delayed_trips") > F.col("total_trips")))
    assert bad.count() == 0
    hourly = route_delay_hourly(stg_trip_delay_events(td), stg_cascade_flags(flags))
    rel = route_reliability(hourly)
    assert rel.filter((F.col("reliability_score") < 0)
                      | (F.col("reliability_score") > 100)).count() == 0
    td.unpersist()


def _like(text: str, pattern: str) -> bool:
    import re

    rx = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern)
    return re.fullmatch(rx, text, flags=re.S) is not None


ids = st.text(alphabet="AB1_%", min_size=0, max_size=5)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text(alphabet="AB1", min_size=1, max_size=6),
                          st.integers(-100, 900)), min_size=1, max_size=30),
       st.lists(ids, min_size=1, max_size=6, unique=True))
def test_like_hotspots_equal_brute_force(spark, trips, stop_ids):
    from headway.operators.hotspots import hotspots_like

    day = dt.date(2024, 1, 30)
    stg = spark.createDataFrame(
        [(t, day, d, d >= 300) for t, d in trips],
        "trip_id string, event_date date, max_arrival_delay_sec int, is_severe boolean")
    stops = spark.createDataFrame([(s, "n", 0.0, 0.0, "R") for s in stop_ids],
                                  "stop_id string, stop_name string, latitude double, "
                                  "longitude double, route_id string")
    got = {r.stop_id: (r.delay_events, r.max_delay_sec, r.severe_events)
           for r in hotspots_like(stg, stops, dt.datetime(2024, 1, 31), min_events=1).collect()}
    want = {}
    for s in stop_ids:
        hits = [d for t, d in trips if _like(t, "%" + s + "%")]
        if hits:
            want[s] = (len(hits), max(hits), sum(1 for d in hits if d >= 300))
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-120, 7200) | st.none()),
                min_size=1, max_size=80),
       st.floats(0.0, 1.0))
def test_histogram_percentile_equals_percentile(spark, data, p):
    from headway.operators.percentiles import from_histogram, histogram

    from headway.operators.percentiles import weighted_mean, weighted_stddev

    df = spark.createDataFrame(data, "g int, v int")
    want = {r.g: (r.x, r.m, r.s, r.n) for r in df.groupBy("g").agg(
        F.percentile("v", p).alias("x"), F.avg("v").alias("m"), F.stddev_samp("v").alias("s"),
        F.count(F.lit(1)).alias("n")).collect()}
    v = F.col("v")
    got = {r.g: (r.x, r.m, r.s, r.n) for r in from_histogram(
        histogram(df, ["g"], "v"), ["g"], "v", {"x": p},
        [weighted_mean(v).alias("m"), weighted_stddev(v).alias("s"), F.sum("_c").alias("n")]).collect()}
    assert want.keys() == got.keys()
    for g in want:
        assert want[g][0] == got[g][0] and want[g][1] == got[g][1] and want[g][3] == got[g][3]
        a, b = want[g][2], got[g][2]
        assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-6 * max(1, a))
