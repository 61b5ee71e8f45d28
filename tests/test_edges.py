"""Hand-written edge rows: one test per boundary and semantic decision."""

import datetime as dt
import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from headway.functions.schemas import ENVELOPE, FEED_ENTITY
from headway.operators.aggregates import cascade_flags, route_speed_agg, trip_delay
from headway.operators.hotspots import hotspots_like
from headway.operators.ingest import normalize_trip_updates, normalize_vehicle_positions
from headway.operators.models import route_reliability, stg_trip_delay_events
from headway.operators.parse import explode_stop_updates, parse_trip_updates
from headway.operators.quality import check_quality
from headway.sinks.tables import incremental_filter, merge_rows, read_table, upsert_table

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def env(spark, values):
    rows = [(b"k", (v if isinstance(v, bytes) else json.dumps(v).encode()), "t", T0)
            for v in values]
    return spark.createDataFrame(rows, ENVELOPE)


def trip(ts="2024-01-01T10:00:00+00:00", stops=None, trip_id="T1", route="R1", agency="a"):
    return {"trip_id": trip_id, "route_id": route, "vehicle_id": "V1", "start_date": "",
            "stop_time_updates": stops, "timestamp": ts, "agency": agency}


def stop(delay, sid="S1"):
    return {"stop_id": sid, "stop_sequence": 1, "arrival_delay_sec": delay,
            "departure_delay_sec": delay, "schedule_relationship": "SCHEDULED"}


def test_malformed_json_and_bad_timestamp(spark):
    df = parse_trip_updates(env(spark, [b"not json", trip(ts="garbage", stops=[stop(5)]),
                                        trip(ts="2024-01-01T10:00:00.123456+00:00",
                                             stops=[stop(5)])]))
    rows = df.orderBy("trip_id").collect()
    assert rows[0].trip_id is None and rows[0].event_ts is None
    assert rows[1].event_ts is None
    assert rows[2].event_ts == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    # NULL event time never enters a window.
    assert trip_delay(explode_stop_updates(df)).count() == 5


def test_null_and_empty_stop_lists_vanish(spark):
    df = explode_stop_updates(parse_trip_updates(env(spark, [trip(stops=None),
                                                             trip(stops=[])])))
    assert df.count() == 0


def _windows(spark, delays, **kw):
    msgs = [trip(stops=[stop(d)], trip_id=f"T{i}", **kw) for i, d in enumerate(delays)]
    return trip_delay(explode_stop_updates(parse_trip_updates(env(spark, msgs))))


def test_severity_and_staging_boundaries(spark):
    delays = [0, 1, 59, 60, 179, 180, 299, 300, 7200, 7201, -120, -121]
    td = _windows(spark, delays).filter(F.col("window_start") == T0)
    sev = {r.max_arrival_delay_sec: r.delay_severity for r in td.collect()}
    assert sev[0] == "ON_TIME" and sev[1] == "MINOR" and sev[179] == "MINOR"
    assert sev[180] == "MODERATE" and sev[299] == "MODERATE" and sev[300] == "SEVERE"
    assert sev[-121] == "ON_TIME"
    stg = {r.max_arrival_delay_sec: r for r in stg_trip_delay_events(td).collect()}
    assert set(stg) == {0, 1, 59, 60, 179, 180, 299, 300, 7200, -120}
    assert stg[60].is_moderate and stg[299].is_moderate and not stg[59].is_moderate
    assert not stg[300].is_moderate and stg[300].is_severe
    assert stg[0].is_on_time and not stg[1].is_on_time
    # 1..59 s is in no staging flag (kept from the reference).
    assert not (stg[1].is_severe or stg[1].is_moderate or stg[1].is_on_time)


def test_all_null_delays_are_on_time_and_rejected(spark):
    td = _windows(spark, [None])
    assert {r.delay_severity for r in td.collect()} == {"ON_TIME"}
    assert stg_trip_delay_events(td).count() == 0


def test_cascade_share_exact_and_cap(spark):
    td = _windows(spark, [200] * 7 + [0] * 13).filter(F.col("window_start") == T0)
    r = cascade_flags(td).first()
    assert (r.total_trips, r.delayed_trips, r.is_cascade, r.cascade_score) == (20, 7, True, 70)
    td = _windows(spark, [200] * 20).filter(F.col("window_start") == T0)
    assert cascade_flags(td).first().cascade_score == 100


def test_window_edge_and_five_windows(spark):
    td = _windows(spark, [10])
    starts = sorted(r.window_start for r in td.collect())
    assert len(starts) == 5 and starts[-1] == T0


def test_same_route_two_agencies(spark):
    a = [trip(stops=[stop(200)], trip_id="T1", agency="a")]
    b = [trip(stops=[stop(0)], trip_id="T2", agency="b")]
    td = trip_delay(explode_stop_updates(parse_trip_updates(env(spark, a + b))))
    flags = cascade_flags(td).filter(F.col("window_start") == T0)
    got = {r.agency: r.is_cascade for r in flags.collect()}
    assert got == {"a": True, "b": False}


def test_speed_single_reading_and_slow_boundary(spark):
    rows = [Row(route_id="R", agency="a", speed_mph=5.0, event_ts=T0),
            Row(route_id="S", agency="a", speed_mph=4.0, event_ts=T0),
            Row(route_id="S", agency="a", speed_mph=4.5, event_ts=T0)]
    out = route_speed_agg(spark.createDataFrame(rows)).filter(F.col("window_start") == T0)
    got = {r.route_id: r for r in out.collect()}
    assert got["R"].speed_stddev is None and got["R"].is_slow_route is False
    assert got["S"].is_slow_route is True and got["S"].vehicle_count == 2


def test_rush_hours(spark):
    hours = [7, 9, 10, 15, 16, 19, 20]
    rows = [Row(trip_id="T", route_id="R", vehicle_id="V", agency="a",
                window_start=dt.datetime(2024, 1, 1, h), max_arrival_delay_sec=0,
                avg_arrival_delay_sec=0.0, stops_reporting=1, delay_severity="ON_TIME")
            for h in hours]
    stg = stg_trip_delay_events(spark.createDataFrame(rows))
    got = [r.is_rush_hour for r in stg.orderBy("hour_of_day").collect()]
    assert got == [True, True, False, False, True, True, False]


def _hourly_rows(days, trips=10, on_time=10, route="R", agency="a"):
    return [Row(route_id=route, agency=agency, event_date=d, hour_of_day=8, is_rush_hour=True,
                total_trips=trips, severe_trips=0, moderate_trips=0, on_time_trips=on_time,
                avg_delay_sec=0.0, p50_delay_sec=0.0, p95_delay_sec=0.0, max_delay_sec=0,
                had_cascade=1 if d.day == 1 else 0, max_cascade_score=0, cascade_count=0,
                severe_pct=0.0, on_time_pct=1.0) for d in days]


def test_missing_day_stretches_row_frame_not_range_frame(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 4, 5, 6, 8, 9)]
    h = spark.createDataFrame(_hourly_rows(days))
    rows_f = {r.event_date: r for r in route_reliability(h).collect()}
    range_f = {r.event_date: r for r in route_reliability(h, frame="range").collect()}
    # On Jan 8, 7 rows reach back to Jan 1 (8 days); 7 calendar days do not.
    assert rows_f[dt.date(2024, 1, 8)].rolling_7d_cascade_count == 1
    assert range_f[dt.date(2024, 1, 8)].rolling_7d_cascade_count == 0


def test_zero_trips_score(spark):
    h = spark.createDataFrame(_hourly_rows([dt.date(2024, 1, 1)], trips=0, on_time=0))
    assert route_reliability(h).first().reliability_score == 100.0
    assert route_reliability(h, null_score="propagate").first().reliability_score is None


def test_like_wildcards_and_min_events(spark):
    def stg(trip_id, n):
        return [Row(trip_id=trip_id, event_date=dt.date(2024, 1, 30),
                    max_arrival_delay_sec=60, is_severe=False)] * n
    trips = spark.createDataFrame(stg("TXAB", 5) + stg("QQ", 4) + stg("ZZZ", 5))
    stops = spark.createDataFrame([
        Row(stop_id="X_B", stop_name="w", latitude=0.0, longitude=0.0, route_id="R"),
        Row(stop_id="QQ", stop_name="q", latitude=0.0, longitude=0.0, route_id="R"),
        Row(stop_id="%", stop_name="all", latitude=0.0, longitude=0.0, route_id="R"),
        Row(stop_id="____", stop_name="len4", latitude=0.0, longitude=0.0, route_id="R"),
    ])
    out = {r.stop_id: r.delay_events
           for r in hotspots_like(trips, stops, dt.datetime(2024, 1, 31)).collect()}
    # '_' is a one-character wildcard; 4 events are below the minimum.
    assert out == {"X_B": 5, "%": 14, "____": 5}


def test_merge_replay_and_incremental(spark, tmp_dir):
    keys = ["k"]
    old = spark.createDataFrame([Row(k=1, v="a", event_date=dt.date(2024, 1, 1)),
                                 Row(k=2, v="b", event_date=dt.date(2024, 1, 2))])
    upd = spark.createDataFrame([Row(k=2, v="B", event_date=dt.date(2024, 1, 2)),
                                 Row(k=3, v="c", event_date=dt.date(2024, 1, 2))])
    merged = {r.k: r.v for r in merge_rows(old, upd, keys).collect()}
    assert merged == {1: "a", 2: "B", 3: "c"}
    path = f"{tmp_dir}/tbl"
    grain = ["k", "event_date"]  # the partition column is part of the key
    upsert_table(spark, path, old, grain)
    upsert_table(spark, path, upd, grain)
    first = sorted(read_table(spark, path).collect())
    upsert_table(spark, path, upd, grain)
    assert sorted(read_table(spark, path).collect()) == first
    assert {r.k: r.v for r in first} == merged
    # Incremental: empty target loads all; a late row of a loaded window is
    # lost with the plain high-water mark and kept with a lookback.
    src = spark.createDataFrame([Row(window_start=dt.datetime(2024, 1, 1, 10)),
                                 Row(window_start=dt.datetime(2024, 1, 1, 11))])
    empty = src.limit(0)
    assert incremental_filter(src, empty, date_col=None).count() == 2
    tgt = src.filter("window_start = '2024-01-01 11:00:00'")
    assert incremental_filter(src, tgt, date_col=None).count() == 0
    assert incremental_filter(src, tgt, lookback="2 hours", date_col=None).count() == 2


def test_feed_normalisation(spark):
    ents = [
        {"id": "E1", "vehicle": {"vehicle": {"id": ""}, "position": {"speed": 0.0},
                                 "timestamp": 0}},
        {"id": "E2", "vehicle": {"vehicle": {"id": "V2"}, "position": {}, "timestamp": 60}},
        {"id": "E3", "vehicle": {"vehicle": {"id": "V3"}, "position": {"speed": 1.23},
                                 "timestamp": 60}},
        {"id": "E4", "trip_update": {"trip": {"trip_id": "T4"},
                                     "stop_time_update": [{"stop_id": "S", "arrival": {}}],
                                     "timestamp": 60}},
    ]
    df = spark.read.schema(FEED_ENTITY).json(spark.sparkContext.parallelize(
        [json.dumps(e) for e in ents]))
    vp = {r.vehicle_id: r for r in normalize_vehicle_positions(df, "a").collect()}
    assert set(vp) == {"E1", "V2", "V3"}
    assert vp["E1"].speed_mph == 0.0 and vp["V2"].speed_mph == 0.0
    assert vp["V3"].speed_mph == 2.75
    assert vp["V2"].timestamp == "1970-01-01T00:01:00+00:00"
    tu = normalize_trip_updates(df, "a").first()
    assert tu.vehicle_id == "UNKNOWN"
    s = tu.stop_time_updates[0]
    assert (s.arrival_delay_sec, s.departure_delay_sec, s.schedule_relationship) == (
        0, 0, "SCHEDULED")


def test_quality_on_empty_table(spark):
    df = spark.createDataFrame([], "window_start timestamp, route_id string, "
                                   "max_arrival_delay_sec int")
    rep = {r.check_name: r for r in check_quality(df, "trip_delay_events").collect()}
    assert rep["max_null_pct_route_id"].observed == 0.0
    assert rep["max_null_pct_route_id"].passed
    assert not rep["min_rows_per_hour"].passed
    assert rep["max_delay_sec"].passed


@pytest.mark.parametrize("bad", [7201, 99999])
def test_quality_bound_is_evaluated(spark, bad):
    df = spark.createDataFrame([Row(window_start=T0, route_id="R", max_arrival_delay_sec=bad)])
    rep = {r.check_name: r for r in check_quality(df, "trip_delay_events").collect()}
    assert rep["max_delay_sec"].observed == 1.0 and not rep["max_delay_sec"].passed


def test_empty_ids_relationships_and_dedupe(spark):
    from headway.operators.aggregates import dedupe_events

    msgs = [trip(stops=[stop(10), dict(stop(500, "S2"), schedule_relationship="SKIPPED")],
                 trip_id=""),
            trip(stops=[stop(10)], trip_id="T9")]
    parsed = parse_trip_updates(env(spark, msgs + msgs))
    # '' passes the NULL check unless empty_as_null is set.
    td = trip_delay(explode_stop_updates(parsed))
    assert stg_trip_delay_events(td).filter("trip_id = ''").count() > 0
    assert stg_trip_delay_events(td, empty_as_null=True).filter("trip_id = ''").count() == 0
    # relationships filter drops the SKIPPED stop before aggregation.
    only = trip_delay(explode_stop_updates(parsed, ["SCHEDULED"]))
    assert only.agg(F.max("max_arrival_delay_sec")).first()[0] == 10
    assert td.agg(F.max("max_arrival_delay_sec")).first()[0] == 500
    # Re-polled duplicates: counted by default, dropped with dedupe.
    once = dedupe_events(parsed, ["trip_id", "agency", "timestamp"])
    assert parsed.count() == 4 and once.count() == 2


def test_dead_letters(spark):
    from headway.operators.parse import dead_letters

    raw = env(spark, [b"not json", trip(ts="garbage", stops=[stop(5)]),
                      trip(ts=None, stops=[stop(5)]), trip(stops=[stop(5)])])
    got = sorted(r.reason for r in dead_letters(raw).collect())
    assert got == ["bad_timestamp", "no_timestamp", "not_json"]


def test_quality_unknown_rule_and_kpi_approx(spark):
    from headway.operators.dashboard import kpi_summary

    df = spark.createDataFrame([Row(window_start=T0, route_id="R", max_arrival_delay_sec=5)])
    with pytest.raises(ValueError):
        check_quality(df, "trip_delay_events", {"no_such_rule": 1})
    v = spark.createDataFrame([Row(vehicle_id=f"V{i % 7}", event_ts=T0) for i in range(50)])
    td = spark.createDataFrame([Row(window_start=T0, delay_severity="ON_TIME",
                                    max_arrival_delay_sec=0)])
    st = spark.createDataFrame([Row(is_cascade=True), Row(is_cascade=False)])
    tr = spark.createDataFrame([Row(event_ts=T0)] * 30)
    out = {r.metric: r.value for r in kpi_summary(v, td, st, tr, as_of=T0, minutes=15,
                                                 approx_vehicles=True).collect()}
    assert out["active_vehicles"] == 7.0 and out["routes_in_cascade"] == 1.0
    assert out["events_per_min"] == 2.0 and out["on_time_rate"] == 1.0
