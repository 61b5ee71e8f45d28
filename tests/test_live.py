"""Stateful streaming operators, stream-stream joins, in-flight metrics, sketches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.operators import dashboard
from headway.operators.sketches import delay_sketches, quantile_estimates
from headway.streaming import joins, metrics, running
from headway.streaming.jobs import write_stream_table

NOW = {"availableNow": True}
STOP = "trip_id string, route_id string, vehicle_id string, agency string, event_ts timestamp, arrival_delay_sec int"


def at(minute: float) -> dt.datetime:
    return dt.datetime(2024, 1, 1, 8, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=minute)


def land(spark, path, rows, schema, part):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/part={part}")


def follow(spark, path, schema):
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def test_running_cascades_come_before_the_window_closes(spark, tmp_dir):
    src, out, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    left = []

    def run():
        stops = follow(spark, src, STOP).withWatermark("event_ts", "5 minutes")

        def sink(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        with running.rocksdb(spark):
            q = (running.running_cascades(stops).writeStream.outputMode("update").option("checkpointLocation", ck)
                 .foreachBatch(sink).trigger(**NOW).start())
        q.awaitTermination()
        left.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        return spark.read.parquet(out)

    land(spark, src, [("a", "r", "v", "x", at(0), 200), ("b", "r", "v", "x", at(1), 10), ("c", "r", "v", "x", at(1), None)],
         STOP, 0)
    first = run()
    # No watermark has passed the window, but its counts are out.
    got = first.where(F.col("window_start") == F.lit(at(0))).collect()
    assert [(r.total_trips, r.delayed_trips, r.is_final) for r in got] == [(3, 1, False)]
    # The same trip gets worse, another comes: restarted from the checkpoint.
    land(spark, src, [("b", "r", "v", "x", at(2), 500), ("b", "r", "v", "x", at(3), 20), ("d", "r", None, "x", at(3), 5)],
         STOP, 1)
    second = run().where(F.col("window_start") == F.lit(at(0))).orderBy("batch").collect()
    assert [(r.total_trips, r.delayed_trips) for r in second][-1] == (4, 2)
    # Three hours on, the old windows are final and their state is gone; a row for them is late.
    land(spark, src, [("e", "r", "v", "x", at(180), 0)], STOP, 2)
    run()
    land(spark, src, [("f", "r", "v", "x", at(2), 900), ("e", "r", "v", "x", at(181), 300)], STOP, 3)
    rows = run()
    old = rows.where(F.col("window_start") == F.lit(at(0)))
    last = old.orderBy(F.desc("batch")).first()
    assert (last.total_trips, last.delayed_trips, last.is_final) == (4, 2, True)
    now = rows.where((F.col("window_start") == F.lit(at(180))) & ~F.col("is_final")).orderBy(F.desc("batch")).first()
    assert (now.total_trips, now.delayed_trips, now.is_cascade) == (1, 1, True)
    assert left[-1] <= left[1]


def test_running_cascades_send_a_row_once_per_stretch(spark, tmp_dir):
    """Not once per window: nothing expands the rows to their five windows."""
    src = f"{tmp_dir}/src"
    land(spark, src, [("a", "r", "v", "x", at(0), 200)], STOP, 0)
    stops = follow(spark, src, STOP).withWatermark("event_ts", "5 minutes")
    with running.rocksdb(spark):
        plan = running.running_cascades(stops)._jdf.queryExecution().analyzed().toString()
    assert "Expand" not in plan and "sequence" in plan


def test_replay_takes_more_slices_of_more_messages(spark, monkeypatch):
    from headway.plans import batch

    rows = [(b"k", b"v", "t", at(i)) for i in range(10)]
    seen = []

    def start(src, out, checkpoints):
        seen.append(spark.read.parquet(f"{out[:-len('/out')]}/topic").count())
        return {}

    messages = spark.createDataFrame(rows, MESSAGE)
    batch.replayed(spark, messages, None, start, slices=2)
    assert seen == [5, 10]
    seen.clear()
    monkeypatch.setattr(batch, "SLICE_MESSAGES", 3)
    batch.replayed(spark, messages, None, start, slices=2)
    assert seen[-1] == 10 and len(seen) == 4


TRIP = "trip_id string, route_id string, agency string, window_start timestamp, max_arrival_delay_sec int"
FLAG = "route_id string, agency string, window_start timestamp, total_trips long, is_cascade boolean"


def test_labels_wait_for_the_later_window(spark, tmp_dir):
    trips, flags, out, ck = (f"{tmp_dir}/{x}" for x in ("trips", "flags", "out", "ck"))

    def run():
        q = write_stream_table(joins.label_stream(follow(spark, trips, TRIP), follow(spark, flags, FLAG)), out, ck, NOW)
        q.awaitTermination()
        return {(r.trip_id, r.window_start.minute): r.label for r in spark.read.parquet(out).collect()}

    land(spark, trips, [("a", "r", "x", at(0), 1), ("b", "s", "x", at(0), 1), ("c", None, "x", at(0), 1),
                        ("a", "r", "x", at(2), 1)], TRIP, 0)
    land(spark, flags, [("r", "x", at(10), 3, True), ("r", "x", at(2), 3, True)], FLAG, 0)
    # One match at once; what has no match yet waits.
    assert run() == {("a", 0): 1.0}
    land(spark, trips, [("a", "r", "x", at(40), 1)], TRIP, 1)
    land(spark, flags, [("r", "x", at(12), 3, False), ("z", "x", at(40), 1, True)], FLAG, 1)
    assert run() == {("a", 0): 1.0, ("a", 2): 0.0, ("b", 0): 0.0, ("c", 0): 0.0}


def test_labels_compare_a_window_with_one_window(spark, tmp_dir):
    """The shifted start is an equi key: no row meets its route's whole state."""
    trips, flags = f"{tmp_dir}/trips", f"{tmp_dir}/flags"
    land(spark, trips, [("a", "r", "x", at(0), 1)], TRIP, 0)
    land(spark, flags, [("r", "x", at(10), 3, True)], FLAG, 0)
    joined = joins.label_stream(follow(spark, trips, TRIP), follow(spark, flags, FLAG))
    plan = joined._jdf.queryExecution().analyzed().toString()
    condition = [x for x in plan.splitlines() if "Join LeftOuter" in x]
    assert len(condition) == 1 and "window_start" in condition[0] and ">=" not in condition[0]


def test_labels_keep_a_row_of_state_per_window_and_route(spark, tmp_dir):
    """Not one per trip; every trip comes out, those with null keys and copies too."""
    trips, flags, out, ck = (f"{tmp_dir}/{x}" for x in ("trips", "flags", "out", "ck"))
    rows = [(f"t{i}", "r", "x", at(0), i) for i in range(2500)] + [("n", None, "x", at(0), None)] * 2
    land(spark, trips, rows, TRIP, 0)
    land(spark, flags, [("r", "x", at(10), 3, True), ("r", "x", at(40), 3, True)], FLAG, 0)
    q = write_stream_table(joins.label_stream(follow(spark, trips, TRIP), follow(spark, flags, FLAG)), out, ck, NOW)
    q.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress) <= 3 + 1 + 2
    land(spark, trips, [("late", "z", "x", at(60), 1)], TRIP, 1)
    land(spark, flags, [("z", "x", at(60), 3, False)], FLAG, 1)
    q = write_stream_table(joins.label_stream(follow(spark, trips, TRIP), follow(spark, flags, FLAG)), out, ck, NOW)
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.columns == ["trip_id", "route_id", "agency", "window_start", "max_arrival_delay_sec", "label"]
    want = [(*r, 1.0 if r[1] else 0.0) for r in rows]
    have = [(r[0], r[1], r[2], r[4], r[5]) for r in got.where("trip_id != 'late'").collect()]
    assert sorted(have, key=str) == sorted([(a, b, c, e, f) for a, b, c, _, e, f in want], key=str)


@pytest.mark.parametrize("among", [1, 7, 1000])
def test_packed_rows_are_the_rows(spark, among):
    rows = [(f"t{i}", [None, "r", "s"][i % 3], ["x", None][i % 2], at(i % 4), i or None) for i in range(300)]
    df = spark.createDataFrame(rows, TRIP).coalesce(1)
    keys = ["route_id", "agency", "window_start"]
    got = joins.packed(df, keys, most=5, among=among)
    assert got.agg(F.max(F.size("_rows"))).first()[0] <= 5
    flat = got.select("*", F.inline("_rows")).select(*df.columns)
    assert sorted(map(str, flat.collect())) == sorted(map(str, df.collect()))
    only_keys = joins.packed(df.select(*keys), keys).select(F.inline("_rows"))
    assert sorted(map(str, only_keys.collect())) == sorted(map(str, df.select(*keys).collect()))
    assert joins.packed(df.limit(0), keys).count() == 0


def test_labels_replay_takes_smaller_slices(spark, monkeypatch):
    from headway.plans import live

    seen = []
    monkeypatch.setattr(live, "trip_topic", lambda *a: None)
    monkeypatch.setattr(live, "replayed", lambda *a, **kw: seen.append(kw["most"]))
    live._joined(spark, "", joins.label_stream, live.JOINED_MESSAGES)
    live._joined(spark, "", joins.feature_stream)
    assert seen == [live.JOINED_MESSAGES, None]


def test_features_of_two_streams(spark, tmp_dir):
    trips, flags, out, ck = (f"{tmp_dir}/{x}" for x in ("trips", "flags", "out", "ck"))
    land(spark, trips, [("a", "r", "x", at(0), 360), ("b", "s", "x", at(0), 1), ("e", "r", "x", at(60), 0)], TRIP, 0)
    land(spark, flags, [("r", "x", at(0), 7, True), ("r", "x", at(60), 8, True)], FLAG, 0)
    q = write_stream_table(joins.feature_stream(follow(spark, trips, TRIP), follow(spark, flags, FLAG)), out, ck, NOW)
    q.awaitTermination()
    got = {(r.trip_id, r.route_load, r.hour_of_day, r.delay_norm) for r in spark.read.parquet(out).collect()}
    assert got == {("a", 7, 8, 0.1), ("b", None, 8, 1 / 3600), ("e", 8, 9, 0.0)}


MESSAGE = "key binary, value binary, topic string, timestamp timestamp"


def test_metrics_in_flight(spark, tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    rows = [(b"wmata:1", b"v", "t1", at(0)), (b"wmata:2", b"v", "t1", at(0)), (b"mta:1", b"v", "t2", at(1)),
            (b"else:1", b"v", "t1", at(1)), (None, b"v", "t2", at(1)), (b"mta:9", b"v", None, at(1))]
    land(spark, src, rows, MESSAGE, 0)
    report, queries = metrics.BatchReport(), []
    spark.streams.addListener(report)
    try:
        for i in range(2):
            seen = metrics.observe_counts(follow(spark, src, MESSAGE), ["t1", "t2"], ["wmata", "mta"])
            q = write_stream_table(seen, out, f"{tmp_dir}/ck", NOW)
            q.awaitTermination()
            queries.append(q)
            if not i:
                land(spark, src, rows[:1], MESSAGE, 1)
        report.wait(queries)
    finally:
        spark.streams.removeListener(report)
    table = metrics.report_table(spark, report.rows + report.rows[:2])  # a batch that reports again counts once
    assert {tuple(r) for r in metrics.published(table).collect()} == {("t1", "wmata", 3), ("t2", "mta", 1)}
    assert table.agg(F.sum("value")).first()[0] == 7 == spark.read.parquet(out).count()


def test_quality_in_flight(spark, tmp_dir):
    schema = "route_id string, max_arrival_delay_sec int"
    src = f"{tmp_dir}/src"
    land(spark, src, [("r", 1), (None, 9000), ("r", None), ("r", 7200)], schema, 0)
    report = metrics.BatchReport()
    spark.streams.addListener(report)
    try:
        seen = metrics.observe_quality(follow(spark, src, schema), "trip_delay_events")
        q = write_stream_table(seen, f"{tmp_dir}/out", f"{tmp_dir}/ck", NOW)
        q.awaitTermination()
        report.wait([q])
    finally:
        spark.streams.removeListener(report)
    got = {r.check_name: (r.observed, r.passed) for r in
           metrics.quality_checks(metrics.report_table(spark, report.rows)).collect()}
    assert got == {"max_null_pct_route_id": (0.25, False), "max_delay_sec": (1.0, False)}


def test_trend_has_every_bucket(spark):
    rows = [("r", "x", at(3), 60), ("r", "x", at(3.5), 120), ("r", "x", at(9), 30), (None, "x", at(14), None), ("s", "x", at(-9), 1)]
    df = spark.createDataFrame(rows, "route_id string, agency string, window_start timestamp, max_arrival_delay_sec int")
    as_of = at(15).replace(tzinfo=None)
    got = {(r.route_id, r.bucket): (r.avg_delay_sec, r.trip_windows) for r in
           dashboard.route_trend(df, as_of, every_bucket=True).collect()}
    assert len(got) == 20
    assert [got["r", b][0] for b in range(10)] == [None, None, 90.0, 90.0, 90.0, 90.0, 30.0, 30.0, 30.0, 30.0]
    assert [got["r", b][1] for b in range(10)] == [0, 0, 2, 0, 0, 0, 1, 0, 0, 0]
    assert got[None, 9] == (None, 1) and got[None, 0] == (None, 0)


@pytest.mark.parametrize("n", [1, 50, 20_000])
def test_sketches_within_their_error(spark, n):
    df = spark.range(n).select(F.pmod("id", F.lit(24)).alias("hour"), F.lit("r").alias("route"),
                               F.pmod(F.xxhash64("id"), F.lit(5000)).cast("int").alias("max_arrival_delay_sec"))
    df = df.unionByName(spark.createDataFrame([(99, "empty", None)], df.schema))
    stored = delay_sketches(df, ["route", "hour"])
    got = quantile_estimates(stored, ["route"]).collect()
    assert [r.route for r in got] == ["r"] and got[0].n == n
    values = sorted(r[0] for r in df.where("route = 'r'").select("max_arrival_delay_sec").collect())
    for estimate, q in ((got[0].p50, 0.5), (got[0].p95, 0.95)):
        low = sum(v < estimate for v in values) / n
        high = sum(v <= estimate for v in values) / n
        assert low - 0.02 - 1 / n <= q <= high + 0.02 + 1 / n
    vehicles = df.select(F.col("max_arrival_delay_sec").cast("string").alias("vehicle_id"),
                         F.lit(at(1)).alias("event_ts"))
    about = dashboard.active_vehicles(dashboard.vehicle_sketches(vehicles), at(5).replace(tzinfo=None)).first()[0]
    exact = len(set(values))
    assert abs(about - exact) <= 0.05 * exact + 1


def test_scratch_folder_where_none_is_set(monkeypatch):
    """A local session without ``spark.checkpoint.dir`` gets one folder, once."""
    from types import SimpleNamespace

    from headway import session

    monkeypatch.setattr(session, "_SCRATCH", {})
    context = SimpleNamespace(master="local[2]", applicationId="app-1", getCheckpointDir=lambda: "there")
    bare = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, other: other))
    assert session.checkpoint_root(bare) == session.checkpoint_root(bare)
    context.master = "spark://host:7077"
    with pytest.raises(RuntimeError):
        session.checkpoint_root(bare)
