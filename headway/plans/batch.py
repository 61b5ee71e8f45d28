"""Batch compositions over a test-data directory.

Each function reads the given tables and chains the operators the way the
streaming job does (feed -> messages -> parse -> windows), so every derived
table grows with its inputs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.columns import utc_literal

from headway.functions.thresholds import DEFAULT, Thresholds
from headway.operators.aggregates import cascade_flags, route_speed_agg, trip_delay
from headway.operators.ingest import (
    normalize_trip_updates,
    normalize_vehicle_positions,
    trip_messages,
    vehicle_messages,
)
from headway.operators.parse import (
    explode_stop_updates,
    parse_trip_updates,
    parse_vehicle_positions,
)
from headway.operators.hotspots import hotspots_by_stop, hotspots_like
from headway.operators.models import (
    TRIP_GRAIN,
    route_delay_hourly,
    route_reliability,
    stg_cascade_flags,
    stg_trip_delay_events,
)
from headway.operators.ingest import ingest_counts
from headway.operators.parse import feed_entities
from headway.operators.sketches import delay_sketches, quantile_estimates
from headway.operators.state import latest_route_state
from headway.plans.refresh import refresh_models
from headway.session import hadoop_fs, staging_folder
from headway.operators import dashboard as dash
from headway.operators import ml
from headway.operators.quality import check_freshness, quality_report
from headway.sinks.tables import (
    incremental_filter,
    merge_rows,
    read_table,
    table_last_write,
    upsert_table,
    write_table,
)
from headway.sources.testdata import (
    AS_OF,
    landed_feed,
    load_events,
    load_feed,
    load_stops,
    transit_feed,
)
from headway.sources.topics import read_topic


def shared(df: DataFrame) -> DataFrame:
    """Materialise an intermediate that several branches of one plan read
    (the trip-window table, as the streaming job writes it), so it is
    computed once.  It is written as a Parquet table under the session's
    ``spark.checkpoint.dir``: that cuts the lineage (an executor lost later
    does not replay the JSON parsing), and the branches' own filters and
    projections push down into its scan.  The folder goes with the run
    (see ``run_folder``)."""
    path = staging_folder(df.sparkSession, "shared")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def vehicle_position_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_vehicle_positions(load_feed(spark, sf_dir), F.col("agency"))


def trip_update_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_trip_updates(load_feed(spark, sf_dir), F.col("agency"))


def vehicle_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vehicle_messages(vehicle_position_rows(spark, sf_dir))


def trip_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_messages(trip_update_rows(spark, sf_dir))


def events_since(spark: SparkSession, sf_dir: str, moment: dt.datetime) -> DataFrame:
    """Events from ``moment`` on; the filter reaches the Parquet scan."""
    text = moment.strftime("%Y-%m-%d %H:%M:%S")
    return load_events(spark, sf_dir).filter(F.col("ts") >= F.lit(text).cast("timestamp_ntz"))


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_vehicle_positions(vehicle_topic(spark, sf_dir))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_trip_updates(trip_topic(spark, sf_dir))


def stop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_stop_updates(trips(spark, sf_dir))


def speed_windows(spark: SparkSession, sf_dir: str, th: Thresholds = DEFAULT,
                  size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    return route_speed_agg(vehicles(spark, sf_dir), size, slide, th)


def trip_delay_windows(spark: SparkSession, sf_dir: str, th: Thresholds = DEFAULT,
                       size: str = "10 minutes", slide: str = "2 minutes") -> DataFrame:
    return trip_delay(stop_rows(spark, sf_dir), size, slide, th)


def cascade_windows(spark: SparkSession, sf_dir: str, th: Thresholds = DEFAULT,
                    size: str = "10 minutes", slide: str = "2 minutes") -> DataFrame:
    return cascade_flags(trip_delay(stop_rows(spark, sf_dir), size, slide, th,
                                    keep_window=True), th)


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_stops(spark, sf_dir)


def stg_trips(spark: SparkSession, sf_dir: str, th: Thresholds = DEFAULT,
              loaded_at: bool = False) -> DataFrame:
    return stg_trip_delay_events(trip_delay_windows(spark, sf_dir, th), th, loaded_at=loaded_at)


def stg_flags(spark: SparkSession, sf_dir: str, th: Thresholds = DEFAULT,
              loaded_at: bool = False) -> DataFrame:
    return stg_cascade_flags(cascade_windows(spark, sf_dir, th), loaded_at=loaded_at)


def hourly(spark: SparkSession, sf_dir: str, by_agency: bool = False,
           distinct_trips: bool = False) -> DataFrame:
    td = shared(trip_delay_windows(spark, sf_dir))
    return route_delay_hourly(stg_trip_delay_events(td, loaded_at=False),
                              stg_cascade_flags(cascade_flags(td), loaded_at=False),
                              by_agency=by_agency, distinct_trips=distinct_trips)


def reliability(spark: SparkSession, sf_dir: str, by_agency: bool = False, **kw) -> DataFrame:
    return route_reliability(hourly(spark, sf_dir, by_agency=by_agency), by_agency=by_agency,
                             **kw)


def cascade_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide 10 h / 2 h windows: dense enough to reach the score cap."""
    return cascade_windows(spark, sf_dir, size="10 hours", slide="2 hours")


def hotspots_like_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots_like(stg_trips(spark, sf_dir), stops(spark, sf_dir), AS_OF)


def hotspots_by_stop_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspots_by_stop(stop_rows(spark, sf_dir), stops(spark, sf_dir), AS_OF)


def feed_vehicle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON feed -> entities -> vehicle position rows."""
    ents = feed_entities(landed_feed(load_feed(spark, sf_dir)), keep=["agency"])
    return normalize_vehicle_positions(ents, F.col("agency"))


def feed_trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON feed -> entities -> trip update rows (stop list as JSON)."""
    ents = feed_entities(landed_feed(load_feed(spark, sf_dir)), keep=["agency"])
    rows = normalize_trip_updates(ents, F.col("agency"))
    return rows.withColumn("stop_time_updates", F.to_json("stop_time_updates"))


def trip_topic_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = trip_topic(spark, sf_dir)
    return m.select(F.col("key").cast("string").alias("key"),
                    F.col("value").cast("string").alias("value"), "topic", "timestamp")


def topic_ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_counts(vehicle_topic(spark, sf_dir).unionByName(trip_topic(spark, sf_dir)))


def route_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_route_state(cascade_windows(spark, sf_dir))


def _stg_from_events(events: DataFrame) -> DataFrame:
    """Staged trip windows from an events DataFrame (full chain)."""
    feed = transit_feed(events)
    msgs = trip_messages(normalize_trip_updates(feed, F.col("agency")))
    return stg_trip_delay_events(
        trip_delay(explode_stop_updates(parse_trip_updates(msgs))), loaded_at=False)


def incremental_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows newer than a target loaded up to 2024-01-16."""
    stg = shared(stg_trips(spark, sf_dir))
    target = stg.filter(F.col("window_start") < F.lit("2024-01-16").cast("timestamp"))
    return incremental_filter(stg, target)


def incremental_lookback_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`incremental_q` with a 2-hour lookback: recent windows are
    re-read so their late rows can be merged again."""
    stg = shared(stg_trips(spark, sf_dir))
    target = stg.filter(F.col("window_start") < F.lit("2024-01-16").cast("timestamp"))
    return incremental_filter(stg, target, lookback="2 hours")


def merge_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target staged from events before 2024-01-20, upserted with a batch
    staged from events since 2024-01-19 (overlapping windows replaced)."""
    ev = load_events(spark, sf_dir)
    old = _stg_from_events(ev.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")))
    # Staged once (the merge reads it twice), and unique by its grain already.
    new = shared(_stg_from_events(ev.filter(F.col("ts") >= F.lit("2024-01-19").cast("timestamp_ntz"))))
    return merge_rows(old, new, list(TRIP_GRAIN), dedupe=False)


def quality_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    td = shared(trip_delay_windows(spark, sf_dir))
    return quality_report({
        "trip_delay_events": td,
        "route_speed_agg": speed_windows(spark, sf_dir),
        "cascade_flags": cascade_flags(td),
    }, as_of=AS_OF)


def freshness_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age of the newest trip window: that of the newest stop row, so no window
    has to be built for it."""
    slide = 120
    rows = explode_stop_updates(parse_trip_updates(trip_topic(spark, sf_dir)))
    newest = rows.agg(F.max("event_ts").alias("t")).select(
        F.timestamp_seconds(F.floor(F.unix_seconds("t") / slide) * slide).alias("window_start"))
    return check_freshness(newest, AS_OF, ts_col="window_start")


def table_freshness_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the trip windows as a stored table, then check its last write
    against the clock: (rows, passed)."""
    path = staging_folder(spark, "freshness")
    write_table(trip_delay_windows(spark, sf_dir).withColumn("event_date", F.to_date("window_start")),
                path, partition_by=["event_date"], cluster_by=["event_date", "route_id", "window_start"])
    passed = check_freshness(table_last_write(spark, path)).first()["passed"]
    return read_table(spark, path).agg(F.count(F.lit(1)).alias("rows"), F.lit(passed).alias("passed"))


def kpi_q(spark: SparkSession, sf_dir: str, minutes: int = 60) -> DataFrame:
    """The last hour's numbers from the last hour's events (and a window size of
    slack); only the latest state per route looks further back."""
    slack = dt.timedelta(minutes=minutes + 10)
    feed = transit_feed(events_since(spark, sf_dir, AS_OF - slack))
    vehicle = vehicle_messages(normalize_vehicle_positions(feed, F.col("agency")))
    trip = trip_messages(normalize_trip_updates(feed, F.col("agency")))
    return dash.kpi_summary(parse_vehicle_positions(vehicle, fields=["vehicle_id"]),
                            trip_delay(explode_stop_updates(parse_trip_updates(trip))),
                            latest_route_state(cascade_windows(spark, sf_dir)),
                            parse_trip_updates(trip, fields=["trip_id"]), AS_OF, minutes=minutes)


def distribution_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.delay_distribution(trip_delay_windows(spark, sf_dir), "1 minute")


def active_cascades_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    td = shared(trip_delay_windows(spark, sf_dir))
    return dash.active_cascades(latest_route_state(cascade_flags(td)), td)


def route_status_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.route_status(trip_delay_windows(spark, sf_dir))


def route_trend_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.route_trend(trip_delay_windows(spark, sf_dir), AS_OF, minutes=24 * 60)


def route_trend_full_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.route_trend(trip_delay_windows(spark, sf_dir), AS_OF, minutes=24 * 60, every_bucket=True)


def active_vehicles_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active vehicles of several horizons from one table of sketches, with the
    exact counts and whether the estimate is within 5 %."""
    stored = shared(dash.vehicle_sketches(vehicles(spark, sf_dir)))
    none = F.lit(None).cast("long")
    rows = None
    for minutes in (60, 24 * 60, 7 * 24 * 60):
        recent = vehicles(spark, sf_dir).filter(dash._since("event_ts", AS_OF, minutes))
        exact = recent.agg(F.count_distinct("vehicle_id").alias("exact")).select(none.alias("about"), "exact")
        about = dash.active_vehicles(stored, AS_OF, minutes).select(F.col("active_vehicles").alias("about"), none.alias("exact"))
        both = about.unionByName(exact).withColumn("horizon_minutes", F.lit(minutes))
        rows = both if rows is None else rows.unionByName(both)
    one = rows.groupBy("horizon_minutes").agg(F.max("about").alias("about"), F.max("exact").alias("vehicles"))
    near = F.abs(F.col("about") - F.col("vehicles")) <= 0.05 * F.col("vehicles") + 1
    return one.select("horizon_minutes", "vehicles", near.alias("within"))


def sketched_percentiles_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily medians and 95th percentiles per route merged from hourly sketches;
    each checked by its rank among the day's delays (within 2 %)."""
    stg = shared(stg_trips(spark, sf_dir))
    keys = ["route_id", "event_date"]
    days = quantile_estimates(shared(delay_sketches(stg, keys + ["hour_of_day"])), keys)
    d = F.col("max_arrival_delay_sec")
    ranks = stg.join(days, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(d < F.col(c)).alias(f"{c}_lo") for c in ("p50", "p95")],
        *[F.count_if(d <= F.col(c)).alias(f"{c}_hi") for c in ("p50", "p95")])
    near = [((F.col(f"{c}_lo") <= (q + 0.02) * F.col("n") + 1) & (F.col(f"{c}_hi") >= (q - 0.02) * F.col("n") - 1))
            .alias(f"{c}_within") for c, q in (("p50", 0.5), ("p95", 0.95))]
    return ranks.select(*keys, "n", *near)


def reliability_latest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dash.reliability_latest(reliability(spark, sf_dir))


def throughput_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = vehicle_topic(spark, sf_dir).unionByName(trip_topic(spark, sf_dir))
    return dash.ingest_throughput(msgs, "1 hour")


def profiles_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml.route_profiles(stg_trips(spark, sf_dir), AS_OF)


def features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    td = shared(trip_delay_windows(spark, sf_dir))
    profiles = ml.route_profiles(stg_trip_delay_events(td, loaded_at=False), AS_OF)
    return ml.cascade_features(td, profiles=profiles, flags=cascade_flags(td))


def labels_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    td = shared(trip_delay_windows(spark, sf_dir))
    return ml.cascade_labels(td, cascade_flags(td))


def labelled_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set: labelled windows with their enriched features."""
    td = shared(trip_delay_windows(spark, sf_dir))
    flags = shared(cascade_flags(td))
    profiles = ml.route_profiles(stg_trip_delay_events(td, loaded_at=False), AS_OF)
    features = ml.cascade_features(td, profiles=profiles, flags=flags)
    return ml.training_set(ml.cascade_labels(features, flags), AS_OF)


def score_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact AUC, precision and recall, gated, of a score that any engine can
    compute: the normalised delay."""
    return ml.model_gate(ml.score_metrics(labelled_windows(spark, sf_dir), "delay_norm", threshold=0.05))


def model_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the labelled windows of the 30-day lookback except the last
    week, evaluate on that held-out week, gate (one row)."""
    train, test = ml.time_split(shared(labelled_windows(spark, sf_dir)), AS_OF)
    model = ml.train_cascade_model(train, features=ml.ENRICHED, max_iter=10)
    return ml.model_gate(ml.model_metrics(ml.score_cascades(test, model)))


def upsert_state_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest state per route, kept as a table by newest-wins upserts: a late
    part first repeats and then overlaps what is stored."""
    path = staging_folder(spark, "route-state")
    flags = shared(cascade_windows(spark, sf_dir))
    day = F.to_date("window_start")
    for part in (day >= F.lit("2024-01-15"), day < F.lit("2024-01-20"), day >= F.lit("2024-01-15")):
        upsert_table(spark, path, latest_route_state(flags.filter(part)), ["route_id", "agency"],
                     partition_col=None, order_by=["window_start"], newest_wins=True)
    return read_table(spark, path)


def upsert_profiles_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route profiles as a table partitioned by weekday: a week-old run, then
    today's, which replaces the profiles that it has."""
    path = staging_folder(spark, "profiles")
    stg = shared(stg_trips(spark, sf_dir))
    earlier = AS_OF - dt.timedelta(days=7)
    for rows, moment in ((stg.filter(F.col("window_start") < utc_literal(earlier)), earlier),
                         (stg.filter(F.col("window_start") >= utc_literal(earlier)), AS_OF)):
        upsert_table(spark, path, ml.route_profiles(rows, moment), ml.PROFILE_KEYS,
                     partition_col="day_of_week")
    return read_table(spark, path)


def refresh_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reliability mart after two runs of the stored models: one over the
    windows before 2024-01-20, one after the rest has arrived."""
    root = staging_folder(spark, "models")
    trips = shared(trip_delay_windows(spark, sf_dir))
    flags = shared(cascade_flags(trips))
    early = F.col("window_start") < F.lit("2024-01-20").cast("timestamp")
    refresh_models(spark, root, trips.filter(early), flags.filter(early))
    refresh_models(spark, root, trips, flags)
    return read_table(spark, f"{root}/mart_route_reliability")


#: Messages of a replay's slice, about; a trip update is up to 5 windows of state.
SLICE_MESSAGES = 3_000_000


def replayed(spark: SparkSession, messages: DataFrame, topic: str | None, start, slices: int = 4,
             most: int | None = None) -> str:
    """Replay a topic (None: all topics of the messages) through streaming queries; returns the output folder.

    The messages are landed in one pass, partitioned into ``slices`` equal spans
    of their own time range, or more of them where a slice would hold over
    ``most`` (``SLICE_MESSAGES`` if None) on average: a stateful query keeps all windows of a
    micro-batch, so its state follows the slice and not the topic.  One slice
    after the other is made visible to the stream (a rename) and run to its end
    on one checkpoint, as one micro-batch without a file cap.  Lateness is judged
    between micro-batches, and no message of a slice is older than one of an
    earlier slice, so it depends on neither the number of slices nor that of the
    files or their order.  ``start(source, out, checkpoints)`` starts the queries.
    """
    root = staging_folder(spark, "stream-replay")
    stamp = F.unix_micros("timestamp")
    low, high, n = messages.agg(F.min(stamp), F.max(stamp), F.count(F.lit(1))).first()
    if low is None:
        low = high = 0
    slices = max(slices, -(-n // (most or SLICE_MESSAGES)))
    width = (high - low) // slices + 1
    where = F.floor((stamp - F.lit(low)) / F.lit(width)).cast("int")
    messages.withColumn("slice", where).write.partitionBy("slice").parquet(f"{root}/landing")
    fs, top = hadoop_fs(spark, f"{root}/topic")
    fs.mkdirs(top)
    for i in range(slices):
        _, have = hadoop_fs(spark, f"{root}/landing/slice={i}")
        if not fs.exists(have):
            continue
        _, there = hadoop_fs(spark, f"{root}/topic/slice={i}")
        fs.rename(have, there)
        src = read_topic(spark, topic, source="parquet", path=f"{root}/topic",
                         options={"recursiveFileLookup": "true"})
        for q in start(src, f"{root}/out", f"{root}/ck").values():
            q.awaitTermination()
    return f"{root}/out"


NOW = {"availableNow": True}


def cascade_stream_q(spark: SparkSession, sf_dir: str, messages: DataFrame | None = None) -> DataFrame:
    """The streaming job end to end: the trip topic is replayed (see
    :func:`replayed`) through the chained append-mode aggregation and the
    foreachBatch sink, and the emitted cascade table is read back.  Windows
    still open at the final watermark are not emitted, exactly as on a live
    stream."""
    from headway.streaming.jobs import run_pipeline

    def start(src, out, checkpoints):
        return run_pipeline(spark, None, src, out, triggers={"cascade": NOW}, ckpt_root=checkpoints,
                            only=["cascade"])

    messages = trip_topic(spark, sf_dir) if messages is None else messages
    out = replayed(spark, messages, "gtfs.trip_updates", start)
    return spark.read.parquet(f"{out}/cascade_flags").drop("query", "batch")


def speed_stream_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vehicle stream: closed 5/1-minute speed windows, as emitted."""
    from headway.streaming.jobs import run_pipeline

    def start(src, out, checkpoints):
        return run_pipeline(spark, src, src, out, triggers={"speed": NOW}, ckpt_root=checkpoints,
                            only=["speed"])

    out = replayed(spark, vehicle_topic(spark, sf_dir), "gtfs.vehicle_positions", start)
    return spark.read.parquet(f"{out}/route_speed_agg")
