"""Dashboard data products as queries over the pipeline tables.

Display bands (fixed values, dashboard only; the pipeline's own severity
and cascade rules are used everywhere else):
  route status severity   avg delay > 6 min SEVERE, > 3 MODERATE, > 1 MINOR
  route status colour     on-time % > 80 good, > 60 warn, else bad
  cascade alert level     score > 60 high, else moderate
  reliability band        score > 75 good, > 55 fair, else poor
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.columns import round_dec
from headway.functions.thresholds import SEVERITIES
from headway.operators.quality import _ts


def _since(col: str, as_of, minutes: int | None) -> Column:
    if minutes is None:
        return F.lit(True)
    return F.col(col) >= _ts(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")


def kpi_summary(vehicles: DataFrame, trip_windows: DataFrame, state: DataFrame,
                trips: DataFrame, as_of=None, minutes: int = 15,
                approx_vehicles: bool = False) -> DataFrame:
    """Headline numbers as (metric, value) rows: active vehicles, on-time
    rate, average delay (min), routes in cascade, events per minute.

    Each source is aggregated once, to one row that turns into its metrics.
    Give sources that are already limited to about the last ``minutes`` (with a
    window size of slack) to keep the scans short; the exact limit is applied
    here.
    """
    recent_v = vehicles.filter(_since("event_ts", as_of, minutes))
    distinct = (F.approx_count_distinct("vehicle_id") if approx_vehicles
                else F.count_distinct("vehicle_id"))
    recent_t = trip_windows.filter(_since("window_start", as_of, minutes))
    on_time = F.when(F.col("delay_severity") == "ON_TIME", 1.0).otherwise(0.0)

    def metrics(src: DataFrame, **values: Column) -> DataFrame:
        one = src.agg(*[v.alias(k) for k, v in values.items()])
        rows = [F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value")) for k in values]
        return one.select(F.inline(F.array(*rows)))

    return (
        metrics(recent_v, active_vehicles=distinct)
        .unionByName(metrics(recent_t, on_time_rate=round_dec(F.avg(on_time), 9),
                             avg_delay_min=round_dec(F.avg("max_arrival_delay_sec") / 60, 9)))
        .unionByName(metrics(state, routes_in_cascade=F.count_if(F.col("is_cascade"))))
        .unionByName(metrics(trips.filter(_since("event_ts", as_of, minutes)),
                             events_per_min=round_dec(F.count(F.lit(1)) / float(minutes), 9))))


def delay_distribution(trip_windows: DataFrame, size: str = "1 minute",
                       time_col: str = "window_start", as_of=None,
                       minutes: int | None = None) -> DataFrame:
    """Trip windows per severity per tumbling window (fixed pivot values, so
    it also runs on a stream)."""
    src = trip_windows.filter(_since(time_col, as_of, minutes))
    p = (src.groupBy(F.window(time_col, size).alias("w"))
         .pivot("delay_severity", list(SEVERITIES)).agg(F.count(F.lit(1))))
    return p.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *[F.coalesce(F.col(s), F.lit(0)).cast("long").alias(s) for s in SEVERITIES])


def active_cascades(state: DataFrame, trip_windows: DataFrame) -> DataFrame:
    """Routes whose latest state is a cascade, with the window's average
    trip delay, share affected and alert level."""
    keys = ["route_id", "agency", "window_start"]
    cur = state.filter(F.col("is_cascade"))
    # Only the current windows matter: semi-join them (one row per route and
    # agency) before aggregating the trip windows.
    current = trip_windows.join(cur.select(*keys), keys, "left_semi")
    delay = current.groupBy(*keys).agg(F.avg("max_arrival_delay_sec").alias("_avg"))
    j = cur.join(delay, keys, "left")
    return j.select(
        "route_id", "agency", "window_start", "cascade_score",
        round_dec(F.col("_avg") / 60, 1).alias("avg_delay_min"),
        round_dec(F.col("delayed_pct") * 100, 1).alias("pct_affected"),
        F.when(F.col("cascade_score") > 60, "high").otherwise("moderate").alias("alert_level"),
    )


def route_status(trip_windows: DataFrame, as_of=None, minutes: int | None = None) -> DataFrame:
    """Per route and agency: on-time %, average delay, display severity and
    colour band."""
    src = trip_windows.filter(_since("window_start", as_of, minutes))
    g = src.groupBy("route_id", "agency").agg(
        F.avg(F.when(F.col("delay_severity") == "ON_TIME", 1.0).otherwise(0.0)).alias("_ot"),
        F.avg("max_arrival_delay_sec").alias("_d"),
        F.count(F.lit(1)).alias("trip_windows"),
    )
    on_time = round_dec(F.col("_ot") * 100, 1)
    avg_min = round_dec(F.col("_d") / 60, 1)
    return g.select(
        "route_id", "agency", "trip_windows",
        on_time.alias("on_time_pct"), avg_min.alias("avg_delay_min"),
        F.when(avg_min > 6, "SEVERE").when(avg_min > 3, "MODERATE").when(avg_min > 1, "MINOR")
        .otherwise("ON_TIME").alias("display_severity"),
        F.when(on_time > 80, "good").when(on_time > 60, "warn").otherwise("bad").alias("band"),
    )


def route_trend(trip_windows: DataFrame, as_of=None, minutes: int = 15,
                buckets: int = 10, every_bucket: bool = False) -> DataFrame:
    """Average delay per route in ``buckets`` equal slices of the last
    ``minutes`` before ``as_of`` (the sparkline), one row per (route,
    agency, bucket).

    ``every_bucket=True`` gives each route of the span its full series: a bucket
    without rows has none (``trip_windows`` 0) and carries the last average
    forward, null before the first one."""
    start = _ts(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    width_us = minutes * 60 * 1_000_000 // buckets
    b = F.floor((F.unix_micros(F.col("window_start")) - F.unix_micros(start)) / width_us)
    src = trip_windows.filter((F.col("window_start") >= start)
                              & (F.col("window_start") < _ts(as_of)))
    found = src.groupBy("route_id", "agency", b.cast("int").alias("bucket")).agg(
        round_dec(F.avg("max_arrival_delay_sec"), 9).alias("avg_delay_sec"),
        F.count(F.lit(1)).alias("trip_windows"))
    if not every_bucket:
        return found
    # One row per route holds its few buckets: the grid needs no join, and null
    # routes are routes of their own.
    slots = found.groupBy("route_id", "agency").agg(F.map_from_entries(F.collect_list(F.struct(
        "bucket", F.struct("avg_delay_sec", "trip_windows")))).alias("have"))
    grid = slots.select("route_id", "agency", "have", F.explode(
        F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    had = F.filter(F.sequence(F.col("bucket"), F.lit(0), F.lit(-1)),
                   lambda i: F.try_element_at("have", i)["avg_delay_sec"].isNotNull())
    last = F.try_element_at("have", F.try_element_at(had, F.lit(1)))["avg_delay_sec"]
    here = F.try_element_at("have", F.col("bucket"))["trip_windows"]
    return grid.select("route_id", "agency", "bucket", last.alias("avg_delay_sec"),
                       F.coalesce(here, F.lit(0)).alias("trip_windows"))


def vehicle_sketches(vehicles: DataFrame, size: str = "1 minute") -> DataFrame:
    """(minute, sketch): a mergeable distinct-count sketch of the vehicles of each
    minute.  Stored once, it answers every horizon (:func:`active_vehicles`)."""
    return vehicles.groupBy(F.window("event_ts", size).alias("w")).agg(
        F.hll_sketch_agg("vehicle_id").alias("sketch")).select(F.col("w.start").alias("minute"), "sketch")


def active_vehicles(sketches: DataFrame, as_of=None, minutes: int = 15) -> DataFrame:
    """One row: about how many vehicles reported in the last ``minutes``, from the
    stored sketches; whole minutes from ``as_of`` back."""
    recent = sketches.filter(_since("minute", as_of, minutes))
    return recent.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("active_vehicles"))


def reliability_latest(mart: DataFrame) -> DataFrame:
    """Newest mart row per (route, agency) with its band; ``max_by`` keeps
    it a partial aggregate instead of a ranked window."""
    keep = ("event_date", "reliability_score", "rolling_7d_on_time_pct")
    g = mart.groupBy("route_id", "agency").agg(
        F.max_by(F.struct(*keep), F.col("event_date")).alias("_s"))
    score = F.col("_s.reliability_score")
    return g.select(
        "route_id", "agency", *[F.col(f"_s.{c}").alias(c) for c in keep],
        F.when(score > 75, "good").when(score > 55, "fair").otherwise("poor").alias("band"))


def ingest_throughput(messages: DataFrame, size: str = "1 minute",
                      watermark: str | None = None) -> DataFrame:
    """Messages per topic per tumbling window, with the running total per
    topic.  The running sum sees one row per (topic, window), so its
    per-topic partition grows with time span, not with message volume.

    On a stream (give ``watermark`` on the envelope timestamp) the windowed
    counts run in append mode; the running total is a batch-only column,
    taken on read of the sink table."""
    src = messages.withWatermark("timestamp", watermark) if watermark else messages
    g = src.groupBy(F.window("timestamp", size).alias("w"), "topic").agg(
        F.count(F.lit(1)).alias("messages"))
    out = g.select(F.col("w.start").alias("window_start"), "topic", "messages")
    if messages.isStreaming:
        return out
    w = (Window.partitionBy("topic").orderBy("window_start")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return out.withColumn("total_messages", F.sum("messages").over(w))
