"""Layered batch models: staging -> hourly rollup -> daily reliability mart.

Plain DataFrame functions; the model graph is function composition.  Every
rounding goes through ``round_dec`` so results do not depend on how an
engine rounds a binary tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from headway.functions.columns import clamp_score, is_rush_hour, round_dec, safe_ratio
from headway.functions.thresholds import DEFAULT, Thresholds
from headway.operators.percentiles import from_histogram, histogram, weighted_count, weighted_mean

# Full grain of the staged tables (the merge keys).
TRIP_GRAIN = ("trip_id", "route_id", "vehicle_id", "agency", "window_start")


def stg_trip_delay_events(trip_delay: DataFrame, th: Thresholds = DEFAULT,
                          empty_as_null: bool = False, loaded_at: bool = True) -> DataFrame:
    """Typed, flagged, time-dimensioned trip delay windows.

    Rows need trip, route and window start, and a max delay inside the
    sanity band (a NULL delay is rejected too).  ``is_moderate`` is the
    staging band (60..299 s), distinct from the streaming MODERATE class.
    ``empty_as_null`` treats '' ids as missing (protobuf leaves unset
    strings empty); off by default, as in the reference.
    """
    trip_id, route_id = F.col("trip_id"), F.col("route_id")
    if empty_as_null:
        trip_id, route_id = F.nullif(trip_id, F.lit("")), F.nullif(route_id, F.lit(""))
    ws = F.col("window_start").cast("timestamp")
    mx = F.col("max_arrival_delay_sec")
    out = trip_delay.select(
        trip_id.alias("trip_id"),
        route_id.alias("route_id"),
        "vehicle_id",
        "agency",
        ws.alias("window_start"),
        mx.cast("int").alias("max_arrival_delay_sec"),
        F.col("avg_arrival_delay_sec").cast("double").alias("avg_arrival_delay_sec"),
        F.col("stops_reporting").cast("int").alias("stops_reporting"),
        F.upper(F.trim(F.col("delay_severity"))).alias("delay_severity"),
        (mx >= th.severe_sec).alias("is_severe"),
        mx.between(th.stg_moderate_low, th.stg_moderate_high).alias("is_moderate"),
        (mx <= 0).alias("is_on_time"),
        F.to_date(ws).alias("event_date"),
        F.hour(ws).alias("hour_of_day"),
        F.dayofweek(ws).alias("day_of_week"),
        is_rush_hour(F.hour(ws), th).alias("is_rush_hour"),
    ).filter(
        F.col("trip_id").isNotNull() & F.col("route_id").isNotNull()
        & F.col("window_start").isNotNull()
        & F.col("max_arrival_delay_sec").between(th.sanity_low, th.sanity_high)
    )
    return out.withColumn("_loaded_at", F.current_timestamp()) if loaded_at else out


def stg_cascade_flags(flags: DataFrame, loaded_at: bool = True) -> DataFrame:
    ws = F.col("window_start").cast("timestamp")
    out = flags.select(
        "route_id",
        "agency",
        ws.alias("window_start"),
        F.col("total_trips").cast("int").alias("total_trips"),
        F.col("delayed_trips").cast("int").alias("delayed_trips"),
        round_dec(F.col("delayed_pct").cast("double"), 4).alias("delayed_pct"),
        F.col("is_cascade").cast("boolean").alias("is_cascade"),
        F.col("cascade_score").cast("int").alias("cascade_score"),
        F.to_date(ws).alias("event_date"),
    )
    return out.withColumn("_loaded_at", F.current_timestamp()) if loaded_at else out


def route_delay_hourly(stg_trips: DataFrame, stg_flags: DataFrame, by_agency: bool = False,
                       percentiles: str = "histogram", distinct_trips: bool = False) -> DataFrame:
    """Hourly rollup per (route, agency, date, hour) with cascade activity.

    Percentiles: ``"histogram"`` (default, exact) reads them off a
    per-value count, see :mod:`headway.operators.percentiles`;
    ``"aggregate"`` uses ``percentile()`` (same values); ``"approx"`` uses
    ``percentile_approx``.  ``by_agency=True`` joins cascade
    activity per agency; the reference joins on route only and so mixes
    the agencies of one route id.  ``total_trips`` counts trip-windows (a
    trip sits in 5 sliding windows), as in the reference;
    ``distinct_trips=True`` adds the count of distinct trips.
    """
    d = F.col("max_arrival_delay_sec")
    hour_keys = ["route_id", "agency", "event_date", "hour_of_day", "is_rush_hour"]
    pcts = {"p50_delay_sec": 0.5, "p95_delay_sec": 0.95}
    if percentiles == "aggregate":
        inline = [F.percentile(d, p).alias(n) for n, p in pcts.items()]
    elif percentiles == "approx":
        inline = [F.percentile_approx(d, p).cast("double").alias(n) for n, p in pcts.items()]
    elif percentiles != "histogram":
        raise ValueError(f"unknown percentiles mode {percentiles!r}")
    if percentiles == "histogram":
        # Every measure but the distinct trips follows from one histogram.
        flags = ["is_severe", "is_moderate", "is_on_time"]
        hist = histogram(stg_trips, hour_keys, "max_arrival_delay_sec", flags)
        trip_hourly = from_histogram(hist, hour_keys, "max_arrival_delay_sec", pcts, [
            F.sum("_c").alias("total_trips"),
            weighted_count(F.col("is_severe")).alias("severe_trips"),
            weighted_count(F.col("is_moderate")).alias("moderate_trips"),
            weighted_count(F.col("is_on_time")).alias("on_time_trips"),
            weighted_mean(d).alias("avg_delay_sec"), F.max(d).alias("max_delay_sec")])
        if distinct_trips:
            trips = stg_trips.groupBy(*[F.col(k).alias(f"_{k}") for k in hour_keys]).agg(
                F.count_distinct("trip_id").alias("distinct_trips"))
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in hour_keys]
            trip_hourly = trip_hourly.join(trips, same)
    else:
        trip_hourly = stg_trips.groupBy(*hour_keys).agg(
            F.count(F.lit(1)).alias("total_trips"), F.count_if("is_severe").alias("severe_trips"),
            F.count_if("is_moderate").alias("moderate_trips"),
            F.count_if("is_on_time").alias("on_time_trips"), F.avg(d).alias("avg_delay_sec"),
            F.max(d).alias("max_delay_sec"), *inline,
            *([F.count_distinct("trip_id").alias("distinct_trips")] if distinct_trips else []))
    trip_hourly = trip_hourly.select(
        *hour_keys, "total_trips", "severe_trips", "moderate_trips", "on_time_trips", "avg_delay_sec",
        *pcts, "max_delay_sec", *(["distinct_trips"] if distinct_trips else []))
    keys = ["route_id", "event_date", "hour_of_day"] + (["agency"] if by_agency else [])
    cascade_hourly = (
        stg_flags.withColumn("hour_of_day", F.hour("window_start"))
        .groupBy(*keys).agg(
            F.max(F.col("is_cascade").cast("int")).alias("had_cascade"),
            F.max("cascade_score").alias("max_cascade_score"),
            F.sum(F.col("is_cascade").cast("int")).cast("long").alias("cascade_count"),
        )
    )
    j = trip_hourly.join(cascade_hourly, keys, "left")
    return j.select(
        *[F.col(c) for c in trip_hourly.columns],
        F.coalesce("had_cascade", F.lit(0)).alias("had_cascade"),
        F.coalesce("max_cascade_score", F.lit(0)).alias("max_cascade_score"),
        F.coalesce("cascade_count", F.lit(0).cast("long")).alias("cascade_count"),
        round_dec(safe_ratio("severe_trips", "total_trips"), 4).alias("severe_pct"),
        round_dec(safe_ratio("on_time_trips", "total_trips"), 4).alias("on_time_pct"),
    )


def route_reliability(hourly: DataFrame, frame: str = "rows", by_agency: bool = False,
                      null_score: str = "reference") -> DataFrame:
    """Daily scorecard per (route, agency, date) with 7-day rolling scores.

    ``frame="rows"``: 7 rows, as the reference (a missing day stretches the
    frame); ``frame="range"``: the last 7 calendar days.  The frame is
    ordered by (event_date, agency) so ties between agencies of one route
    are deterministic; ``by_agency=True`` partitions by agency as well.
    ``null_score``: see :func:`headway.functions.columns.clamp_score`.
    The window input is one row per route-day, so partitioning it by route
    stays small whatever the event volume.
    """
    daily, w = _daily(hourly), _last_7(frame, by_agency)
    on_time_pct = round_dec(safe_ratio("daily_on_time", "daily_trips") * 100, 1)
    rolling = daily.select(
        "*",
        round_dec(F.avg(on_time_pct).over(w), 1).alias("rolling_7d_on_time_pct"),
        round_dec(F.avg("daily_avg_delay_sec").over(w), 1).alias("rolling_7d_avg_delay_sec"),
        F.sum("had_cascade_event").over(w).alias("rolling_7d_cascade_count"),
    )
    score = round_dec(
        F.col("rolling_7d_on_time_pct") - F.col("rolling_7d_cascade_count") * 5
        - F.col("rolling_7d_avg_delay_sec") / 60, 1)
    return rolling.select(
        "route_id", "agency", "event_date", "daily_trips", "daily_on_time", "daily_severe",
        on_time_pct.alias("on_time_pct"),
        round_dec(safe_ratio("daily_severe", "daily_trips") * 100, 1).alias("severe_pct"),
        "daily_avg_delay_sec", "daily_max_delay_sec", "typical_p95_delay_sec",
        "had_cascade_event", "total_cascade_windows", "rush_hour_severe", "rush_hour_trips",
        round_dec(safe_ratio("rush_hour_severe", "rush_hour_trips") * 100, 1)
        .alias("rush_hour_severe_pct"),
        "rolling_7d_on_time_pct", "rolling_7d_avg_delay_sec", "rolling_7d_cascade_count",
        clamp_score(score, null_score).alias("reliability_score"),
    )


def _daily(hourly: DataFrame) -> DataFrame:
    rush = F.col("is_rush_hour")
    return hourly.groupBy("route_id", "agency", "event_date").agg(
        F.sum("total_trips").alias("daily_trips"),
        F.sum("severe_trips").alias("daily_severe"),
        F.sum("on_time_trips").alias("daily_on_time"),
        F.avg("avg_delay_sec").alias("daily_avg_delay_sec"),
        F.max("max_delay_sec").alias("daily_max_delay_sec"),
        F.percentile("p95_delay_sec", 0.5).alias("typical_p95_delay_sec"),
        F.max(F.col("had_cascade").cast("int")).alias("had_cascade_event"),
        F.sum("cascade_count").alias("total_cascade_windows"),
        F.sum(F.when(rush, F.col("severe_trips")).otherwise(0)).alias("rush_hour_severe"),
        F.sum(F.when(rush, F.col("total_trips")).otherwise(0)).alias("rush_hour_trips"),
    )


def _last_7(frame: str, by_agency: bool, back: int = 6, ahead: int = 0) -> WindowSpec:
    part = ["route_id"] + (["agency"] if by_agency else [])
    if frame == "rows":
        return Window.partitionBy(*part).orderBy("event_date", "agency").rowsBetween(-back, ahead)
    if frame == "range":
        day = F.datediff(F.col("event_date"), F.lit("1970-01-01").cast("date"))
        return Window.partitionBy(*part).orderBy(day).rangeBetween(-back, ahead)
    raise ValueError(f"frame must be 'rows' or 'range', not {frame!r}")


def reliability_reach(days: DataFrame, frame: str = "rows", by_agency: bool = False) -> DataFrame:
    """What a change of some days can reach in :func:`route_reliability`.

    ``days``: one row per (route_id, agency, event_date) with a boolean
    ``changed`` (a day that is new counts as changed).  Returns them with
    ``affected`` (a changed day lies in the row's frame) and ``needed`` (the
    row lies in the frame of an affected one).  The mart over the needed days
    alone has the right values on the affected ones."""
    behind = _last_7(frame, by_agency)
    before = _last_7(frame, by_agency, back=0, ahead=6)
    return (days.withColumn("affected", F.max("changed").over(behind))
            .withColumn("needed", F.max("affected").over(before)))
