"""Stop-level delay hotspots.

``hotspots_like`` keeps the reference's match rule, ``trip_id LIKE '%' ||
stop_id || '%'`` (so ``_`` and ``%`` in a stop id are wildcards), without a
nested-loop join:

1. events are pre-aggregated per trip (count, sum, max, severe count);
   the hotspot metrics are all re-aggregable from these.
2. each stop id's longest literal run (text between wildcards) must occur
   in any trip id it matches; the distinct substrings of a trip id of the
   key lengths present are equi-join keys against it, and the exact LIKE
   then confirms the candidates.  Plain ids (no wildcard) match exactly on
   the key.
3. stop ids made only of wildcards match every trip id at least as long as
   their ``_`` count; they join the per-length aggregates, no pairs at all.

``hotspots_by_stop`` is the scalable default: an equi-join of stop-level
updates on (stop_id, route_id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import as_of_date, round_dec
from headway.functions.thresholds import DEFAULT, Thresholds

STOP_COLS = ("stop_id", "stop_name", "latitude", "longitude", "route_id")


def _finish(parts: DataFrame, min_events: int) -> DataFrame:
    """Per-stop partial sums -> the hotspot columns, filtered and sorted."""
    g = parts.groupBy(*STOP_COLS).agg(
        F.sum("n").alias("delay_events"),
        F.sum("s").alias("_sum"),
        F.max("mx").alias("max_delay_sec"),
        F.sum("sev").alias("severe_events"),
    )
    avg = F.col("_sum").cast("double") / F.col("delay_events")
    return (
        g.filter(F.col("delay_events") >= min_events)
        .select(
            *STOP_COLS, "delay_events",
            avg.alias("avg_delay_sec"),
            "max_delay_sec", "severe_events",
            round_dec(avg / 60, 1).alias("avg_delay_min"),
            round_dec(F.log(1 + F.col("delay_events")) * avg / 60, 2).alias("hotspot_score"),
        )
        .orderBy(F.desc("hotspot_score"), "stop_id", "route_id")
    )


def hotspots_like(stg_trips: DataFrame, stops: DataFrame, as_of=None,
                  days: int = DEFAULT.hotspot_days,
                  min_events: int = DEFAULT.hotspot_min_events) -> DataFrame:
    """Hotspots per stop row with the reference's substring LIKE match.

    Window: ``event_date >= as_of_date - days`` (8 calendar dates for 7,
    as in the reference); groups need ``min_events`` trip windows.
    """
    recent = stg_trips.filter(F.col("event_date") >= F.date_sub(as_of_date(as_of), days))
    per_trip = recent.groupBy("trip_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("max_arrival_delay_sec").cast("long").alias("s"),
        F.max("max_arrival_delay_sec").alias("mx"),
        F.sum(F.col("is_severe").cast("int")).cast("long").alias("sev"),
    )

    sid = F.col("stop_id")
    segments = F.split(sid, r"[%_\\]")
    longest = F.array_max(F.transform(segments, lambda s: F.struct(F.length(s).alias("l"),
                                                                  s.alias("s")))).getField("s")
    escaped = F.regexp_extract(sid, r"\\(.)", 1)
    key = F.when(F.coalesce(longest, F.lit("")) != "", longest).otherwise(escaped)
    st = stops.select(*STOP_COLS, key.alias("_key"))
    keyed = st.filter(F.col("_key") != "")
    wild = st.filter(F.col("_key") == "").withColumn(
        "_u", F.length(sid) - F.length(F.regexp_replace(sid, "_", "")))

    plain = keyed.filter(F.col("_key") == sid)
    pattern = keyed.filter(F.col("_key") != sid)
    # One pass over the stops dimension: which kinds of id there are, and the
    # distinct key lengths (a handful of small integers).
    facts = st.agg(
        F.count_if(F.col("_key") == "").alias("wild"),
        F.count_if((F.col("_key") != "") & (F.col("_key") != sid)).alias("pattern"),
        F.array_sort(F.collect_set(F.when(F.col("_key") != "", F.length("_key"))))
        .alias("lengths"),
    ).first()
    lengths = list(facts["lengths"])

    # Distinct substrings of each trip id, only of the key lengths present:
    # at most L per key length.
    tid = F.col("trip_id")
    n = F.length(tid)
    if lengths:
        subs = F.array_distinct(F.flatten(F.transform(
            F.array(*[F.lit(m) for m in lengths]),
            lambda m: F.transform(
                F.filter(F.sequence(F.lit(1), F.greatest(n - m + 1, F.lit(1))),
                         lambda p: p + m - 1 <= n),
                lambda p: F.substr(tid, p, m)))))
    else:
        subs = F.array().cast("array<string>")
    trip_keys = per_trip.filter(n > 0).select("*", F.explode(subs).alias("_key"))
    # A plain id matches exactly the trips that hold its key: one row per key
    # meets the stops, however many trips a short id is part of.
    per_key = trip_keys.groupBy("_key").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.max("mx").alias("mx"),
        F.sum("sev").alias("sev"))
    parts = [per_key.join(plain, "_key")]
    if facts["pattern"]:
        # Ids with wildcards need the trip id itself to confirm a candidate.
        parts.append(trip_keys.join(pattern, "_key")
                     .filter(F.like(tid, F.concat(F.lit("%"), sid, F.lit("%")))))
    matched = parts[0].select(*STOP_COLS, "n", "s", "mx", "sev")
    for part in parts[1:]:
        matched = matched.unionByName(part.select(*STOP_COLS, "n", "s", "mx", "sev"))

    if facts["wild"] == 0:
        # No wildcard-only id in the dimension.
        return _finish(matched, min_events)

    # Wildcard-only ids: aggregates over trips with length >= u, per u.
    by_len = per_trip.groupBy(n.alias("_len")).agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.max("mx").alias("mx"),
        F.sum("sev").alias("sev"))
    at_least = by_len.select(F.explode(F.sequence(F.lit(0), "_len")).alias("_u"),
                             "n", "s", "mx", "sev").groupBy("_u").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.max("mx").alias("mx"),
        F.sum("sev").alias("sev"))
    wild_matched = wild.join(at_least, "_u").select(*STOP_COLS, "n", "s", "mx", "sev")

    return _finish(matched.unionByName(wild_matched), min_events)


def hotspots_by_stop(stop_rows: DataFrame, stops: DataFrame, as_of=None,
                     days: int = DEFAULT.hotspot_days,
                     min_events: int = DEFAULT.hotspot_min_events,
                     th: Thresholds = DEFAULT) -> DataFrame:
    """Hotspots from stop-level updates joined on (stop_id, route_id).

    Ours: counts stop updates (not trip windows) whose arrival delay is in
    the staging sanity band, over the same calendar window.  The per-stop
    partial aggregate runs before the join, so the join sees one row per
    (stop, route) and a hot stop cannot skew it.
    """
    d = F.col("arrival_delay_sec")
    recent = stop_rows.filter(
        (F.to_date("event_ts") >= F.date_sub(as_of_date(as_of), days))
        & d.between(th.sanity_low, th.sanity_high)
        & F.col("stop_id").isNotNull() & F.col("route_id").isNotNull())
    per_stop = recent.groupBy("stop_id", "route_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(d).cast("long").alias("s"),
        F.max(d).alias("mx"),
        F.sum(F.when(d >= th.severe_sec, 1).otherwise(0)).cast("long").alias("sev"),
    )
    joined = per_stop.join(stops.select(*STOP_COLS), ["stop_id", "route_id"])
    return _finish(joined.select(*STOP_COLS, "n", "s", "mx", "sev"), min_events)
