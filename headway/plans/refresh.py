"""One run of the stored model layer: load what is new, merge it, and carry the
change through the marts.

Tables under one root: ``stg_trip_delay_events``, ``stg_cascade_flags``,
``int_route_delay_hourly`` and ``mart_route_reliability`` (upserted, partitioned by
date) and, with a stops dimension, ``mart_delay_hotspots`` (rewritten in full: its
span of dates moves with ``as_of``).

A later run computes only what the new windows can change: the hours of their dates,
and of the mart the rows whose seven-row frame holds a changed (route, date).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.hotspots import hotspots_like
from headway.operators.models import (
    TRIP_GRAIN,
    reliability_reach,
    route_delay_hourly,
    route_reliability,
    stg_cascade_flags,
    stg_trip_delay_events,
)
from headway.session import staging_folder
from headway.sinks.tables import any_of, incremental_filter, read_table, table_state, upsert_table, write_table

FLAG_GRAIN = ("route_id", "agency", "window_start")
HOUR_GRAIN = ("route_id", "agency", "event_date", "hour_of_day")
DAY_GRAIN = ("route_id", "agency", "event_date")


def _written(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    path = staging_folder(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _load(spark: SparkSession, path: str, staged: DataFrame, keys: Sequence[str],
          lookback: str | None) -> tuple[DataFrame, DataFrame]:
    """Merge the new windows; returns the table and the (route, date) pairs they are of."""
    stored = read_table(spark, path) if table_state(spark, path) else None
    fresh = incremental_filter(staged, stored, lookback=lookback)
    if stored is not None:
        fresh = _written(spark, fresh, "fresh")  # read for its dates, its pairs and the merge
    upsert_table(spark, path, fresh, keys, partition_col="event_date", derived_from="window_start")
    table = read_table(spark, path)
    return table, (table if stored is None else fresh).select("route_id", "event_date").distinct()


def _refresh_reliability(spark: SparkSession, root: str, hourly: DataFrame, changed: DataFrame,
                         frame: str, by_agency: bool, null_score: str) -> None:
    path = f"{root}/mart_route_reliability"

    def mart(rows: DataFrame) -> DataFrame:
        return route_reliability(rows, frame=frame, by_agency=by_agency, null_score=null_score)

    if table_state(spark, path) is None:
        new = mart(hourly)
    else:
        dates = [r[0] for r in changed.select("event_date").distinct().collect()]
        pair = ["route_id", "event_date"]
        here = hourly.where(any_of("event_date", dates)).join(changed, pair, "left_semi")
        # One row per stored day and per changed one: keys only, no measure is read.
        days = (read_table(spark, path).select(*DAY_GRAIN, F.lit(False).alias("changed"))
                .unionByName(here.select(*DAY_GRAIN, F.lit(True).alias("changed")))
                .groupBy(*DAY_GRAIN).agg(F.max("changed").alias("changed")))
        reach = _written(spark, reliability_reach(days, frame, by_agency).where("needed"), "reach")
        dates = [r[0] for r in reach.select("event_date").distinct().collect()]
        keys = reach.select(*[F.col(k).alias(f"_{k}") for k in DAY_GRAIN], "affected")
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in DAY_GRAIN]
        needed = hourly.where(any_of("event_date", dates)).join(keys, same, "left_semi")
        new = mart(needed).join(keys.where("affected"), same, "left_semi")
    upsert_table(spark, path, new, DAY_GRAIN, partition_col="event_date", cluster_by=["route_id"])


def refresh_models(spark: SparkSession, root: str, trip_delay_events: DataFrame,
                   cascade_flags: DataFrame, stops: DataFrame | None = None, as_of=None,
                   lookback: str | None = None, **options) -> None:
    """Run the models over the streaming job's tables.  The first run loads all;
    a later one the windows after the stored ones (``lookback`` re-reads recent
    windows, whose late rows replace the stored ones).  ``options`` go to the
    model functions (``by_agency``, ``frame``, ``null_score``); a root keeps one set.

    A run that ends between two tables leaves the later ones behind; the next run's
    ``lookback`` has to reach back over it."""
    by_agency = options.get("by_agency", False)
    trips, late = _load(spark, f"{root}/stg_trip_delay_events",
                        stg_trip_delay_events(trip_delay_events, loaded_at=False), TRIP_GRAIN, lookback)
    flags, flagged = _load(spark, f"{root}/stg_cascade_flags",
                           stg_cascade_flags(cascade_flags, loaded_at=False), FLAG_GRAIN, lookback)
    changed = _written(spark, late.union(flagged).distinct(), "changed")
    dates = [r[0] for r in changed.select("event_date").distinct().collect()]
    hours = f"{root}/int_route_delay_hourly"
    if table_state(spark, hours) is not None:
        trips_now, flags_now = (t.where(any_of("event_date", dates)).join(
            changed, ["route_id", "event_date"], "left_semi") for t in (trips, flags))
    else:
        trips_now, flags_now = trips, flags
    if dates or table_state(spark, hours) is None:
        upsert_table(spark, hours, route_delay_hourly(trips_now, flags_now, by_agency=by_agency), HOUR_GRAIN,
                     cluster_by=["route_id"])
        _refresh_reliability(spark, root, read_table(spark, hours), changed, options.get("frame", "rows"),
                             by_agency, options.get("null_score", "reference"))
    if stops is not None:
        write_table(hotspots_like(trips, stops, as_of), f"{root}/mart_delay_hotspots")
