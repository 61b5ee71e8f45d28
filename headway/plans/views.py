"""Expose the layered models as SQL views under their dbt model names, so
existing SQL over those tables runs unchanged through ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.operators.hotspots import hotspots_like
from headway.operators.models import (
    route_delay_hourly,
    route_reliability,
    stg_cascade_flags,
    stg_trip_delay_events,
)

MODEL_VIEWS = ("stg_trip_delay_events", "stg_cascade_flags", "int_route_delay_hourly",
               "mart_route_reliability", "mart_delay_hotspots")


def register_models(spark: SparkSession, trip_delay_events: DataFrame,
                    cascade_flags: DataFrame, stops: DataFrame | None = None,
                    as_of=None, **options) -> dict[str, DataFrame]:
    """Build the five models from the streaming job's tables and register
    them (plus the inputs ``trip_delay_events``, ``cascade_flags`` and
    ``stops``) as temporary views.  ``options`` go to the model functions
    (``by_agency``, ``frame``, ``null_score``)."""
    by_agency = options.get("by_agency", False)
    stg_t = stg_trip_delay_events(trip_delay_events)
    stg_c = stg_cascade_flags(cascade_flags)
    hourly = route_delay_hourly(stg_t, stg_c, by_agency=by_agency)
    mart = route_reliability(hourly, frame=options.get("frame", "rows"), by_agency=by_agency,
                             null_score=options.get("null_score", "reference"))
    views = {"trip_delay_events": trip_delay_events, "cascade_flags": cascade_flags,
             "stg_trip_delay_events": stg_t, "stg_cascade_flags": stg_c,
             "int_route_delay_hourly": hourly, "mart_route_reliability": mart}
    if stops is not None:
        views["stops"] = stops
        views["mart_delay_hotspots"] = hotspots_like(stg_t, stops, as_of)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
