"""Feed entities -> flat vehicle / trip rows -> topic messages.

The producer's per-entity Python loop becomes column expressions over a
DataFrame of decoded feed entities, so it runs on every executor and keeps
whole-stage codegen.  Nested stop updates are mapped with ``transform``
(no explode/regroup shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import iso_utc, mph_from_ms
from headway.functions.thresholds import (
    DEFAULT,
    SCHEDULE_RELATIONSHIP,
    TOPIC_TRIP_UPDATES,
    TOPIC_VEHICLE_POSITIONS,
    Thresholds,
)


def _agency(agency) -> Column:
    return agency if isinstance(agency, Column) else F.lit(agency)


def _enum_name(x: Column) -> Column:
    out = None
    for num, name in SCHEDULE_RELATIONSHIP.items():
        out = F.when(x == num, name) if out is None else out.when(x == num, name)
    # Unset enum reads as its zero value, as protobuf does.
    return out.when(x.isNull(), SCHEDULE_RELATIONSHIP[0])


def normalize_vehicle_positions(entities: DataFrame, agency="unknown",
                                th: Thresholds = DEFAULT) -> DataFrame:
    """Entities having ``vehicle`` -> the 11-column vehicle position row.

    ``agency`` is a literal or a Column (e.g. a column of the landed feed).
    The vehicle id falls back to the entity id when missing or empty.
    """
    v = F.col("vehicle")
    return entities.filter(v.isNotNull()).select(
        F.coalesce(F.nullif(v.vehicle.id, F.lit("")), F.col("id")).alias("vehicle_id"),
        v.trip.trip_id.alias("trip_id"),
        v.trip.route_id.alias("route_id"),
        v.position.latitude.alias("latitude"),
        v.position.longitude.alias("longitude"),
        v.position.bearing.alias("bearing"),
        mph_from_ms(v.position.speed, th).alias("speed_mph"),
        v.stop_id.alias("current_stop"),
        v.current_stop_sequence.alias("stop_sequence"),
        iso_utc(F.timestamp_seconds(F.coalesce(v.timestamp, F.lit(0)))).alias("timestamp"),
        _agency(agency).alias("agency"),
    )


def normalize_trip_updates(entities: DataFrame, agency="unknown") -> DataFrame:
    """Entities having ``trip_update`` -> trip update rows with nested stops.

    Missing arrival/departure delays read as 0; the enum number becomes its
    name; an absent vehicle reads ``UNKNOWN``.
    """
    tu = F.col("trip_update")
    stops = F.transform(
        tu.stop_time_update,
        lambda s: F.struct(
            s.stop_id.alias("stop_id"),
            s.stop_sequence.alias("stop_sequence"),
            F.coalesce(s.arrival.delay, F.lit(0)).alias("arrival_delay_sec"),
            F.coalesce(s.departure.delay, F.lit(0)).alias("departure_delay_sec"),
            _enum_name(s.schedule_relationship).alias("schedule_relationship"),
        ),
    )
    return entities.filter(tu.isNotNull()).select(
        tu.trip.trip_id.alias("trip_id"),
        tu.trip.route_id.alias("route_id"),
        F.when(tu.vehicle.isNotNull(), F.coalesce(tu.vehicle.id, F.lit("")))
        .otherwise(F.lit("UNKNOWN")).alias("vehicle_id"),
        tu.trip.start_date.alias("start_date"),
        F.coalesce(stops, F.array()).alias("stop_time_updates"),
        iso_utc(F.timestamp_seconds(F.coalesce(tu.timestamp, F.lit(0)))).alias("timestamp"),
        _agency(agency).alias("agency"),
    )


def to_topic_messages(rows: DataFrame, id_col: str, topic: str) -> DataFrame:
    """Rows -> topic envelope ``key, value, topic, timestamp``.

    key = ``agency:id``; value = the whole row as UTF-8 JSON, nulls kept;
    timestamp = the row's event time (a broker would stamp append time).
    """
    return rows.select(
        F.concat_ws(":", F.col("agency"), F.col(id_col)).cast("binary").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in rows.columns]),
                  {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.try_to_timestamp(F.col("timestamp")).alias("timestamp"),
    )


def vehicle_messages(positions: DataFrame) -> DataFrame:
    return to_topic_messages(positions, "vehicle_id", TOPIC_VEHICLE_POSITIONS)


def trip_messages(trips: DataFrame) -> DataFrame:
    return to_topic_messages(trips, "trip_id", TOPIC_TRIP_UPDATES)


def write_topic(messages: DataFrame, topic: str | None = None, *, sink: str = "kafka",
                options: dict | None = None, path: str | None = None) -> None:
    """Publish envelope rows in batch: to Kafka (``options`` carry
    ``kafka.bootstrap.servers``; the value/key columns are written as is),
    or, offline, appended as envelope files at ``path``."""
    opts = dict(options or {})
    if sink == "kafka":
        if topic:
            opts.setdefault("topic", topic)
        messages.select("key", "value").write.format("kafka").options(**opts).save()
        return
    if path is None:
        raise ValueError("a file sink needs a path")
    messages.write.mode("append").format(sink).options(**opts).save(path)


def feed_registry(spark, feeds: dict[str, list[str]] | None = None) -> DataFrame:
    """The agencies and feed kinds to ingest, as data (one row per pair).
    Endpoints and keys belong to the deployment, not to the library."""
    feeds = feeds or {"wmata": ["vehicle_positions", "trip_updates"],
                      "mta": ["vehicle_positions", "trip_updates"]}
    rows = [(a, f) for a, kinds in feeds.items() for f in kinds]
    return spark.createDataFrame(rows, "agency string, feed string")


def ingest_counts(messages: DataFrame) -> DataFrame:
    """Published messages per (topic, agency); one aggregate pass."""
    agency = F.split(F.col("key").cast("string"), ":", 2).getItem(0)
    return (messages.select(F.col("topic"), agency.alias("agency"))
            .groupBy("topic", "agency").agg(F.count(F.lit(1)).alias("published")))
