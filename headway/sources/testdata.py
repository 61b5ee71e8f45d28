"""Derive transit feeds from the generated test tables (``events``, ``supplier``).

Integer-only, deterministic, and expressible in any SQL engine, so the same
rows can be rebuilt by the DuckDB oracle.  Fixed mapping:

  k                 integer props.k
  event time        ts as timestamp (UTC session), whole seconds on the wire
  trip_id           'T' + user_id left-padded to (at least) 4
  vehicle_id        'V' + user_id left-padded to (at least) 4
  route_id          event_type
  agency            even user_id -> 'wmata', odd -> 'mta'
  stop index i      1 .. (k mod 4); k mod 4 = 0 gives an empty stop list
  arrival delay     greatest(floor(value*3) - 200, -60) + 30*(i-1),
                    + 9000 when k = 99, - 500 when k = 98
  departure delay   arrival + 30
  stop_id           (k + i) left-padded to 3
  speed             value mph (sent as value / 2.237 m/s)
  latitude          38.9 + k/1000
  longitude         -77.0 - k/1000
  bearing           k * 36 / 10
  stops             stop_id = s_suppkey left-padded to 3, stop_name = s_name,
                    route_id = the five event types in alphabetical order
                    indexed by s_nationkey mod 5,
                    latitude 38.9 + s_nationkey/100, longitude -77.0 - s_nationkey/100
  as_of             2024-01-31 00:00:00 UTC
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
ROUTES = ("click", "error", "purchase", "signup", "view")


def pad(x, width: int):
    """Left-pad with zeros to at least ``width`` characters.  Plain ``lpad``
    truncates longer values, which would merge distinct ids once a table
    outgrows the width."""
    s = x.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transit_feed(events: DataFrame) -> DataFrame:
    """events -> GTFS-realtime feed entities (one entity with both a vehicle
    and a trip update per event) plus an ``agency`` landing column."""
    k = F.get_json_object("props", "$.k").cast("int")
    uid = F.col("user_id")
    ts = F.col("ts").cast("timestamp")
    trip_id = F.concat(F.lit("T"), pad(uid, 4))
    vehicle_id = F.concat(F.lit("V"), pad(uid, 4))
    base = F.greatest(F.floor(F.col("value") * 3).cast("int") - 200, F.lit(-60))
    bump = F.when(F.col("k") == 99, 9000).when(F.col("k") == 98, -500).otherwise(0)
    stop_list = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("k") % 4), lambda i: i > 0),
        lambda i: F.struct(
            pad(F.col("k") + i, 3).alias("stop_id"),
            i.alias("stop_sequence"),
            F.struct((F.col("base") + 30 * (i - 1) + F.col("bump")).alias("delay")).alias("arrival"),
            F.struct((F.col("base") + 30 * (i - 1) + F.col("bump") + 30).alias("delay"))
            .alias("departure"),
            F.lit(0).alias("schedule_relationship"),
        ),
    )
    trip = F.struct(
        F.col("trip_id").alias("trip_id"),
        F.col("event_type").alias("route_id"),
        F.date_format("event_ts", "yyyyMMdd").alias("start_date"),
    )
    return (
        events
        .select(
            "event_id", "user_id", "event_type", "value",
            k.alias("k"), ts.alias("event_ts"), trip_id.alias("trip_id"),
            vehicle_id.alias("vehicle_id"),
            F.when(uid % 2 == 0, "wmata").otherwise("mta").alias("agency"),
        )
        .withColumn("base", base)
        .withColumn("bump", bump)
        .select(
            "agency",
            F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("id"),
            F.struct(
                F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"),
                trip.alias("trip"),
                F.struct(
                    (F.lit(38.9) + F.col("k") / 1000).alias("latitude"),
                    (F.lit(-77.0) - F.col("k") / 1000).alias("longitude"),
                    (F.col("k") * 36 / 10).alias("bearing"),
                    (F.col("value") / 2.237).alias("speed"),
                ).alias("position"),
                pad(F.col("k"), 3).alias("stop_id"),
                (F.col("k") % 40 + 1).alias("current_stop_sequence"),
                F.unix_seconds("event_ts").alias("timestamp"),
            ).alias("vehicle"),
            F.struct(
                trip.alias("trip"),
                F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"),
                stop_list.alias("stop_time_update"),
                F.unix_seconds("event_ts").alias("timestamp"),
            ).alias("trip_update"),
        )
    )


def landed_feed(entities: DataFrame) -> DataFrame:
    """Feed entities -> landed JSON FeedMessages (column ``value``), one
    entity per message, with the ``agency`` landing column."""
    msg = F.struct(
        F.struct(F.lit("2.0").alias("gtfs_realtime_version"),
                 F.coalesce(F.col("vehicle.timestamp"), F.col("trip_update.timestamp"))
                 .alias("timestamp")).alias("header"),
        F.array(F.struct("id", "vehicle", "trip_update")).alias("entity"),
    )
    return entities.select("agency", F.to_json(msg).alias("value"))


def stops_table(supplier: DataFrame) -> DataFrame:
    """supplier -> static ``stops`` dimension."""
    idx = (F.col("s_nationkey") % 5).cast("int")
    route = F.element_at(F.array(*[F.lit(r) for r in ROUTES]), idx + 1)
    return supplier.select(
        pad(F.col("s_suppkey"), 3).alias("stop_id"),
        F.col("s_name").alias("stop_name"),
        (F.lit(38.9) + F.col("s_nationkey") / 100).alias("latitude"),
        (F.lit(-77.0) - F.col("s_nationkey") / 100).alias("longitude"),
        route.alias("route_id"),
    )


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def load_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transit_feed(load_events(spark, sf_dir))


def load_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stops_table(_table(spark, sf_dir, "supplier"))
