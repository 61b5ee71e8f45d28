"""Wire and table schemas (all fields nullable, as on the wire).

Fixed values: the names and types of ``VEHICLE_POSITION``, ``STOP_TIME_UPDATE``
and ``TRIP_UPDATE`` are the wire format and must match it.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

VEHICLE_POSITION = StructType([
    StructField("vehicle_id", StringType()),
    StructField("trip_id", StringType()),
    StructField("route_id", StringType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("bearing", DoubleType()),
    StructField("speed_mph", DoubleType()),
    StructField("current_stop", StringType()),
    StructField("stop_sequence", IntegerType()),
    StructField("timestamp", StringType()),
    StructField("agency", StringType()),
])

STOP_TIME_UPDATE = StructType([
    StructField("stop_id", StringType()),
    StructField("stop_sequence", IntegerType()),
    StructField("arrival_delay_sec", IntegerType()),
    StructField("departure_delay_sec", IntegerType()),
    StructField("schedule_relationship", StringType()),
])

TRIP_UPDATE = StructType([
    StructField("trip_id", StringType()),
    StructField("route_id", StringType()),
    StructField("vehicle_id", StringType()),
    StructField("start_date", StringType()),
    StructField("stop_time_updates", ArrayType(STOP_TIME_UPDATE)),
    StructField("timestamp", StringType()),
    StructField("agency", StringType()),
])

# Topic record envelope (the Kafka source's columns we use).
ENVELOPE = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("timestamp", TimestampType()),
])

# GTFS-realtime feed entity, decoded (JSON form of the protobuf message).
_TRIP_DESCRIPTOR = StructType([
    StructField("trip_id", StringType()),
    StructField("route_id", StringType()),
    StructField("start_date", StringType()),
])
_VEHICLE_DESCRIPTOR = StructType([StructField("id", StringType())])
_POSITION = StructType([
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("bearing", DoubleType()),
    StructField("speed", DoubleType()),
])
_STOP_EVENT = StructType([StructField("delay", IntegerType())])
_FEED_STOP_UPDATE = StructType([
    StructField("stop_id", StringType()),
    StructField("stop_sequence", IntegerType()),
    StructField("arrival", _STOP_EVENT),
    StructField("departure", _STOP_EVENT),
    StructField("schedule_relationship", IntegerType()),
])
FEED_ENTITY = StructType([
    StructField("id", StringType()),
    StructField("vehicle", StructType([
        StructField("vehicle", _VEHICLE_DESCRIPTOR),
        StructField("trip", _TRIP_DESCRIPTOR),
        StructField("position", _POSITION),
        StructField("stop_id", StringType()),
        StructField("current_stop_sequence", IntegerType()),
        StructField("timestamp", LongType()),
    ])),
    StructField("trip_update", StructType([
        StructField("trip", _TRIP_DESCRIPTOR),
        StructField("vehicle", _VEHICLE_DESCRIPTOR),
        StructField("stop_time_update", ArrayType(_FEED_STOP_UPDATE)),
        StructField("timestamp", LongType()),
    ])),
])
FEED_MESSAGE = StructType([
    StructField("header", StructType([
        StructField("gtfs_realtime_version", StringType()),
        StructField("timestamp", LongType()),
    ])),
    StructField("entity", ArrayType(FEED_ENTITY)),
])
