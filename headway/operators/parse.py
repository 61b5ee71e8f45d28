"""Topic envelope -> typed rows with event time (batch and streaming alike)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.functions.columns import event_time
from headway.functions.schemas import TRIP_UPDATE, VEHICLE_POSITION


def _decode(raw: DataFrame, schema, keep_broker_ts: bool,
            fields: Iterable[str] | None = None) -> DataFrame:
    # The boundary below also keeps Catalyst from pruning the schema, so a
    # caller that needs few fields names them and the rest isn't parsed.
    if fields is not None:
        wanted = {*fields, "timestamp"}
        schema = StructType([f for f in schema.fields if f.name in wanted])
    # Parse exactly once.  Filters that Catalyst infers downstream (non-null
    # event time from window(), non-empty list from explode()) would
    # otherwise be pushed below this projection with ``from_json`` inlined,
    # re-parsing every message once per predicate.  A one-element
    # ``explode_outer`` is a generator boundary that predicates on the parsed
    # fields cannot cross (and, being outer, infers no filter itself).
    cols = [F.explode_outer(F.array(F.from_json(F.col("value").cast("string"), schema)))
            .alias("d")]
    if keep_broker_ts:
        cols.append(F.col("timestamp").alias("kafka_ts"))
    out = raw.select(*cols).select("d.*", *(["kafka_ts"] if keep_broker_ts else []))
    # try_to_timestamp: bad text gives NULL instead of failing the query.
    return out.withColumn("event_ts", event_time("timestamp"))


def parse_vehicle_positions(raw: DataFrame, watermark: str | None = None,
                            fields: Iterable[str] | None = None) -> DataFrame:
    """Envelope -> 11 vehicle columns (or only ``fields``) + ``kafka_ts`` + ``event_ts``.

    Malformed JSON gives a row of NULLs (PERMISSIVE); its NULL event time
    never enters a window.
    """
    out = _decode(raw, VEHICLE_POSITION, keep_broker_ts=True, fields=fields)
    return out.withWatermark("event_ts", watermark) if watermark else out


def parse_trip_updates(raw: DataFrame, watermark: str | None = None,
                       fields: Iterable[str] | None = None) -> DataFrame:
    """Envelope -> trip update columns (nested stops; or only ``fields``) + ``event_ts``."""
    out = _decode(raw, TRIP_UPDATE, keep_broker_ts=False, fields=fields)
    return out.withWatermark("event_ts", watermark) if watermark else out


def dead_letters(raw: DataFrame, kind: str = "trip") -> DataFrame:
    """Envelope rows that parse to nothing usable: the value is not a JSON
    object of the schema, or its event time is missing or unparseable.
    The main path keeps the reference's behaviour (such rows never enter a
    window); this is the optional side output, with a reason column."""
    schema = TRIP_UPDATE if kind == "trip" else VEHICLE_POSITION
    text = F.col("value").cast("string")
    d = F.from_json(text, schema)
    ts = event_time(d.getField("timestamp"))
    # PERMISSIVE from_json yields a struct of NULLs for bad text; test the
    # text itself for JSON validity.
    reason = (F.when(d.isNull() | F.get_json_object(text, "$").isNull(), "not_json")
              .when(d.getField("timestamp").isNull(), "no_timestamp")
              .when(ts.isNull(), "bad_timestamp"))
    return raw.select("*", reason.alias("reason")).filter(F.col("reason").isNotNull())


def explode_stop_updates(trips: DataFrame, relationships: Iterable[str] | None = None,
                         ) -> DataFrame:
    """One row per stop update; trips with a NULL or empty list vanish.

    ``relationships``: optional filter on ``schedule_relationship`` (e.g.
    ``["SCHEDULED"]``); the reference keeps SKIPPED/NO_DATA stops.
    """
    out = trips.select(
        "trip_id", "route_id", "vehicle_id", "agency", "event_ts",
        F.explode("stop_time_updates").alias("stu"),
    ).select(
        "trip_id", "route_id", "vehicle_id", "agency", "event_ts",
        F.col("stu.stop_id").alias("stop_id"),
        F.col("stu.arrival_delay_sec").alias("arrival_delay_sec"),
        F.col("stu.departure_delay_sec").alias("departure_delay_sec"),
        F.col("stu.schedule_relationship").alias("schedule_relationship"),
    )
    if relationships is not None:
        out = out.filter(F.col("schedule_relationship").isin(list(relationships)))
    return out


def feed_entities(raw: DataFrame, fmt: str = "json", descriptor: str | None = None,
                  message_name: str = "transit_realtime.FeedMessage",
                  keep: Iterable[str] = ()) -> DataFrame:
    """Landed feed messages (column ``value``) -> one row per entity.

    ``fmt="json"`` decodes JSON FeedMessages with ``from_json``;
    ``fmt="protobuf"`` uses ``from_protobuf`` with a descriptor file, which
    needs the spark-protobuf package on the cluster (not installed where
    the tests run, so this branch is untested).  ``keep`` carries
    landing columns (e.g. ``agency``) onto every entity.
    """
    from headway.functions.schemas import FEED_MESSAGE

    if fmt == "json":
        msg = F.from_json(F.col("value").cast("string"), FEED_MESSAGE)
    elif fmt == "protobuf":
        from pyspark.sql.protobuf.functions import from_protobuf

        # Enums as their numbers: the normalising operators compare numbers.
        msg = from_protobuf(F.col("value"), message_name, descFilePath=descriptor,
                            options={"enums.as.ints": "true"})
    else:
        raise ValueError(f"unknown feed format {fmt!r}")
    keep = list(keep)
    return raw.select(*keep, F.explode(msg.entity).alias("e")).select(*keep, "e.*")
