"""Running results on streams that need state of their own kind.

* :func:`running_cascades`: counts of a cascade window while it is still open.
* :func:`running_totals`: messages so far per topic, kept across restarts.

Both are ``transformWithState`` operators, so the query needs the RocksDB state
store (``spark.sql.streaming.stateStore.providerClass``; see :func:`rocksdb`).
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from headway.functions.columns import cascade_score
from headway.functions.thresholds import DEFAULT, TRIP_WINDOW, Thresholds

# The processors travel with their code: the process that Spark starts for them
# need not find this package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession):
    """The RocksDB state store for queries started inside; the caller's own
    setting comes back afterwards (a query keeps what it was started with)."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class TripCounts(StatefulProcessor):
    """A route's windows that start in one stretch of time: each trip's largest
    delay per window, as one state value, since a call to the state store costs
    more than a merge of some thousand trips.  A timer at the end of the stretch's
    last window gives the last rows and drops the state, so state is bounded by
    the trips of the stretches that are open."""

    SCHEMA = "starts array<long>, trips array<string>, delays array<int>"

    def __init__(self, late_from: int, size: int, slide: int, stretch: int):
        """Widths in milliseconds."""
        self.late_from, self.size, self.slide, self.stretch = late_from, size, slide, stretch
        self.last_ms = stretch + size - slide  # from a stretch's start to the end of its last window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.worst = handle.getValueState("worst", self.SCHEMA)

    def _counts(self, key: tuple, windows: dict, which: Iterable[int], closed: bool) -> Iterator[Row]:
        for start in which:
            delays = windows[start].values()
            late = sum(d is not None and d >= self.late_from for d in delays)
            yield Row(route_id=key[0], agency=key[1], start_ms=start, trips=len(delays), late=late, is_final=closed)

    def _stored(self) -> dict[int, dict[str, int | None]]:
        windows: dict[int, dict[str, int | None]] = {}
        for start, trip, delay in zip(*(self.worst.get() or ((), (), ())), strict=True):
            windows.setdefault(start, {})[trip] = delay
        return windows

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        windows, touched = self._stored(), {}
        known = bool(windows)
        for r in rows:
            trip, delay = r.trip, r.delay
            for start in range(r.first_ms, r.last_ms + 1, self.slide):
                if not key[2] <= start < key[2] + self.stretch:
                    continue  # a window of the next stretch's group, or of the one before
                if start + self.size <= mark:
                    continue  # late for a window that is closed
                trips = windows.setdefault(start, {})
                was = trips.get(trip)
                # A trip without any delay keeps a null, as a maximum does.
                trips[trip] = was if delay is None else delay if was is None else max(was, delay)
                touched[start] = True
        if not touched:
            return
        flat = [(s, t, d) for s, trips in windows.items() for t, d in trips.items()]
        self.worst.update(tuple(map(list, zip(*flat, strict=True))))
        if not known:
            self.handle.registerTimer(key[2] + self.last_ms)
        yield from self._counts(key, windows, touched, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        windows = self._stored()
        self.worst.clear()
        yield from self._counts(key, windows, windows, True)

    def close(self) -> None:
        pass


def _millis(interval: str) -> int:
    return int(pd.Timedelta(interval).total_seconds() * 1000)


def running_cascades(stops: DataFrame, size: str = TRIP_WINDOW[0], slide: str = TRIP_WINDOW[1],
                     th: Thresholds = DEFAULT, stretch: str = "1 hour") -> DataFrame:
    """Streaming stop rows (with a watermark on ``event_ts``) -> cascade counts of
    every window that a micro-batch changes, at once, and last rows (``is_final``)
    when the watermark passes.  Run it in update mode.  The newest row per window,
    route and agency is that of :func:`~headway.operators.aggregates.cascade_flags`.

    A group is a route's windows that start in one ``stretch`` of time, so a busy
    route is several groups; take a shorter stretch where an hour of a route's
    trips is more than a state value should hold.
    """
    width, step, long = _millis(size), _millis(slide), _millis(stretch)
    trip = F.to_json(F.array("trip_id", "vehicle_id")).alias("trip")
    # A row goes to the processor once per stretch, with its first and last window:
    # once per window would be five times the rows.
    time = F.unix_millis("event_ts")
    last = time - F.pmod(time, F.lit(step))
    first = last - F.floor((F.lit(width - 1) - (time - last)) / step) * step
    rows = stops.select("event_ts", "route_id", "agency", trip, F.col("arrival_delay_sec").alias("delay"),
                        first.cast("long").alias("first_ms"), last.cast("long").alias("last_ms"))
    begin = lambda c: F.col(c) - F.pmod(F.col(c), F.lit(long))
    spans = F.sequence(begin("first_ms"), begin("last_ms"), F.lit(long))
    rows = rows.select("*", F.explode(spans).alias("stretch_ms"))
    counts = rows.groupBy("route_id", "agency", "stretch_ms").transformWithState(
        TripCounts(th.cascade_sec, width, step, long),
        outputStructType="route_id string, agency string, start_ms long, trips long, late long, is_final boolean",
        outputMode="Update", timeMode="EventTime")
    share = F.col("late") / F.col("trips")
    return counts.select(F.timestamp_millis("start_ms").alias("window_start"), "route_id", "agency",
                         F.col("trips").alias("total_trips"), F.col("late").alias("delayed_trips"),
                         share.alias("delayed_pct"), (share >= th.cascade_share).alias("is_cascade"),
                         cascade_score(share, "trips").alias("cascade_score"), "is_final")


class TopicTotal(StatefulProcessor):
    """One topic's messages so far; its rows are closed windows."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Windows close in the order of their starts, a few per micro-batch.
        part = pd.concat(rows).sort_values("start_us")
        total = self.total.get()[0] if self.total.exists() else 0
        part = part.assign(topic=key[0], total_messages=part["messages"].cumsum() + total)
        self.total.update((int(part["total_messages"].iloc[-1]),))
        yield part[["topic", "start_us", "messages", "total_messages"]]

    def close(self) -> None:
        pass


def running_totals(throughput: DataFrame) -> DataFrame:
    """Streaming :func:`~headway.operators.dashboard.ingest_throughput` rows with
    the running total per topic, one row per closed window (append mode).  The
    total is state, so it goes on after a restart from the checkpoint.  A topic's
    group holds the windows that one micro-batch closes, never its messages."""
    rows = throughput.select("topic", F.unix_micros("window_start").alias("start_us"), "messages")
    out = rows.groupBy("topic").transformWithStateInPandas(
        TopicTotal(), outputStructType="topic string, start_us long, messages long, total_messages long",
        outputMode="Append", timeMode="None")
    return out.select(F.timestamp_micros("start_us").alias("window_start"), "topic", "messages", "total_messages")
