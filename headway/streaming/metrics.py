"""Counts and quality checks taken in flight: metrics that a micro-batch computes
while it is written (``df.observe``), turned into report rows by a listener.  The
rows are not read a second time."""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from headway.operators.quality import BOUNDS, RULES

COUNTS = "ingest_counts"
REPORT = "query_id string, batch_id long, at timestamp, observation string, metric string, value double"


def observe_counts(messages: DataFrame, topics: Sequence[str], agencies: Sequence[str],
                   name: str = COUNTS) -> DataFrame:
    """``messages`` (key ``agency:id``), unchanged, counting per topic and agency
    of the feed registry; a metric ``other`` counts what is of no listed pair, so
    that the metrics always add up to the rows."""
    agency = F.split(F.col("key").cast("string"), ":", 2).getItem(0)
    pairs = [(t, a) for t in topics for a in agencies]
    metrics = [F.count_if((F.col("topic") == t) & (agency == a)).alias(f"{t}|{a}") for t, a in pairs]
    listed = F.coalesce(F.col("topic").isin(*topics) & agency.isin(*agencies), F.lit(False))
    return messages.observe(name, *metrics, F.count_if(~listed).alias("other"))


def observe_quality(df: DataFrame, table: str, rules: dict | None = None) -> DataFrame:
    """``df``, unchanged, counting per micro-batch its rows, the nulls and the rows
    beyond the bounds that the table's rules name."""
    metrics: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for rule, limit in (RULES[table] if rules is None else rules).items():
        if rule.startswith("max_null_pct_"):
            metrics.append(F.count_if(F.col(rule[len("max_null_pct_"):]).isNull()).alias(rule))
        elif rule in BOUNDS:
            col, side = BOUNDS[rule]
            metrics.append(F.count_if(F.col(col) > limit if side == "max" else F.col(col) < limit).alias(rule))
    return df.observe(table, *metrics)


class BatchReport(StreamingQueryListener):
    """Collects the observed metrics of every micro-batch as ``REPORT`` rows, or
    hands each batch's rows to ``sink`` as they come (one small list per batch).
    A batch that is run again reports again under the same number: the newest
    rows of a batch count (see :func:`report_table`)."""

    def __init__(self, sink=None):
        self.rows: list[tuple] = []
        self.sink = sink or self.rows.extend
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        at = dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        rows = [(str(p.id), p.batchId, at, name, metric, None if value is None else float(value))
                for name, row in p.observedMetrics.items() for metric, value in row.asDict().items()]
        if rows:
            self.sink(rows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def wait(self, queries: Iterable, seconds: float = 60) -> None:
        """Wait until the listener has seen the end of stopped queries: a query's
        events come in order, so all its batches are reported by then."""
        for q in queries:
            if not self._end(q.runId).wait(seconds):
                raise TimeoutError("the query's last events did not arrive")


def report_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Report rows as a table, the newest per query, batch and metric."""
    df = spark.createDataFrame(rows, REPORT)
    keys = ["query_id", "batch_id", "observation", "metric"]
    return df.groupBy(*keys).agg(F.max("at").alias("at"), F.max_by("value", "at").alias("value"))


def published(report: DataFrame) -> DataFrame:
    """(topic, agency, published) from the report of :func:`observe_counts`."""
    pair = F.split("metric", r"\|", 2)
    return (report.where((F.col("observation") == COUNTS) & F.col("metric").contains("|"))
            .groupBy(pair.getItem(0).alias("topic"), pair.getItem(1).alias("agency"))
            .agg(F.sum("value").cast("long").alias("published")).where("published > 0"))


def quality_checks(report: DataFrame, rules: dict[str, dict] | None = None) -> DataFrame:
    """(table_name, check_name, observed, threshold, passed) over all batches of
    the report of :func:`observe_quality`: null shares and rows beyond bounds."""
    limits = [(t, c, float(x), c.startswith("max_null_pct_")) for t, own in (rules or RULES).items()
              for c, x in own.items() if c != "min_rows_per_hour"]
    limit = report.sparkSession.createDataFrame(
        limits, "table_name string, check_name string, threshold double, share boolean")
    total = report.groupBy(F.col("observation").alias("table_name"), "metric").agg(F.sum("value").alias("n"))
    rows = total.where("metric = 'rows'").select("table_name", F.col("n").alias("rows"))
    out = (total.withColumnRenamed("metric", "check_name").join(limit, ["table_name", "check_name"])
           .join(rows, "table_name"))
    observed = F.when(F.col("share"), F.col("n") / F.greatest("rows", F.lit(1.0))).otherwise(F.col("n"))
    passed = F.when(F.col("share"), observed <= F.col("threshold")).otherwise(observed == 0)
    return out.select("table_name", "check_name", observed.alias("observed"), "threshold", passed.alias("passed"))
