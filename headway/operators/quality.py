"""Data-quality checks as one aggregate pass per table -> a report DataFrame.

Rules (reference defaults; every declared rule is evaluated, including the
value bounds the reference declared but never checked):

  trip_delay_events  min_rows_per_hour 1000, max_null_pct_route_id 0.01,
                     max_delay_sec 7200 (on max_arrival_delay_sec)
  route_speed_agg    min_rows_per_hour 200, max_null_pct_route_id 0.0,
                     min_speed_mph -1.0 (on min_speed_mph)
  cascade_flags      min_rows_per_hour 50, max_cascade_score 100
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import as_of_ts

# Thresholds that must equal the reference's.
RULES = {
    "trip_delay_events": {
        "min_rows_per_hour": 1000,
        "max_null_pct_route_id": 0.01,
        "max_delay_sec": 7200,
    },
    "route_speed_agg": {
        "min_rows_per_hour": 200,
        "max_null_pct_route_id": 0.0,
        "min_speed_mph": -1.0,
    },
    "cascade_flags": {
        "min_rows_per_hour": 50,
        "max_cascade_score": 100,
    },
}

# Bound rule -> (column checked, direction).  "max" fails on values above
# the bound, "min" on values below it.
BOUNDS = {
    "max_delay_sec": ("max_arrival_delay_sec", "max"),
    "min_speed_mph": ("min_speed_mph", "min"),
    "max_cascade_score": ("cascade_score", "max"),
}

_ts = as_of_ts


def check_quality(df: DataFrame, table: str, rules: dict | None = None, as_of=None,
                  ts_col: str = "window_start") -> DataFrame:
    """Evaluate all rules of ``table`` in one aggregate pass.

    Returns rows (table_name, check_name, column_name, observed, threshold,
    passed).  ``observed`` is the recent row count, the null fraction
    (0 on an empty table), or the number of rows beyond a bound.
    """
    rules = RULES[table] if rules is None else rules
    aggs, checks = [], []
    for name, thr in rules.items():
        i = len(aggs)
        if name == "min_rows_per_hour":
            recent = F.col(ts_col) >= _ts(as_of) - F.expr("INTERVAL 1 HOUR")
            aggs.append(F.count_if(recent).cast("double").alias(f"_{i}"))
            checks.append((name, ts_col, float(thr), "ge"))
        elif name.startswith("max_null_pct_"):
            col = name[len("max_null_pct_"):]
            frac = F.count_if(F.col(col).isNull()) / F.greatest(F.count(F.lit(1)), F.lit(1))
            aggs.append(frac.cast("double").alias(f"_{i}"))
            checks.append((name, col, float(thr), "le"))
        elif name in BOUNDS:
            col, direction = BOUNDS[name]
            beyond = F.col(col) > thr if direction == "max" else F.col(col) < thr
            aggs.append(F.count_if(beyond).cast("double").alias(f"_{i}"))
            checks.append((name, col, float(thr), "zero"))
        else:
            raise ValueError(f"unknown quality rule {name!r}")
    one = df.agg(*aggs)
    parts = []
    for i, (name, col, thr, how) in enumerate(checks):
        obs = F.col(f"_{i}")
        passed = {"ge": obs >= thr, "le": obs <= thr, "zero": obs == 0}[how]
        parts.append(F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
                              F.lit(col).alias("column_name"), obs.alias("observed"),
                              F.lit(thr).alias("threshold"), passed.alias("passed")))
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def quality_report(tables: dict[str, DataFrame], as_of=None,
                   rules: dict[str, dict] | None = None) -> DataFrame:
    """All tables' checks in one report (one pass per table)."""
    rules = RULES if rules is None else rules
    out = None
    for name, df in tables.items():
        r = check_quality(df, name, rules.get(name, {}), as_of)
        out = r if out is None else out.unionByName(r)
    return out


def assert_quality(report: DataFrame) -> None:
    """Raise once with every failed check (the report is one row per check)."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        lines = [f"`{r.table_name}`.{r.check_name} on {r.column_name}: observed "
                 f"{r.observed:g}, threshold {r.threshold:g}" for r in failed]
        raise ValueError("Data quality failures:\n" + "\n".join(lines))


def check_freshness(df: DataFrame, as_of=None, ts_col: str = "last_write",
                    max_lag_hours: float = 2.0) -> DataFrame:
    """One row: newest ``ts_col``, lag in hours to ``as_of``, passed flag.
    Feed it :func:`headway.sinks.tables.table_last_write` or any table with
    a load/event timestamp."""
    last = df.agg(F.max(ts_col).alias("last_write"))
    lag = (F.unix_micros(_ts(as_of)) - F.unix_micros(F.col("last_write"))) / 3.6e9
    return last.select("last_write", lag.alias("lag_hours"),
                       F.coalesce(lag < max_lag_hours, F.lit(False)).alias("passed"))
