"""Exact percentiles of a bounded-integer column through a value histogram.

``percentile()`` runs in an ObjectHashAggregate that falls back to sorting
the raw input rows once a task holds more than a few hundred groups.  For
a column with few distinct values per group (delays are integers inside the
sanity band), the histogram ``count(*) per (group, value)`` is an ordinary
partial hash aggregate that collapses the rows map-side; the percentile is
then read off the cumulative counts of each group's distinct values (a
window over at most a few thousand rows per group) with the interpolation
``percentile()`` itself uses:

    position = (n - 1) * p,  lo = floor(position),  hi = ceil(position)
    result   = v[lo]                                   if lo == hi
             = (hi - position) * v[lo] + (position - lo) * v[hi]   otherwise

where v[i] is the i-th smallest value (0-based).  NULL values are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, keys: Sequence[str], value: str, carry: Sequence[str] = ()) -> DataFrame:
    """``_c`` rows per (keys, value); ``carry`` are columns that follow from the
    value, so they add no groups."""
    return df.groupBy(*keys, value, *carry).agg(F.count(F.lit(1)).alias("_c"))


def from_histogram(hist: DataFrame, keys: Sequence[str], value: str, ps: dict[str, float],
                   measures: Sequence[Column]) -> DataFrame:
    """One row per group: ``measures`` (aggregates of the histogram, weighted by
    its ``_c``) and a double column per entry of ``ps`` (output name ->
    fraction).  NULL values take part in the measures only."""
    keys = list(keys)
    v = F.col(value)
    weight = F.when(v.isNotNull(), F.col("_c"))
    upto = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding,
                                                                Window.currentRow)
    hist = hist.withColumns({"_cum": F.sum(weight).over(upto),
                             "_n": F.sum(weight).over(Window.partitionBy(*keys))})
    ends = []
    for name, p in ps.items():
        pos = (F.col("_n") - 1) * p
        ends.append(F.min(F.when(F.col("_cum") > F.floor(pos), v)).alias(f"_{name}_lo"))
        ends.append(F.min(F.when(F.col("_cum") > F.ceil(pos), v)).alias(f"_{name}_hi"))
    g = hist.groupBy(*keys).agg(*measures, F.max("_n").alias("_n"), *ends)
    for name, p in ps.items():
        pos = (F.col("_n") - 1) * p
        lo_i, hi_i = F.floor(pos), F.ceil(pos)
        lo, hi = F.col(f"_{name}_lo").cast("double"), F.col(f"_{name}_hi").cast("double")
        g = g.withColumn(name, F.when(lo_i == hi_i, lo)
                         .otherwise((hi_i - pos) * lo + (pos - lo_i) * hi))
    return g.drop("_n", *[f"_{n}_{e}" for n in ps for e in ("lo", "hi")])


def weighted_count(cond: Column) -> Column:
    return F.sum(F.when(cond, F.col("_c")).otherwise(F.lit(0))).cast("long")


def weighted_mean(value: Column) -> Column:
    """Mean of an integer column over the histogram's rows (exact sums)."""
    return (F.sum(value.cast("long") * F.col("_c")).cast("double")
            / F.sum(F.when(value.isNotNull(), F.col("_c"))))


def weighted_stddev(value: Column) -> Column:
    """Sample standard deviation of an integer column: from exact sums, so
    nothing cancels; NULL for a single row."""
    v = value.cast("decimal(38,0)")
    n = F.sum(F.when(value.isNotNull(), F.col("_c"))).cast("decimal(38,0)")
    s1, s2 = F.sum((v * F.col("_c")).cast("decimal(28,0)")), F.sum((v * v * F.col("_c")).cast("decimal(28,0)"))
    spread = ((n * s2).cast("decimal(38,0)") - (s1 * s1).cast("decimal(38,0)")).cast("double")
    return F.when(n > 1, F.sqrt(spread / (n.cast("double") * (n.cast("double") - 1))))
