"""Connected components of an edge table, by contraction.

In each round every vertex joins the neighbour (or itself) that comes first in
a hashed order of that round, edges become edges of the joined vertices, and
loops go.  The hashed order shrinks paths as well as stars by a constant
factor, so the rounds grow with the logarithm of the vertices.  Every round is
written as a table; only the number of edges left reaches the driver, and a
vertex with very many edges is a partial minimum and a splittable join.  The
last ``TAIL`` edges, a fixed number, are followed in one task: as rounds of
their own they would cost two jobs for every few edges.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import staged

#: Edges (each counted both ways) that one task follows to the end.
TAIL = 1024


def followed(edges: DataFrame) -> DataFrame:
    """(id, to): every vertex of at most ``TAIL`` edges and one vertex for all of
    its component, by union-find."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(batches):
        up, types = {}, None

        def top(x):
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        for b in batches:
            types = b.schema.types[0]
            for x, y in zip(*(c.to_pylist() for c in b.columns)):
                up[top(x)] = top(y)
        if up:
            ids = list(up)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, types), pa.array([top(x) for x in ids], types)], names=["id", "to"])

    return edges.select("a", "b").coalesce(1).mapInArrow(run, f"id {kind}, to {kind}")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, root) for every vertex of the edges (a, b): the component's smallest
    id.  Null ends and loops are ignored."""
    edges = edges.where("a <> b")
    left = staged(edges.select("a", "b").union(edges.select("b", "a")).distinct(), name)
    kind = left.schema["a"].dataType.simpleString()
    steps: list[DataFrame] = []
    while edges_left := left.count():
        if edges_left <= TAIL:
            steps.append(staged(followed(left), name))
            break
        seed = F.lit(len(steps))
        first = left.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", seed).alias("h"), "b")).alias("m"))
        own = F.struct(F.xxhash64("a", seed).alias("h"), F.col("a").alias("b"))
        step = staged(first.select(F.col("a").alias("id"), F.least("m", own)["b"].alias("to")), name)
        steps.append(step)
        ends = left.join(step.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
        ends = ends.join(step.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
        left = staged(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
                      name)
    if not steps:
        return left.sparkSession.createDataFrame([], f"id {kind}, root {kind}")
    joined = steps[-1]
    for step in reversed(steps[:-1]):
        later = joined.select(F.col("id").alias("to"), F.col("to").alias("last"))
        joined = step.join(later, "to", "left").select("id", F.coalesce("last", "to").alias("to"))
    joined = staged(joined, name)
    smallest = staged(joined.groupBy("to").agg(F.min("id").alias("least")), name)
    return joined.join(smallest, "to").select("id", F.least("least", "to").alias("root"))
