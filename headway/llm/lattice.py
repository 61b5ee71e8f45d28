"""Near-duplicate vectors by lattice hashing.

In each of several tables a random projection takes a unit vector to two
blocks of eight numbers, and each block is decoded to its nearest E8 lattice
point: the two points are the vector's cell.  A vector is resident in its cell
and visits the neighbouring cells that lie closest (one block moved by the
lattice vector that points furthest along the rounding error).  A resident
meets the residents and visitors of its cell; every pair that meets is verified
by its cosine in double precision.

Equal vectors are one class, of which the smallest id goes on with the class's
size.  Cells without a pair are dropped before any vector is dealt.  A large
cell is dealt in blocks of bounded size; a block emits, per vector, how many
links it has found and the smallest id that it connects to, never its pairs.
A link that several cells find counts in the first of them only, which both
vectors' cells tell.

Vectors that are null, empty, zero or hold a null or a non-finite component are
linked with nothing; so are vectors of other lengths with one another.  Rows
that share an id are one vector when links are followed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm import bytesops, e8
from headway.llm.common import staged
from headway.llm.graph import components

BLOCKS = 2


def unit(values) -> np.ndarray | None:
    """The vector at length one; None where it has no direction."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    x = np.asarray(values, float)
    top = np.abs(x).max()
    if not np.isfinite(top) or top == 0:
        return None
    x = x / top + 0.0
    return x / np.sqrt(x @ x)


class Cells:
    """Cells of unit vectors: ``tables`` projections, ``visits`` neighbours each."""

    def __init__(self, tables: int, visits: int, width: float, seed: int = 1):
        self.tables, self.visits, self.width, self.seed = tables, visits, width, seed
        self.roots = e8.roots()
        self.planes: dict[int, list[np.ndarray]] = {}

    def _projections(self, dim: int) -> list[np.ndarray]:
        if dim not in self.planes:
            rng = np.random.default_rng([self.seed, dim])
            out = []
            for _ in range(self.tables):
                rows = []
                while sum(map(len, rows)) < 8 * BLOCKS:  # orthonormal as far as they go
                    rows.append(np.linalg.qr(rng.normal(size=(dim, min(dim, 8 * BLOCKS))))[0].T)
                out.append(np.concatenate(rows)[:8 * BLOCKS] * np.sqrt(dim / (8 * BLOCKS)) / self.width)
            self.planes[dim] = out
        return self.planes[dim]

    def _key(self, table: int, points: np.ndarray) -> np.ndarray:
        """A 64-bit name of each cell, from doubled (whole) coordinates."""
        with np.errstate(over="ignore"):
            c = bytesops.constants(8 * BLOCKS, 41 + table)
            total = (points.astype(np.int64).view(np.uint64) * c).sum(1, dtype=np.uint64)
            return bytesops.mix64(total + np.uint64(table)).view(np.int64)

    def of(self, x: np.ndarray) -> np.ndarray:
        """(n, tables, 1 + visits) cell names, the home first."""
        n = len(x)
        out = np.empty((n, self.tables, 1 + self.visits), np.int64)
        for t, plane in enumerate(self._projections(x.shape[1])):
            y = (x @ plane.T).reshape(n * BLOCKS, 8)
            c = e8.decode(y)
            gain = ((y - c) @ self.roots.T).reshape(n, -1)
            best = np.argsort(-gain, axis=1, kind="stable")[:, :self.visits]
            home = (2 * c).reshape(n, 8 * BLOCKS)
            out[:, t, 0] = self._key(t, home)
            for v in range(self.visits):
                block, move = best[:, v] // len(self.roots), best[:, v] % len(self.roots)
                there = home.copy().reshape(n, BLOCKS, 8)
                there[np.arange(n), block] += 2 * self.roots[move]
                out[:, t, 1 + v] = self._key(t, there.reshape(n, -1))
        return out


def _met(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether pairs meet in a table, from both sides' (pairs, 1 + visits)."""
    return (a == b[:, :1]).any(1) | (b == a[:, :1]).any(1)


def block_links(left: list[tuple], right: list[tuple], table: int, cell: int, threshold: float,
                shape: tuple) -> list[tuple[int, int, int]]:
    """(id, n, root) of one block: links first found in this cell, by vector and
    weighted by the classes' sizes, and the smallest id connected here.  The
    sides are lists of (id, size, unit vector, cells)."""
    if not left or not right:
        return []
    near = np.stack([r[2] for r in left]) @ np.stack([r[2] for r in right]).T >= threshold
    if not near.any():
        return []
    ids = [np.array([r[0] for r in side]) for side in (left, right)]
    x, y = np.nonzero(near & (ids[0][:, None] != ids[1][None, :]))
    if not len(x):
        return []
    cells = [np.stack([r[3] for r in side]).reshape(-1, *shape) for side in (left, right)]
    resident = cells[0][:, table, 0] == cell
    new = np.ones(len(x), bool)
    for t in range(table):
        new &= ~_met(cells[0][x, t], cells[1][y, t])
    # A visitor whose own cell the resident visits too: the smaller cell counts.
    home = cells[0][x, table, 0]
    mutual = ~resident[x] & (cells[1][y, table] == home[:, None]).any(1)
    new &= ~(mutual & (home < cell))
    size = [np.array([r[1] for r in side]) for side in (left, right)]
    names, place = np.unique(np.concatenate((ids[0][x], ids[1][y])), return_inverse=True)
    p, q = place[:len(x)], place[len(x):]
    count = np.zeros(len(names), np.int64)
    np.add.at(count, p[new], size[1][y[new]])
    once = new & ~resident[x]  # of two residents, each is once on the left
    np.add.at(count, q[once], size[0][x[once]])
    label = np.arange(len(names))
    while True:
        low = label.copy()
        least = np.minimum(label[p], label[q])
        np.minimum.at(low, p, least)
        np.minimum.at(low, q, least)
        low = low[low]
        if (low == label).all():
            break
        label = low
    return list(zip(names.tolist(), count.tolist(), names[label].tolist()))


def links_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                                      names=["id", "n", "root"])


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 threshold: float = 0.95, tables: int = 8, visits: int = 12, width: float = 0.5,
                 block: int = 256) -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    rows = vectors.select(F.col(key).cast("long").alias("id"),
                          F.col(vector).cast("array<double>").alias("vec"))
    cells = Cells(tables, visits, width)
    shape = (tables, 1 + visits)

    def digests(batches):
        for b in batches:
            marks = []
            for values in b.column(1).to_pylist():
                ok = unit(values) is not None
                marks.append(hashlib.blake2b((np.asarray(values, float) + 0.0).tobytes(),
                                             digest_size=16).digest() if ok else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(marks, pa.binary())],
                                             names=["id", "mark"])

    marked = staged(rows.mapInArrow(digests, "id bigint, mark binary"), "lattice-marks")
    reps = staged(marked.where("mark is not null and id is not null").groupBy("mark").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")), "lattice-classes")

    def homes(batches):
        for b in batches:
            ids, sizes = b.column(0).to_pylist(), b.column(2).to_pylist()
            units = [unit(v) for v in b.column(1).to_pylist()]
            for dim in sorted({len(u) for u in units}):
                at = [i for i, u in enumerate(units) if len(u) == dim]
                x = np.stack([units[i] for i in at])
                got = cells.of(x)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[i] for i in at], pa.int64()), pa.array([sizes[i] for i in at], pa.int64()),
                    pa.array([dim] * len(at), pa.int32()), pa.array(list(x), pa.list_(pa.float64())),
                    pa.array(list(got.reshape(len(at), -1)), pa.list_(pa.int64()))],
                    names=["id", "size", "dim", "vec", "cells"])

    # Rows that share an id and differ: the class decides which vector it is.
    chosen = (rows.join(reps.select(F.col("rep").alias("id"), "size").distinct(), "id")
              .where(F.col("vec").isNotNull() & (F.size("vec") > 0)
                     & ~F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
                     & F.exists("vec", lambda v: v != 0)).dropDuplicates(["id"]))
    found = staged(chosen.select("id", "vec", "size").mapInArrow(
        homes, "id bigint, size bigint, dim int, vec array<double>, cells array<bigint>"), "lattice-cells")

    filed = (found.select("id", "dim", F.posexplode("cells").alias("at", "cell"))
             .select("id", "dim", "cell", F.floor(F.col("at") / shape[1]).cast("int").alias("t"),
                     (F.col("at") % shape[1] == 0).cast("int").alias("home")))
    # Stored before it is joined back, so that a cell with very many vectors is
    # split among tasks.
    full = staged(
        filed.groupBy("t", "dim", "cell")
        .agg(F.sum("home").alias("residents"), F.count(F.lit(1)).alias("members"))
        .where("residents > 0 and members > 1")
        .select("t", "dim", "cell", F.ceil(F.col("residents") / block).cast("int").alias("cols"),
                F.ceil(F.col("members") / block).cast("int").alias("rows")), "lattice-full")
    placed = staged(filed.join(full, ["t", "dim", "cell"]), "lattice-members")
    row = F.pmod(F.xxhash64("id", F.lit(1)), F.col("rows")).cast("int")
    col = F.pmod(F.xxhash64("id", F.lit(2)), F.col("cols")).cast("int")
    where = ["t", "dim", "cell", "i", "j"]
    left = placed.select("id", "t", "dim", "cell", F.lit(0).alias("side"), row.alias("i"),
                         F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("j"))
    right = placed.where("home = 1").select(
        "id", "t", "dim", "cell", F.lit(1).alias("side"),
        F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), col.alias("j"))
    dealt = left.unionByName(right).join(found.drop("dim"), "id")

    def links(batches):
        """Blocks come one after the other, sorted; most are a few rows."""
        held, sides = None, ([], [])
        for b in batches:
            places = list(zip(*(b.column(k).to_pylist() for k in range(5))))
            side, ids, sizes = (b.column(k).to_pylist() for k in (5, 6, 7))
            lists = [(b.column(k).values.to_numpy(), b.column(k).offsets.to_numpy()) for k in (8, 9)]
            out = []
            for k, place in enumerate(places):
                if place != held:
                    if held is not None:
                        out += block_links(*sides, held[0], held[2], threshold, shape)
                    held, sides = place, ([], [])
                vec, cell = (data[at[k]:at[k + 1]].copy() for data, at in lists)
                sides[side[k]].append((ids[k], sizes[k], vec, cell))
            yield links_batch(out)
        if held is not None:
            yield links_batch(block_links(*sides, held[0], held[2], threshold, shape))

    counted = staged(dealt.select(*where, "side", "id", "size", "vec", "cells").repartition(*where)
                     .sortWithinPartitions(*where).mapInArrow(links, "id bigint, n bigint, root bigint"),
                     "lattice-links")
    degree = counted.groupBy("id").agg(F.sum("n").alias("n"))
    joined = components(counted.select(F.col("id").alias("a"), F.col("root").alias("b")).distinct(),
                        "lattice-components")
    classes = (reps.join(degree.withColumnRenamed("id", "rep"), "rep", "left")
               .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
               .select("mark", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                       F.coalesce("root", "rep").alias("root")))
    return (marked.join(classes, "mark", "left")
            .select("id", F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0)))
                    .cast("long").alias("n_links"),
                    F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))))
