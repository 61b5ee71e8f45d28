"""Hard negatives by a threshold join over an inverted index with norm bounds.

For every anchor: its positives are the best rows of its own label, and for each
positive its negatives are the best rows of other labels whose score lies in a
window that the positive's score sets.  Scores are whole inner products.

Rows are dealt in blocks of bounded size, and every block answers for the anchors
that it is sent, in blocks as well.  Inside a block an index over groups of
dimensions is built for a threshold t.  A row is posted in a group only if its
norm over the dimensions up to the group's end, times the anchor's, can reach t:
the dimensions that are left out can't reach it alone, so a pair that meets in no
posting is below t.  Partial scores are added from the last group to the first; a
pair is given up as soon as its partial score and the norms that remain,
multiplied, stay below t.  To a pair that is left at the end, what the omitted
dimensions add makes the score whole.  The threshold begins high and is lowered for
the anchors whose windows aren't full yet, down to the window's lower end; a full
window raises it to its last score for the rows that follow.  So a block returns
its best rows and never a list of pairs.
The blocks' answers are merged by a ranking per anchor.

Rows with a null key, label or vector, or with a null or non-finite component, take
no part; of rows that share a key the smallest (label, vector) does.  Vectors of
different lengths never meet; empty ones score 0.  Components are scaled, rounded
down and kept within a long.  Ties go to the smaller key.  Only the named columns
are read, so other columns can't clash.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import staged

BLOCK_ROWS = 8192
#: Rows of a block that are searched at once; their best raise the thresholds for the next.
SEARCH_ROWS = 1024
GROUP = 8
#: Thresholds, as shares of the largest score that the norms allow.
LEVELS = (0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.0, -1.0)
EXACT = float(1 << 52)
LONG = (1 << 63) - 1
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")


class Block:
    """Rows of one length, indexed by groups of dimensions."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        floats = rows.astype(float)
        # Dimensions that hold most come last: the index is shortest then.
        self.order = np.argsort((floats ** 2).sum(0), kind="stable")
        self.x = floats[:, self.order]
        dims = rows.shape[1]
        self.cuts = list(range(0, dims, GROUP)) + [dims] if dims else [0]
        self.norm = self._norms(self.x)
        self.top = float(self.norm[:, -1].max()) if len(rows) else 0.0

    def _norms(self, x: np.ndarray) -> np.ndarray:
        """Norms over the dimensions before each cut."""
        total = np.concatenate((np.zeros((len(x), 1)), np.cumsum(x * x, axis=1)), axis=1)
        return np.sqrt(total[:, self.cuts])

    def index(self, share: float) -> tuple[list[np.ndarray], np.ndarray]:
        """The postings of each group of dimensions for thresholds of ``share`` of
        the largest score, and the rows' dimensions that no posting covers."""
        posted = [np.flatnonzero(self.norm[:, g + 1] >= share * self.top) for g in range(len(self.cuts) - 1)]
        rest = self.x.copy()
        for g, at in enumerate(posted):
            rest[at, self.cuts[g]:self.cuts[g + 1]] = 0
        return posted, rest

    def reach(self, index: tuple[list[np.ndarray], np.ndarray], anchors: np.ndarray,
              least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchors, rows, scores) of all pairs that score ``least`` or more, which
        is no less than the index was built for; sorted by anchor."""
        posted, left = index
        q = anchors.astype(float)[:, self.order]
        norm = self._norms(q)
        floor = least - 1e-9 * (norm[:, -1] * self.top + 1)
        part = np.zeros((len(q), len(self.x)))
        live = np.outer(norm[:, -1], self.norm[:, -1]) >= floor[:, None]
        who = row = None
        for g in range(len(posted) - 1, -1, -1):
            a, b = self.cuts[g], self.cuts[g + 1]
            if who is None:  # most pairs are still in: whole matrices
                at = posted[g] if len(posted[g]) < len(self.x) else slice(None)
                part[:, at] += q[:, a:b] @ self.x[at, a:b].T
                live[:, at] &= part[:, at] + np.outer(norm[:, g], self.norm[at, g]) >= floor[:, None]
                if np.count_nonzero(live) < live.size // 8:
                    who, row = np.nonzero(live)
                    part = part[who, row]
            else:  # few are left: one by one
                here = np.zeros(len(self.x), bool)
                here[posted[g]] = True
                here = here[row]
                part[here] += np.einsum("ij,ij->i", q[who[here], a:b], self.x[row[here], a:b])
                keep = ~here | (part + norm[who, g] * self.norm[row, g] >= floor[who])
                who, row, part = who[keep], row[keep], part[keep]
        if who is None:
            who, row = np.nonzero(live)
            part = part[who, row]
        if self.top * (norm[:, -1].max() if len(q) else 0) >= EXACT:
            return who, row, self._whole(row, anchors[who])
        return who, row, np.rint(part + np.einsum("ij,ij->i", left[row], q[who])).astype(np.int64)

    def _whole(self, at: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        """Scores too large for doubles, within a long."""
        exact = [sum(a * b for a, b in zip(x.tolist(), q.tolist(), strict=True))
                 for x, q in zip(self.rows[at], anchors, strict=True)]
        return np.array([max(-LONG, min(LONG, s)) for s in exact], np.int64)

    def search(self, anchors: np.ndarray, lowest: np.ndarray, highest: np.ndarray,
               take: Callable[[int, np.ndarray, np.ndarray], None]) -> None:
        """Lower the threshold of each anchor until it passes ``lowest``, which
        ``take(anchor, rows, scores)``, given all rows that reach the threshold,
        raises as windows fill.  Nothing above ``highest`` is of use."""
        norm = np.sqrt((anchors.astype(float) ** 2).sum(1))
        open_, step = np.flatnonzero(lowest <= highest), max(1, (1 << 18) // max(len(self.x), 1))
        for share in LEVELS:
            level = share * norm * self.top * (1 + 1e-9) - (share < 0)
            useful = open_[(level[open_] <= highest[open_]) | (lowest[open_] >= level[open_])]
            index = self.index(share) if len(useful) else None
            for lo in range(0, len(useful), step):
                who = useful[lo:lo + step]
                least = np.maximum(level[who], lowest[who])
                i, at, scores = self.reach(index, anchors[who], least)
                cuts = np.searchsorted(i, np.arange(len(who) + 1))
                for k in np.flatnonzero(np.diff(cuts)):
                    take(int(who[k]), at[cuts[k]:cuts[k + 1]], scores[cuts[k]:cuts[k + 1]])
            open_ = open_[lowest[open_] < level[open_]]
            if not len(open_):
                return


class Best:
    """The best rows found so far for one window of scores: ``n`` at most, ties by
    the smaller id.  ``need`` is the least score that can still get in."""

    def __init__(self, n: int, low: float = -np.inf, high: float = np.inf):
        self.n, self.low, self.high = n, low, high
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fits = (scores >= self.need) & (scores <= self.high)
        if fits.any():
            new = ~np.isin(ids[fits], self.ids)  # a lowered threshold gives rows again
            ids = np.concatenate((self.ids, ids[fits][new]))
            scores = np.concatenate((self.scores, scores[fits][new]))
            order = np.lexsort((ids, -scores))[:self.n]
            self.ids, self.scores = ids[order], scores[order]

    @property
    def need(self) -> float:
        if self.low > self.high:
            return np.inf
        return float(self.scores[-1]) if len(self.ids) == self.n else self.low


def search_all(rows: pa.Table, anchors: pa.Table, windows: list[list[Best]], same_label: bool, most: int) -> None:
    """Fill the anchors' windows from the rows, ``most`` rows at a time: what is
    found in earlier rows raises the thresholds for later ones."""
    ids, q = anchors.column("id").to_numpy(), _matrix(anchors.column("x"))
    labels = anchors.column("label").to_numpy()
    lowest = np.array([min(w.need for w in own) for own in windows])
    highest = np.array([max(w.high for w in own) for own in windows])
    for at in range(0, len(rows), most):
        block = _block(rows.slice(at, most))

        def take(i: int, found: np.ndarray, scores: np.ndarray) -> None:
            good = (block.labels[found] == labels[i]) == same_label
            good &= block.ids[found] != ids[i]
            found, scores = block.ids[found[good]], scores[good]
            for w in windows[i]:
                w.add(found, scores)
            lowest[i] = min(w.need for w in windows[i])

        block.search(q, lowest, highest, take)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.int64())
    return values.to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _block(rows: pa.Table) -> Block:
    return Block(rows.column("id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows.column("x")))


def _answer(out: list[tuple], names: list[str]) -> pa.Table:
    return pa.table([pa.array([r[k] for r in out], pa.int64()) for k in range(len(names))], names=names)


def _positives(n: int, most: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(rows) and len(anchors):
            windows = [[Best(n)] for _ in range(len(anchors))]
            search_all(rows, anchors, windows, True, most)
            out = [(i, p, s) for i, (w,) in zip(anchors.column("id").to_pylist(), windows, strict=True)
                   for p, s in zip(w.ids.tolist(), w.scores.tolist(), strict=True)]
        return _answer(out, ["anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(n: int, low: int, high: int, most: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(rows) and len(anchors):
            own = anchors.column("windows").to_pylist()
            # Window ends as whole scores: low * s <= 100 * x <= high * s.
            windows = [[Best(n, -(-low * w["positive_score"] // 100), high * w["positive_score"] // 100) for w in ws]
                       for ws in own]
            search_all(rows, anchors, windows, False, most)
            out = [(i, p["positive_id"], p["positive_score"], x, s)
                   for i, ps, ws in zip(anchors.column("id").to_pylist(), own, windows, strict=True)
                   for p, w in zip(ps, ws, strict=True)
                   for x, s in zip(w.ids.tolist(), w.scores.tolist(), strict=True)]
        return _answer(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    return run


def prepared(vectors: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, x, dim) of the rows that take part."""
    x = F.col("v")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                          F.col(vector).cast("array<double>").alias("v"))
    good = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & good)
    return rows.select("id", "label", F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("x"),
                       F.size(x).alias("dim"))


def once(rows: DataFrame) -> DataFrame:
    """One row per id.  Only ids that occur more than once are regrouped."""
    again = staged(rows.groupBy("id").count().where("count > 1").select("id"), "negatives-again")
    if again.isEmpty():
        return rows
    one = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "x", "dim")).alias("r"))
    return rows.join(again, "id", "left_anti").unionByName(one.select("id", "r.*"))


def hard_negatives(vectors: DataFrame, is_anchor: Callable[[Column], Column], key: str = "vec_id",
                   vector: str = "embedding", label: str = "label", positives: int = 5,
                   negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """Per anchor (rows whose key satisfies ``is_anchor``) and positive, the ranked
    negatives: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.  A negative's score is ``low`` to ``high`` percent of the
    positive's.  Keys and labels are whole numbers."""
    rows = once(prepared(vectors, key, vector, label, scale))
    anchors = staged(rows.where(is_anchor(F.col("id"))), "negatives-anchors")
    here = lambda n: F.pmod(F.xxhash64("id"), F.greatest(n, F.lit(1)))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK_ROWS)).cast("long")

    # Positives: blocks of one label and length, so only rows of the label meet.
    group = ["label", "dim"]
    sizes = rows.groupBy(*group).agg(blocks(F.count(F.lit(1))).alias("n")).join(
        anchors.groupBy(*group).agg(blocks(F.count(F.lit(1))).alias("m")), group)
    sizes = staged(sizes, "negatives-sizes")
    met = _meet(rows, anchors, sizes, group, here, ["id", "label", "x"], ["id", "label", "x"])
    found = met(_positives(positives, SEARCH_ROWS), "anchor_id long, positive_id long, positive_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    found = staged(found.withColumn("r", rank).where(F.col("r") <= positives).drop("r"), "negatives-positives")

    # Negatives: blocks of one length; anchors carry the windows of their positives.
    windows = found.groupBy(F.col("anchor_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("windows"))
    anchors = anchors.join(windows, "id")
    group = ["dim"]
    sizes = sizes.groupBy("dim").agg(F.lit(1).alias("any")).drop("any").join(
        rows.groupBy("dim").agg(blocks(F.count(F.lit(1))).alias("n")), "dim").join(
        anchors.groupBy("dim").agg(blocks(F.count(F.lit(1))).alias("m")), "dim")
    met = _meet(rows, anchors, staged(sizes, "negatives-sizes"), group, here, ["id", "label", "x"],
                ["id", "label", "x", "windows"])
    found = met(_negatives(negatives, low, high, SEARCH_ROWS), "anchor_id long, positive_id long, positive_score long, "
                "negative_id long, negative_score long")
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _meet(rows: DataFrame, anchors: DataFrame, sizes: DataFrame, group: list[str], here, left: list[str],
          right: list[str]):
    """Blocks of rows (``n`` per group) against blocks of anchors (``m``): a row
    goes to each anchor block, an anchor to each row block of its group."""
    keys = [*group, "row_block", "anchor_block"]
    own = [k for k in group if k not in left]
    a = rows.join(sizes, group).withColumn("row_block", here(F.col("n"))).withColumn(
        "anchor_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    b = anchors.join(sizes, group).withColumn("anchor_block", here(F.col("m"))).withColumn(
        "row_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    a = a.select(*left, *own, "row_block", "anchor_block")
    b = b.select(*right, *[k for k in group if k not in right], "row_block", "anchor_block")
    return lambda fn, schema: a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(fn, schema)
