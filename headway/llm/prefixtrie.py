"""Prefix tries of conversations, as double arrays over shards of sorted prefixes.

A conversation is a sequence of turns, and a node is a distinct prefix.  A turn is
known by a digest of its role and text, so texts stay where they are read.
Sequences are dealt in ranges of their sorted order, so that a shard holds whole
subtrees, and only the prefixes of its first and last sequence that a neighbour has
too are shared.  Copies of one conversation are dealt over shards like any others.

In a shard the digests become dense turn ids, and a double array is packed over
them: the child of state s by turn t is BASE[s] + t, if CHECK there is s.  Every
sequence is traversed through the arrays, adding its conversations to the nodes it
passes; sums over subtrees follow from the nodes in reverse order.  A node that
several shards share is added up over them: a shard counts a node's own words and
its place among its parent's children only where the node comes first, and a leaf
only where it comes last, so that all of a node's figures are plain sums.  The one
figure that isn't, the digest of the ids of its ending conversations, is hashed from
the shards' joined ids in their order, as a stream.

Turns are ordered by ``turn`` (null first), equal ones by the digest.  A null role
or text is empty.  Rows without a conversation id belong to none and are left out.
Repeated rows are repeated turns.  Only the named columns are read, so other columns
can't clash.  A table without conversations has no nodes, not even a root.  A
conversation travels as one row of some 40 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import staged

SHARD_TURNS = 8192
#: Characters of a turn's digest.
WIDE = 32
WORD = r"[^\x20\x09-\x0D]+"
PART = ("shard int, shared boolean, node string, parent string, conv_id long, depth long, parent_conv_id long, "
        "n_convs long, n_children long, n_leaves long, saved_tokens long, turn string, ends string")


def turn_digest(role: Column, text: Column) -> Column:
    """Names a turn by its role and text: the first half of a SHA-256."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(whole.cast("binary"), 256), 1, WIDE)


def turns_of(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv, turn, digest, words) of every row that has a conversation."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    return conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"), F.col(turn).alias("turn"), turn_digest(by, said).alias("digest"),
        F.regexp_count(said, F.lit(WORD)).alias("words"))


def sequences(turns: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """(extra keys, conv, seq): each conversation's (digest, words) in order."""
    rows = F.sort_array(F.collect_list(F.struct("turn", "digest", "words")))
    return turns.groupBy(*extra_keys, "conv").agg(rows.alias("seq")).withColumn(
        "seq", F.transform("seq", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))))


class DoubleArray:
    """A trie of sorted sequences of turn ids (1 and up) in BASE and CHECK."""

    def __init__(self, seqs: list[np.ndarray]):
        self.base, self.check = [0, 0], [-1, 0]  # state 1 is the root, 0 is no state
        self.free, self.top = 2, 1
        todo = [(1, 0, len(seqs), 0)]
        while todo:
            state, lo, hi, depth = todo.pop()
            while lo < hi and len(seqs[lo]) == depth:  # ends here; sorted, so ahead of its extensions
                lo += 1
            if lo == hi:
                continue
            firsts, starts = [], []
            for i in range(lo, hi):
                t = int(seqs[i][depth])
                if not firsts or firsts[-1] != t:
                    firsts.append(t)
                    starts.append(i)
            self._place(state, firsts)
            for t, a, b in zip(firsts, starts, [*starts[1:], hi], strict=True):
                todo.append((self.base[state] + t, a, b, depth + 1))

    def _room(self, slot: int) -> None:
        while len(self.check) <= slot:
            self.base.append(0)
            self.check.append(-1)

    def _place(self, state: int, firsts: list[int], tries: int = 64) -> None:
        """Choose BASE so that all children fall on free slots: one of the first
        free slots for the smallest turn id, else behind all that is taken."""
        low = firsts[0]
        slot = self.free
        for _ in range(tries):
            while slot < len(self.check) and self.check[slot] >= 0:
                slot += 1
            if all(slot - low + t >= len(self.check) or self.check[slot - low + t] < 0 for t in firsts):
                break
            slot += 1
        else:
            slot = max(self.top + 1, self.free)
        self._room(slot - low + firsts[-1])
        self.base[state] = slot - low
        for t in firsts:
            self.check[slot - low + t] = state
        self.top = max(self.top, slot - low + firsts[-1])
        while self.free < len(self.check) and self.check[self.free] >= 0:
            self.free += 1

    def child(self, state: int, turn: int) -> int:
        """The state after a turn; 0 if there is none."""
        to = self.base[state] + turn
        return to if 1 < to < len(self.check) and self.check[to] == state else 0


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shard_nodes(rows: pa.Table, before: int, after: int) -> list[tuple]:
    """The nodes of one shard, as ``PART`` without the shard.  ``before`` and
    ``after``: how many turns its first and last sequence share with the
    neighbours (-1 without a neighbour)."""
    rows = rows.sort_by([("key", "ascending"), ("conv", "ascending")])
    keys, convs = rows.column("key").to_pylist(), rows.column("conv").to_pylist()
    heads = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
    tails = [*heads[1:], len(keys)]
    texts = [keys[i] for i in heads]
    flat = np.frombuffer("".join(texts).encode(), f"S{WIDE}")
    names, ids = np.unique(flat, return_inverse=True)
    cuts = np.concatenate(([0], np.cumsum([len(t) // WIDE for t in texts])))
    seqs = [ids[a:b] + 1 for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    words_of = rows.column("words")
    trie = DoubleArray(seqs)

    order, place = [1], {1: 0}  # states as they are first passed, parents first
    depth, turn, weight, n, least, ends = [0], [0], [0], [0], [None], {}
    for k, seq in enumerate(seqs):
        own = convs[heads[k]:tails[k]]
        low, many, words, state = min(own), len(own), words_of[heads[k]].as_py(), 1
        path = [0]
        for d, t in enumerate(seq.tolist()):
            state = trie.child(state, t)
            at = place.get(state)
            if at is None:
                at = place[state] = len(order)
                order.append(state)
                depth.append(d + 1)
                turn.append(t)
                weight.append(words[d])
                n.append(0)
                least.append(None)
            path.append(at)
        for at in path:
            n[at] += many
            least[at] = low if least[at] is None else min(least[at], low)
        ends[path[-1]] = ",".join(map(str, own))
        if not k:
            first = path
    last = path
    again, later = set(first[:before + 1]), set(last[:after + 1])
    shared = again | later
    up = [0] + [place[trie.check[s]] for s in order[1:]]
    children, born = [0] * len(order), [0] * len(order)
    leaves, saved = [0] * len(order), [0] * len(order)
    for at in range(len(order) - 1, -1, -1):
        leaves[at] += not children[at] and at not in later
        saved[at] += weight[at] * (n[at] - (at not in again))
        if at:
            children[up[at]] += 1
            born[up[at]] += at not in again
            leaves[up[at]] += leaves[at]
            saved[up[at]] += saved[at]
    name = {at: _hash(text[:WIDE * depth[at]]) for text, way in ((texts[0], first), (texts[-1], last))
            for at in way if at in shared}
    out = []
    for at in range(len(order)):
        joined = ends.get(at)
        own = at in shared
        out.append((own, name.get(at), name.get(up[at]) if at else None, least[at], depth[at],
                    least[up[at]] if at else None, n[at], born[at], leaves[at], saved[at],
                    names[turn[at] - 1].decode() if at else None,
                    joined if own else hashlib.sha256((joined or "").encode()).hexdigest()))
    return out


def _shard(key: tuple, rows: pa.Table, bounds: pa.Table) -> pa.Table:
    shard = key[0].as_py()
    before, after = (bounds.column(c)[0].as_py() for c in ("before", "after"))
    found = shard_nodes(rows, before, after)
    columns = [[shard] * len(found), *map(list, zip(*found, strict=True))]
    kinds = [pa.int32(), pa.bool_(), pa.string(), pa.string(), *[pa.int64()] * 7, pa.string(), pa.string()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=[f.split(" ")[0] for f in PART.split(", ")])


def _stream_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends) of rows (node, ends) that come sorted: the SHA-256 of each
    node's texts, joined by commas, holding none but the current one."""
    node, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends"])

    for batch in batches:
        for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if own != node:
                if state is not None:
                    yield done()
                node, state = own, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if state is not None:
        yield done()


def _common(a: Column, b: Column) -> Column:
    """How many turns two keys share from the start; -1 if one is null."""
    most = (F.least(F.length(a), F.length(b)) / WIDE).cast("int")
    steps = F.filter(F.sequence(F.lit(0), most), lambda d: F.substr(a, F.lit(1), d * WIDE) == F.substr(b, F.lit(1), d * WIDE))
    return F.coalesce(F.array_max(steps), F.lit(-1))


def prefix_nodes(seqs: DataFrame, turns: int) -> DataFrame:
    """The nodes of sequences (conv, seq of digest and words): conv_id (the smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 and ``turn``, the digest of the node's last turn.  ``turns``, the
    number of turns, sets the number of shards."""
    shards = max(1, -(-turns // SHARD_TURNS))
    rows = seqs.select("conv", F.array_join(F.transform("seq", lambda t: t["digest"]), "").alias("key"),
                       F.transform("seq", lambda t: t["words"]).alias("words"))
    rows = rows.repartitionByRange(shards, "key", "conv").sortWithinPartitions("key", "conv")
    rows = staged(rows.withColumn("shard", F.spark_partition_id()), "trie-shards")

    # One row per shard: what its ends share with the neighbours.
    ends = rows.groupBy("shard").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    line = Window.orderBy("shard")
    bounds = ends.select("shard", _common(F.lag("high").over(line), F.col("low")).alias("before"),
                         _common(F.col("high"), F.lead("low").over(line)).alias("after"))
    bounds = staged(bounds, "trie-bounds")
    parts = staged(rows.groupBy("shard").cogroup(bounds.groupBy("shard")).applyInArrow(_shard, PART), "trie-parts")

    shared = parts.where("shared")
    hashes = shared.where("ends is not null").repartition("node").sortWithinPartitions("node", "shard")
    hashes = hashes.select("node", "ends").mapInArrow(_stream_hash, "node string, ends string")
    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = shared.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), *total,
                                        F.min("parent").alias("parent"), F.min("turn").alias("turn"))
    merged = staged(merged.join(hashes, "node", "left"), "trie-shared")
    least = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    tops = merged.join(least, "parent", "left")
    tops = tops.withColumn("ends", F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)))

    # Below a shared node the parent's id is that of all shards; the join is by
    # shard as well, so that a parent with very many children is no hot key.
    known = shared.select("shard", F.col("node").alias("parent")).join(least, "parent")
    low = parts.where("not shared")
    below = low.where("parent is not null").drop("parent_conv_id").join(known, ["shard", "parent"])
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           F.col("ends").alias("ends_sha256"), "turn"]
    return low.where("parent is null").select(*out).unionByName(below.select(*out)).unionByName(tops.select(*out))


def rebuilt(conversations: DataFrame, key: str = "conv_id", every: int = 20, heads: int = 4, **names) -> DataFrame:
    """Sequences in which each conversation c begins like conversation c - c % every:
    the first h of its turns, then c's own after its first h, h = crc32(c) % heads.
    Both are dealt by that conversation's id, of which there are ``every`` at most
    to a group."""
    turns = turns_of(conversations, key, **names).withColumn("base", F.col("conv") - F.col("conv") % every)
    seqs = sequences(turns.repartition("base"), ("base",))
    head = F.max(F.when(F.col("conv") == F.col("base"), F.slice("seq", 1, heads - 1))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int")
    begin = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), F.col("h")))
    rest = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq") - F.col("h"), F.lit(0)))
    none = F.slice("seq", 1, 0)
    return seqs.select("conv", "seq", head.alias("head"), h.alias("h")).select(
        "conv", F.concat(F.coalesce(begin, none), rest).alias("seq"))
