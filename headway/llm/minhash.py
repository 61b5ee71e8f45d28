"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

A text is the set of its distinct runs of ``width`` words.  Its signature has
32 symbols of 16 bits, one per hash order (b-bit MinHash), in eight chunks of
four.  Two signatures that differ in at most 15 symbols have, by the
pigeonhole principle, a chunk that differs in at most one; so each signature is
filed under every chunk with each one of its symbols left out (32 keys), and
any such pair meets under an equal key.  At a similarity of 0.8 a pair differs
in 6.4 symbols on average, and fails to meet with a chance of about one in a
million.

Texts with equal sets are one class; only its smallest id goes on.  Links are
confirmed on full sets in two steps that never list the pairs of a group:

1. per key, every member against one member (the first in a hashed order);
   confirmed links make components;
2. keys whose members lie in several components.  Members of whose shingles too
   many (for 80 %, over a fifth) occur in no other such text are left out: they
   have no link.  While a key has more members outside its first one's component
   than a block holds, its members are tested against a few others of other
   components (hashed anew in each round) and components join; rounds go on as
   long as each takes away a quarter of the blocks that are left.  Then all
   members outside the first one's component meet all members, in blocks of
   bounded size, inside which intersections are counted by matrix products;
   only links between components leave a block.

So every pair that meets is either tested or already connected.

Null and empty texts and texts without words have no shingles and are linked
with nothing.  Rows that share an id are one document when links are followed;
each keeps its own number of shingles.  Rows with a null id keep it and are
linked with nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm import bytesops
from headway.llm.common import staged
from headway.llm.graph import components

CHUNKS, SYMBOLS = 8, 4
SIGNATURE = [f"s{i}" for i in range(CHUNKS)]
SETTLED = np.uint64(0x2545F4914F6CDD1D)
#: Shingles that take as much of a block as a member itself does.
MEMBER_WEIGHT = 512
#: Members of a crowded key that the others are tested against in one round.
PIVOTS = 4


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int,
                 powers: bytesops.Powers) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    h, many = bytesops.text_shingles(data, offsets, width, powers)
    bounds = np.concatenate(([0], np.cumsum(many)))
    return [np.unique(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def signature(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """((CHUNKS, n) chunks of four 16-bit symbols, (2, n) set hashes); zero for
    empty sets."""
    n = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    full = np.flatnonzero(size)
    chunks, marks = np.zeros((CHUNKS, n), np.uint64), np.zeros((2, n), np.uint64)
    if not len(full):
        return chunks, marks
    h = np.concatenate([sets[i] for i in full])
    first = np.cumsum(size[full]) - size[full]
    shift, factor = bytesops.constants(32, 5), bytesops.constants(32, 6)
    with np.errstate(over="ignore"):
        for k in range(CHUNKS * SYMBOLS):
            least = np.minimum.reduceat((h ^ shift[k]) * factor[k], first)
            symbol = (least * SETTLED) >> np.uint64(48)
            chunks[k // SYMBOLS, full] |= symbol << np.uint64(16 * (k % SYMBOLS))
        for k in (0, 1):
            marks[k, full] = np.add.reduceat(bytesops.mix64(h + bytesops.constants(2, 8)[k]), first)
    return chunks, marks


def signatures(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(id, n, h1, h2, s0..s7) per row: the set's size, hash and signature."""

    def run(batches):
        powers = bytesops.Powers()
        for b in batches:
            data, offsets = bytesops.flat(b.column(1))
            for i, j in bytesops.blocks(offsets):
                sets = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i],
                                    width, powers)
                chunks, marks = signature(sets)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([len(x) for x in sets], pa.int64()),
                     *(pa.array(x.view(np.int64)) for x in (*marks, *chunks))], names=names)

    names = ["id", "n", "h1", "h2", *SIGNATURE]
    return docs.select(F.col(key).cast("long").alias("id"), F.col(text)).mapInArrow(
        run, ", ".join(f"{n} bigint" for n in names))


def filed(reps: DataFrame, *carry: str) -> DataFrame:
    """One row per signature and key: (tag, part, carried columns); the tag names
    the chunk and the symbol that is left out."""
    keys = [F.struct(F.lit(SYMBOLS * c + m).alias("tag"),
                     F.col(s).bitwiseAND(F.lit(~(0xFFFF << (16 * m)) if m < 3 else 0xFFFFFFFFFFFF)).alias("part"))
            for c, s in enumerate(SIGNATURE) for m in range(SYMBOLS)]
    return reps.select(*carry, F.explode(F.array(*keys)).alias("k")).select("k.tag", "k.part", *carry)


def _similar_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def block_links(left: list[tuple], right: list[tuple], percent: int,
                columns: int = 4096) -> set[tuple[int, int]]:
    """Linked pairs of components (a smaller than b) between a block's sides,
    lists of (component, sorted set)."""
    if len(left) * len(right) <= 64:
        found = set()
        for c, x in left:
            for d, y in right:
                if c != d and min(len(x), len(y)) * 100 >= max(len(x), len(y)) * percent:
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * shared >= percent * (len(x) + len(y) - shared):
                        found.add((min(c, d), max(c, d)))
        return found
    sides = [[x for _, x in side] for side in (left, right)]
    size = [np.array([len(x) for x in side]) for side in sides]
    flat = [np.concatenate(side) for side in sides]
    owner = [np.repeat(np.arange(len(s)), s) for s in size]
    common = np.intersect1d(flat[0], flat[1])
    both = np.zeros((len(left), len(right)), np.float32)
    place = [np.searchsorted(common, f) for f in flat]
    for k in (0, 1):
        hit = place[k] < len(common)
        hit[hit] = common[place[k][hit]] == flat[k][hit]
        place[k], owner[k] = place[k][hit], owner[k][hit]
        order = np.argsort(place[k], kind="stable")
        place[k], owner[k] = place[k][order], owner[k][order]
    for low in range(0, len(common), columns):
        part = []
        for k in (0, 1):
            i, j = np.searchsorted(place[k], [low, low + columns])
            m = np.zeros((len(size[k]), min(columns, len(common) - low)), np.float32)
            m[owner[k][i:j], place[k][i:j] - low] = 1
            part.append(m)
        both += part[0] @ part[1].T
    shared = np.rint(both).astype(np.int64)
    union = size[0][:, None] + size[1][None, :] - shared
    c = [np.array([x for x, _ in side]) for side in (left, right)]
    x, y = np.nonzero((100 * shared >= percent * union) & (c[0][:, None] != c[1][None, :]))
    return {(min(a, b), max(a, b)) for a, b in zip(c[0][x].tolist(), c[1][y].tolist())}


def pairs_batch(pairs: set[tuple[int, int]]) -> pa.RecordBatch:
    rows = sorted(pairs)
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in rows], pa.int64()) for k in (0, 1)],
                                      names=["a", "b"])


def crowds_joined(placed: DataFrame, confirmed, percent: int,
                  block: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """The rounds of step 2 over (tag, part, rep, n, comp, main), rows of keys and
    members with the member's component and the key's main one.

    Returns the rows with their components joined, (tag, part, rows, cols) of the
    blocks that are left in keys of several components, and the links found, pairs
    of components.  The driver gets one number per round."""
    key, edges, before = ["tag", "part"], [], None
    weight = 1 + F.col("n") / MEMBER_WEIGHT
    while True:
        sizes = staged(placed.groupBy(*key).agg(
            F.ceil(F.sum(F.when(F.col("comp") != F.col("main"), weight)) / block).cast("int").alias("rows"),
            F.ceil(F.sum(weight) / block).cast("int").alias("cols")).where("rows > 0"), "minhash-sizes")
        crowded = sizes.where("rows > 1")
        blocks = crowded.agg(F.sum(F.col("rows").cast("long") * F.col("cols"))).first()[0]
        if not blocks or before is not None and blocks * 4 > before * 3:
            return placed, sizes, edges
        before = blocks
        crowd = placed.join(crowded.select(*key), key)
        seeds = [F.lit(PIVOTS * len(edges) + i + 1) for i in range(PIVOTS)]
        pivots = staged(crowd.groupBy(*key).agg(*[
            F.min(F.struct(F.xxhash64("rep", x).alias("order"), "rep", "n", "comp")).alias(f"p{i}")
            for i, x in enumerate(seeds)]), "minhash-pivots")
        pivots = pivots.select(*key, F.explode(F.array_distinct(F.array(
            *[f"p{i}" for i in range(PIVOTS)]))).alias("p"))
        # The hashed order is that of all keys, so keys of the same group have the
        # same pivots, and a pair is tested once.
        tests = (crowd.join(pivots, key)
                 .where((F.col("comp") != F.col("p.comp")) & _similar_size(F.col("n"), F.col("p.n"), percent))
                 .select(F.least("rep", "p.rep").alias("a"), F.greatest("rep", "p.rep").alias("b"),
                         F.least("comp", "p.comp").alias("x"), F.greatest("comp", "p.comp").alias("y")))
        tests = staged(tests.distinct(), "minhash-tests")
        found = staged(confirmed(tests).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
                       "minhash-round")
        edges.append(found)
        top = staged(components(found, "minhash-round"), "minhash-tops")
        for c in ("comp", "main"):
            placed = (placed.join(top.select(F.col("id").alias(c), F.col("root").alias("_top")), c, "left")
                      .withColumn(c, F.coalesce("_top", c)).drop("_top"))
        placed = staged(placed, "minhash-open")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5,
                    percent: int = 80, block: int = 2048) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row: components of the
    links with a Jaccard similarity of ``percent`` % or more; a row is kept if
    its id is its component's smallest.  A block's side holds about ``block``
    members, fewer of long texts: ``block`` times ``MEMBER_WEIGHT`` shingles."""
    sets = staged(signatures(docs, key, text, width), "minhash-sets")
    same = ["h1", "h2", "n"]
    reps = staged(sets.where("n > 0 and id is not null").groupBy(*same).agg(
        F.min("id").alias("rep"), *[F.min(s).alias(s) for s in SIGNATURE]), "minhash-classes")

    # Step 1: each member against the first of its key.
    first = F.struct(F.xxhash64("rep").alias("order"), "rep", "n")
    keys = (filed(reps, "rep", "n").groupBy("tag", "part")
            .agg(F.count(F.lit(1)).alias("members"), F.min(first).alias("first"))
            .where("members > 1").select("tag", "part", "first.rep", F.col("first.n").alias("m"))
            .withColumnRenamed("rep", "first"))
    keys = staged(keys, "minhash-keys")
    members = staged(filed(reps, "rep", "n").join(keys, ["tag", "part"]), "minhash-members")
    pairs = staged(members.where((F.col("rep") != F.col("first"))
                                 & _similar_size(F.col("n"), F.col("m"), percent))
                   .select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct(), "minhash-pairs")
    wanted = members.select(F.col("rep").alias("id")).distinct()

    def hashes(batches):
        powers = bytesops.Powers()
        for b in batches:
            data, offsets = bytesops.flat(b.column(1))
            for i, j in bytesops.blocks(offsets):
                got = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i],
                                   width, powers)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i),
                     pa.array([x.view(np.int64) for x in got], pa.list_(pa.int64()))],
                    names=["id", "hashes"])

    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text)).join(wanted, "id")
    full = staged(texts.mapInArrow(hashes, "id bigint, hashes array<bigint>"), "minhash-full")

    def confirmed(pairs: DataFrame) -> DataFrame:
        a, b = (full.select(F.col("id").alias(c), F.col("hashes").alias(f"set_{c}")) for c in "ab")
        shared = F.size(F.array_intersect("set_a", "set_b"))
        return (pairs.join(b, "b").join(a, "a")
                .where(100 * shared >= percent * (F.size("set_a") + F.size("set_b") - shared))
                .drop("set_a", "set_b"))

    joined = staged(components(confirmed(pairs), "minhash-step1"), "minhash-joined")

    # Step 2: keys whose members lie in several components.
    comp = F.coalesce("root", "rep").alias("comp")
    placed = (members.join(joined.withColumnRenamed("id", "rep"), "rep", "left")
              .select("tag", "part", "rep", "n", "first", comp))
    own = F.max(F.when(F.col("rep") == F.col("first"), F.col("comp"))).alias("main")
    # Aggregates are stored before they are joined back: with a plain shuffle on
    # both sides, the rows of a key that very many documents share are split.
    mixed = staged(placed.groupBy("tag", "part")
                   .agg(F.min("comp").alias("low"), F.max("comp").alias("high"), own)
                   .where("low <> high").select("tag", "part", "main"), "minhash-several")
    placed = staged(placed.join(mixed, ["tag", "part"])
                    .select("tag", "part", "rep", "n", "comp", "main"), "minhash-mixed")
    # A text can't be linked with anything if more of it than a link may miss
    # occurs in no other text here: what it shares is at most the rest.
    alone = (full.join(placed.select(F.col("rep").alias("id")).distinct(), "id")
             .select("id", F.explode("hashes").alias("x"))
             .groupBy(F.col("x").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("x"))
             .agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("id")).where("c = 1")
             .groupBy("id").agg(F.count(F.lit(1)).alias("own")))
    able = staged(full.select("id", F.size("hashes").alias("n")).join(alone, "id", "left")
                  .where((F.col("n") - F.coalesce("own", F.lit(0))) * 100 >= F.col("n") * percent)
                  .select(F.col("id").alias("rep")).distinct(), "minhash-able")
    placed = staged(placed.join(able, "rep"), "minhash-open")
    placed, sizes, edges = crowds_joined(placed, confirmed, percent, block)
    placed = (placed.withColumn("other", F.col("comp") != F.col("main"))
              .join(sizes, ["tag", "part"]))
    row = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("rows")).cast("int")
    col = F.pmod(F.xxhash64("rep", F.lit(2)), F.col("cols")).cast("int")
    left = placed.where("other").select(
        "tag", "part", "rep", "comp", F.lit(0).alias("side"), row.alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("j"))
    right = placed.select(
        "tag", "part", "rep", "comp", F.lit(1).alias("side"),
        F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), col.alias("j"))
    dealt = left.unionByName(right).join(full.withColumnRenamed("id", "rep"), "rep")

    block_of = ["tag", "part", "i", "j"]

    def links(batches):
        """Blocks come one after the other, sorted; most are a few rows."""
        held, sides = None, ([], [])
        for b in batches:
            places = list(zip(*(b.column(k).to_pylist() for k in range(4))))
            side, comps = b.column(4).to_pylist(), b.column(5).to_pylist()
            data, offsets = b.column(6).values.to_numpy(), b.column(6).offsets.to_numpy()
            out = set()
            for k, place in enumerate(places):
                if place != held:
                    out |= block_links(*sides, percent)
                    held, sides = place, ([], [])
                sides[side[k]].append((comps[k], data[offsets[k]:offsets[k + 1]].copy()))
            yield pairs_batch(out)
        yield pairs_batch(block_links(*sides, percent))

    across = (dealt.select(*block_of, "side", "comp", "hashes").repartition(*block_of)
              .sortWithinPartitions(*block_of).mapInArrow(links, "a bigint, b bigint").distinct())
    for found in edges:
        across = across.unionByName(found)
    merged = components(across, "minhash-step2")

    final = (joined.join(merged.select(F.col("id").alias("root"), F.col("root").alias("top")), "root", "left")
             .select("id", F.coalesce("top", "root").alias("root")))
    # Components of one class each, merged only in step 2, are not in step 1.
    alone = merged.join(joined, merged["id"] == joined["id"], "left_anti").select("id", "root")
    final = staged(final.unionByName(alone), "minhash-components")
    classes = (reps.select(*same, "rep").join(final, reps["rep"] == final["id"], "left")
               .select(*same, F.coalesce("root", "rep").alias("root")))
    return (sets.join(classes, same, "left")
            .select("id", F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNull(), None).otherwise(F.coalesce("root", "id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))))
