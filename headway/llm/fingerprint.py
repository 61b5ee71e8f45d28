"""Homomorphic multiset fingerprints of documents.

A text is the multiset of its paragraphs (split at newlines).  Each paragraph
hashes to a wide vector, and the fingerprint is the sum of these vectors, each
lane modulo a power of two: so paragraphs may be inserted, deleted or moved
without reading the others.  The vector has two bands:

* ``identity``: 16 lanes modulo 2**64, the output of SHAKE-128 over the
  paragraph.  Equal multisets have equal sums; others agree with a chance of
  2**-1024.
* ``sketch``: 256 lanes modulo 2**32, more than a text has bytes.  Every run of
  three words in the paragraph adds +1 or -1 to one lane (a count sketch), so that
  the inner product of two sketches estimates how much the texts share.  Runs of
  four bytes count instead in a paragraph of under 64 bytes or under three words,
  and in each word whose run of three (the paragraph's last one for its last two
  words) is over 64 bytes long: scripts without spaces, long tokens.

``likeness`` is the Tanimoto coefficient of the sketches, cut to 0..1, and 1.0
for equal fingerprints.  Null and empty texts have one empty paragraph.  Rows
that share an id are ordered by their text's hash; repeated rows give
repeated results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from headway.llm import bytesops
from headway.llm.common import staged, utf8

IDENTITY_LANES = 16
SKETCH_LANES = 256
WORDS = 3
SHORT_BYTES = 64
RUN_BYTES = 4
#: Marks of a range's first and last row among its results.
HEAD, TAIL = 1, 2
_HASH, _PLACE = "_text_hash", "_place"


class Fingerprint:
    """A multiset of paragraphs; ``insert`` and ``delete`` are inverse."""

    def __init__(self):
        self.identity = np.zeros(IDENTITY_LANES, np.uint64)
        self.sketch = np.zeros(SKETCH_LANES, np.uint32)

    def _vectors(self, paragraphs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = b"".join(hashlib.shake_128(p.encode("utf-8", "surrogatepass"))
                       .digest(8 * IDENTITY_LANES) for p in paragraphs)
        identity = np.frombuffer(raw, "<u8").reshape(-1, IDENTITY_LANES)
        sketch = np.zeros(SKETCH_LANES, np.uint32)
        for h, _ in elements([p.encode("utf-8", "surrogatepass") for p in paragraphs],
                             bytesops.Powers()):
            sketch += sketch_of(h)
        return identity.sum(0, dtype=np.uint64), sketch

    def insert(self, *paragraphs: str) -> "Fingerprint":
        if paragraphs:
            identity, sketch = self._vectors(list(paragraphs))
            self.identity = self.identity + identity
            self.sketch = self.sketch + sketch
        return self

    def delete(self, *paragraphs: str) -> "Fingerprint":
        if paragraphs:
            identity, sketch = self._vectors(list(paragraphs))
            self.identity = self.identity - identity
            self.sketch = self.sketch - sketch
        return self

    def hex(self) -> str:
        return pack(self.identity, self.sketch)


def pack(identity: np.ndarray, sketch: np.ndarray) -> str:
    return identity.astype("<u8").tobytes().hex() + sketch.astype("<u4").tobytes().hex()


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = bytes.fromhex(fingerprint)
    cut = 8 * IDENTITY_LANES
    return np.frombuffer(raw[:cut], "<u8"), np.frombuffer(raw[cut:], "<u4")


def sketch_of(hashes: np.ndarray) -> np.ndarray:
    lane = (hashes >> np.uint64(1)) % np.uint64(SKETCH_LANES)
    sign = 1.0 - 2.0 * (hashes & np.uint64(1)).astype(float)
    total = np.bincount(lane.astype(np.int64), sign, SKETCH_LANES)
    return total.astype(np.int64).astype(np.uint32)


def likeness(a: str, b: str) -> float:
    """Estimated shared part of two fingerprinted texts, 0 to 1."""
    if a == b:
        return 1.0
    x, y = (unpack(f)[1].astype(np.int32).astype(float) for f in (a, b))
    dot = float(x @ y)
    rest = float(x @ x) + float(y @ y) - dot
    return min(1.0, max(0.0, dot / rest)) if rest > 0 else 0.0


def elements(paragraphs: list[bytes], powers: bytesops.Powers):
    """Blocks of (hashes of what the sketch counts, index of each one's paragraph)."""
    data = np.frombuffer(b"".join(paragraphs), np.uint8)
    size = np.array([len(p) for p in paragraphs], np.int64)
    offsets = np.concatenate(([0], np.cumsum(size)))
    starts, ends = bytesops.word_bounds(data, offsets)
    # No run with a word of over SHORT_BYTES counts: a part of it is enough to read.
    words = bytesops.span_hashes(data, starts, np.minimum(ends, starts + SHORT_BYTES + 1), powers)
    first_word = np.searchsorted(starts, offsets)
    count = np.diff(first_word)
    hashes, many = bytesops.shingles(words, count, WORDS)
    at = np.repeat(np.arange(len(size)), many)
    wordy = (size >= SHORT_BYTES) & (count >= WORDS)
    # Of each word in a wordy paragraph: the first word of its run.
    owner = np.repeat(np.arange(len(size)), count)
    which = np.flatnonzero(wordy[owner])
    head = np.minimum(which, first_word[owner[which] + 1] - WORDS)
    long = ends[head + WORDS - 1] - starts[head] > SHORT_BYTES
    keep = wordy[at]
    keep[keep] = ~long[head == which]
    yield hashes[keep], at[keep]

    # Stretches whose bytes start runs: whole paragraphs, words in runs that are too long.
    whole = np.flatnonzero(~wordy)
    which, to = which[long], owner[which[long]]
    after = np.minimum(np.append(starts, len(data))[which + 1], offsets[to + 1])
    begin = np.concatenate((offsets[whole], starts[which]))
    runs = np.concatenate((np.maximum(size[whole] - RUN_BYTES + 1, np.minimum(size[whole], 1)),
                           np.maximum(np.minimum(after, offsets[to + 1] - RUN_BYTES + 1) - starts[which], 0)))
    to = np.concatenate((whole, to))
    order = np.lexsort((runs, begin))
    begin, runs, to = begin[order], runs[order], to[order]
    upto = np.concatenate(([0], np.cumsum(runs)))
    for i in range(0, int(upto[-1]), bytesops.BLOCK_BYTES):
        j = min(i + bytesops.BLOCK_BYTES, int(upto[-1]))
        low, high = np.searchsorted(upto, i, "right") - 1, np.searchsorted(upto, j)
        part = np.minimum(upto[low + 1:high + 1], j) - np.maximum(upto[low:high], i)
        first = np.repeat(begin[low:high] - upto[low:high], part) + np.arange(i, j)
        own = np.repeat(to[low:high], part)
        last = np.minimum(first + RUN_BYTES, offsets[own + 1])
        yield bytesops.span_hashes(data, first, last, powers), own


def fingerprints(texts: list[str], powers: bytesops.Powers) -> list[str]:
    """One fingerprint per text; paragraphs are taken in blocks of bounded size."""
    n = len(texts)
    identity = np.zeros((n, IDENTITY_LANES), np.uint64)
    sketch = np.zeros(n * SKETCH_LANES)

    def add(paragraphs: list[bytes], owner: list[int]) -> None:
        raw = b"".join(hashlib.shake_128(p).digest(8 * IDENTITY_LANES) for p in paragraphs)
        owners = np.array(owner)
        firsts = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
        identity[owners[firsts]] += np.add.reduceat(
            np.frombuffer(raw, "<u8").reshape(-1, IDENTITY_LANES), firsts, axis=0)
        low, high = owner[0], owner[-1] + 1
        for h, at in elements(paragraphs, powers):
            lane = ((h >> np.uint64(1)) % np.uint64(SKETCH_LANES)).astype(np.int64)
            sign = 1.0 - 2.0 * (h & np.uint64(1)).astype(float)
            sketch[low * SKETCH_LANES:high * SKETCH_LANES] += np.bincount(
                (owners[at] - low) * SKETCH_LANES + lane, sign, (high - low) * SKETCH_LANES)

    held: list[bytes] = []
    owner: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        for p in t.encode("utf-8", "surrogatepass").split(b"\n"):
            held.append(p)
            owner.append(i)
            size += len(p)
            if size >= bytesops.BLOCK_BYTES:
                add(held, owner)
                held, owner, size = [], [], 0
    if held:
        add(held, owner)
    lanes = sketch.astype(np.int64).astype(np.uint32).reshape(n, SKETCH_LANES)
    return [pack(identity[i], lanes[i]) for i in range(n)]


def with_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and a last one, ``fingerprint``."""
    schema = docs.drop("fingerprint").withColumn("fingerprint", F.lit("")).schema
    plain = docs.drop("fingerprint")
    at = plain.columns.index(text)

    def run(batches):
        powers = bytesops.Powers()
        for b in batches:
            for part in pieces(b, at):
                texts = [x or "" for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(fingerprints(texts, powers), pa.string())],
                    names=[*part.schema.names, "fingerprint"])

    return plain.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, at: int, limit: int = bytesops.BLOCK_BYTES):
    """Slices of a batch with about ``limit`` bytes in column ``at``."""
    _, offsets = bytesops.flat(batch.column(at))
    for i, j in bytesops.blocks(offsets, limit):
        yield batch.slice(i, j - i)


def dealt_by_range(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text): the rows by descending key, dealt in ranges among the tasks and
    sorted within each; a null text counts as empty.

    Rows of one key (those without a key come last) are ordered by their text's
    hash, and repeated rows by their place in the input, so neither a repeated
    key nor a null one holds a range together.  The ranges are Spark's own.
    """
    rows = docs.select(F.col(key), utf8(text).alias(text))
    rows = rows.select(key, text, F.xxhash64(text).alias(_HASH), F.monotonically_increasing_id().alias(_PLACE))
    order = [F.col(key).desc_nulls_last(), F.col(_HASH).asc(), F.col(_PLACE).asc()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select(key, text)


def neighbours(batches, limit: int = bytesops.BLOCK_BYTES):
    """Runs of (keys, texts, next texts) of about ``limit`` characters from sorted
    (key, text) rows; at the end ("ends", first text, last key, last text), if
    there was a row.  The last row has no neighbour here."""
    held = first = None
    keys, texts, later, size = [], [], [], 0
    for b in batches:
        for part in pieces(b, 1, limit):
            for k, t in zip(*(c.to_pylist() for c in part.columns)):
                if held is None:
                    first = t
                else:
                    keys.append(held[0])
                    texts.append(held[1])
                    later.append(t)
                    size += len(t)
                held = (k, t)
                if size >= limit:
                    yield keys, texts, later
                    keys, texts, later, size = [], [], [], 0
    if keys:
        yield keys, texts, later
    if held is not None:
        yield "ends", first, *held


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next); in the edited text, the last third of the code
    points is replaced by the start of the next document by descending key
    (after the last: the first; a single document is its own neighbour).

    Every task pairs the rows of its range.  What crosses a border, one first and
    one last row per range, is stored with the results and joined by the ranges'
    order; nothing of it reaches the driver.
    """
    kind = docs.select(key).schema[0].dataType
    key_type = to_arrow_type(kind)
    results = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = ["bigint", "string", "string", "string", "double", "double"]
    arrow = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def compared(texts, later, powers) -> list[list]:
        edited = [t[:len(t) - len(t) // 3] + s[:len(t) // 3] for t, s in zip(texts, later)]
        own = fingerprints(texts, powers)
        changed = fingerprints(edited, powers)
        # A row's neighbour is the row after it, but at a border.
        if texts[1:] == later[:-1]:
            following = own[1:] + fingerprints(later[-1:], powers)
        else:
            following = fingerprints(later, powers)
        return [[len(t) for t in texts],
                [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
                own, changed,
                [likeness(x, y) for x, y in zip(own, changed)],
                [likeness(x, y) for x, y in zip(own, following)]]

    def in_range(batches):
        powers = bytesops.Powers()
        at = TaskContext.get().partitionId()
        for keys, *more in neighbours(batches):
            if keys == "ends":
                first, last, tail = more
                keys, found, ends, texts = [None, last], [[None, None]] * 6, [HEAD, TAIL], [first, tail]
            else:
                found, ends, texts = compared(*more, powers), [0] * len(keys), [None] * len(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([at] * len(keys), pa.int32()), pa.array(ends, pa.int32()),
                 pa.array(texts, pa.string()), pa.array(keys, key_type),
                 *(pa.array(x, t) for x, t in zip(found, arrow))], names=stored)

    stored = ["range", "end", "text", "key", *results]
    fields = ", ".join(f"{n} {k}" for n, k in zip(results, kinds))
    # Stored as bytes, not as hexadecimal digits: the table is under half as large.
    prints = ("fingerprint", "edited_fingerprint")
    out = staged(dealt_by_range(docs, key, text).mapInArrow(
        in_range, f"range int, end int, text string, key {kind.simpleString()}, {fields}")
        .withColumns({c: F.unhex(c) for c in prints}), "fingerprint-ranges", codec="zstd")
    out = out.withColumns({c: F.lower(F.hex(c)) for c in prints})

    # One number per range goes through this window: ranges may be empty.
    ranges = out.where(F.col("end") == HEAD).select("range")
    after = staged(ranges.select("range", F.coalesce(
        F.lead("range").over(Window.orderBy("range")),
        F.min("range").over(Window.orderBy("range").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("later")), "fingerprint-order")
    tails = out.where(F.col("end") == TAIL).select("range", "key", "text").join(after, "range")
    heads = out.where(F.col("end") == HEAD).select(F.col("range").alias("later"), F.col("text").alias("next"))

    def across(batches):
        powers = bytesops.Powers()
        for b in batches:
            for part in pieces(b, 1):
                keys, texts, later = (part.column(i) for i in range(3))
                found = compared(texts.to_pylist(), later.to_pylist(), powers)
                yield pa.RecordBatch.from_arrays(
                    [keys, *(pa.array(x, t) for x, t in zip(found, arrow))], names=["key", *results])

    borders = tails.join(heads, "later").select("key", "text", "next").mapInArrow(
        across, f"key {kind.simpleString()}, {fields}")
    return (out.where(F.col("end") == 0).select("key", *results).unionByName(borders)
            .withColumnRenamed("key", key))
