"""Packing documents into token windows by Karmarkar-Karp differencing.

A document's ids are those of the tokenizer and a closing id.  Words between
ASCII white space are tokenized one by one, each distinct word once per worker
(white space ends every token of the word-level tokenizer, and its
normalisation doesn't reach across it).

Documents are cut at multiples of the capacity; full pieces fill windows of
their own.  Of the rest, one in ``cut_every`` is cut into pieces of at most
``cut_to`` ids, to fill gaps with.  The rest pieces are dealt into
groups of about ``group`` by hash and each group is split into ``k`` windows
by multiway differencing: the two partial partitions with the largest spread
are merged with opposing imbalances, the largest window of one with the
smallest of the other, until one partition is left.  ``k`` starts at the least
that could hold the tokens and rises whenever a window exceeds the capacity.

Null and empty texts have only the closing id.  Repeated rows are packed each
for itself.
"""

from __future__ import annotations

import heapq
import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from headway.llm import bytesops
from headway.llm.common import staged, worker_cache

CAPACITY = 2048
#: Hash weights of bytes, upper and lower case apart.
EXACT = bytesops.constants(256, 13)


class WordIds:
    """Token ids of words by the words' hashes; forgets all when it holds more
    than ``limit`` words."""

    def __init__(self, tokenizer, limit: int = 1_500_000):
        self.tokenizer, self.limit = tokenizer, limit
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               powers: bytesops.Powers) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, ids per word)."""
        hashes = bytesops.span_hashes(data, starts, ends, powers, EXACT)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > self.limit:
            self.forget()
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        missing = np.flatnonzero(~known)
        if len(missing):
            raw = data.tobytes()
            words = [raw[starts[i]:ends[i]].decode("utf-8", "replace") for i in first[missing]]
            got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            size = np.array([len(x) for x in got], np.int64)
            flat = np.array([y for x in got for y in x], np.uint32)
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate((self.ids, np.zeros(len(self.ids), np.uint32)))
            self.ids[self.used:self.used + len(flat)] = flat
            at = self.used + np.cumsum(size) - size
            self.used += len(flat)
            where = place[missing]
            self.keys = np.insert(self.keys, where, distinct[missing])
            self.at = np.insert(self.at, where, at)
            self.size = np.insert(self.size, where, size)
            place = np.searchsorted(self.keys, distinct)
        rows = place[inverse]
        size = self.size[rows]
        take = np.arange(size.sum()) + np.repeat(self.at[rows] - (np.cumsum(size) - size), size)
        return self.ids[take], size


def word_ids(path: str) -> WordIds:
    """This worker's tokenizer and words."""
    cache = worker_cache()
    if path not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        cache[path] = WordIds(Tokenizer.from_file(path))
    return cache[path]


def cuts(n: int, capacity: int, fine: bool, cut_to: int) -> list[int]:
    """Where pieces of ``n`` ids start."""
    whole = n - n % capacity
    return [*range(0, whole, capacity), *(range(whole, n, cut_to if fine else capacity))]


def token_pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
                 closing_id: int = 1, capacity: int = CAPACITY, cut_every: int = 4,
                 cut_to: int = 64) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens) per piece; no shuffle."""
    kind = docs.select(key).schema[0].dataType
    key_type = to_arrow_type(kind)

    def run(batches):
        words, powers = word_ids(tokenizer), bytesops.Powers()
        for b in batches:
            keys = b.column(0)
            data, offsets = bytesops.flat(b.column(1))
            for i, j in bytesops.blocks(offsets):
                block, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                starts, ends = bytesops.word_bounds(block, off)
                ids, size = words.encode(block, starts, ends, powers)
                upto = np.concatenate(([0], np.cumsum(size)))
                bounds = upto[np.searchsorted(starts, off)]
                rows = []
                for d in range(j - i):
                    own = np.append(ids[bounds[d]:bounds[d + 1]], np.uint32(closing_id)).astype("<u4")
                    n = len(own)
                    mark = zlib.crc32(own)
                    at = cuts(n, capacity, mark % cut_every == 0, cut_to)
                    for s, e in zip(at, [*at[1:], n]):
                        rows.append((i + d, s, e - s, mark if e - s == n else zlib.crc32(own[s:e]), n))
                which, *columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(which)).cast(key_type),
                     *(pa.array(c, pa.int64()) for c in columns)], names=names)

    names = [key, "start", "length", "ids_crc32", "doc_tokens"]
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind.simpleString()}, " + ", ".join(f"{n} bigint" for n in names[1:]))


def differencing(lengths: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of each length, the windows' sums) of a split into ``k``."""
    n = len(lengths)
    parent = np.arange(n)
    # A partial partition: its windows that aren't empty, the largest first.
    # Each window goes by one of its pieces.
    heap = [(-int(x), i, np.array([x], np.int64), np.array([i])) for i, x in enumerate(lengths)]
    heapq.heapify(heap)
    count = n
    while len(heap) > 1:
        _, _, a, at_a = heapq.heappop(heap)
        _, _, b, at_b = heapq.heappop(heap)
        meet = len(a) + len(b) - k
        if meet > 0:  # the smallest of a, falling, with the smallest of b, rising
            x, y = at_a[len(a) - meet:], at_b[::-1][:meet]
            parent[y] = x
            sums = np.concatenate((a[:len(a) - meet], a[len(a) - meet:] + b[::-1][:meet], b[:len(b) - meet]))
            at = np.concatenate((at_a, at_b[:len(b) - meet]))
        else:
            sums, at = np.concatenate((a, b)), np.concatenate((at_a, at_b))
        order = np.argsort(-sums, kind="stable")
        sums, at = sums[order], at[order]
        low = sums[-1] if len(sums) == k else 0
        count += 1
        heapq.heappush(heap, (-int(sums[0] - low), count, sums, at))
    while True:
        above = parent[parent]
        if (above == parent).all():
            break
        parent = above
    _, _, sums, at = heap[0]
    window = np.zeros(n, np.int64)
    window[at] = np.arange(len(at))
    return window[parent], sums


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Window of each length, all windows' sums within the capacity."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    k = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        window, sums = differencing(lengths, k)
        over = int(sums.max()) - capacity
        if over <= 0:
            return window
        k += max(1, k * over // (4 * capacity))


def pack_documents(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY, group: int = 2048, **cut) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece;
    offsets in a sequence run without gaps from 0."""
    found = token_pieces(docs, tokenizer, key, text, capacity=capacity, **cut)
    # The row number is stored before it deals: repeated rows spread over the groups too.
    numbered = staged(found.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    pieces = numbered.drop("_row")
    rest = numbered.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group))
    bucket = F.pmod(F.xxhash64(key, "start", "ids_crc32", "_row", F.lit(17)), F.lit(groups))
    fields = pieces.schema
    span = 1 << 20  # more windows than any group has

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", key, "start", "ids_crc32"],
                                  ascending=[False, True, True, True], kind="stable")
        window = pack(frame["length"].to_numpy(np.int64), capacity)
        frame["sequence_id"] = frame["_group"] * span + window
        frame = frame.sort_values(["sequence_id", key, "start"], kind="stable")
        length = frame["length"].to_numpy(np.int64)
        upto = np.cumsum(length) - length
        first = np.flatnonzero(~frame["sequence_id"].duplicated().to_numpy())
        sizes = np.diff(np.append(first, len(frame)))
        frame["offset"] = upto - np.repeat(upto[first], sizes)
        return frame[[*fields.names, "sequence_id", "offset"]]

    # A task's work is in the merges, not in its bytes: the number of tasks is
    # given, so that small partitions aren't merged at run time.
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-groups // 8))
    packed = (rest.withColumn("_group", bucket).drop("_row").repartition(tasks, "_group").groupBy("_group")
              .applyInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
                             + ", sequence_id bigint, `offset` bigint"))
    full = pieces.where(F.col("length") == capacity).select(
        "*", (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)
