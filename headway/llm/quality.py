"""Document quality by a byte-level convolutional network.

A text is cut into overlapping chunks (``WIDTH`` bytes, every ``STRIDE``
bytes, from the first byte to the last).  Each byte has a learned embedding,
another one where the last four bytes echo those some ``ECHO`` bytes before (a
filter alone can't see that a word repeats); learned filters run over every
chunk, each filter keeps its largest response over the whole document (max
pooling), and a small dense layer combines these into one probability.  Only
the bytes of the text are read.

The network is fitted in numpy (Adam) to a bounded sample: at most ``sample``
labelled rows per label, those with the smallest hashes of the label row's key
among the rows that may be learned from.  Without rows of both labels
there is no network and every score is 0.5.  Empty and null texts are one
blank chunk and get a score too.  Repeated rows score alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm import bytesops

WIDTH, STRIDE = 32, 16
ECHO = range(2, 41)


def symbols(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bytes, plus 256 where the four bytes up to here equal those ending
    ``p`` bytes earlier in the same text, for some ``p`` in ``ECHO``."""
    n = len(data)
    out = data.astype(np.uint16)
    if n < 8:
        return out
    gram = np.zeros(n, np.uint32)
    wide = data.astype(np.uint32)
    for k in range(4):
        gram[3:] |= wide[3 - k:n - k] << np.uint32(8 * k)
    size = np.diff(offsets)
    place = np.minimum(np.arange(n) - np.repeat(offsets[:-1], size), 250).astype(np.uint8)
    echo = np.zeros(n, bool)
    for p in ECHO:
        if p < n:
            echo[p:] |= (gram[p:] == gram[:-p]) & (place[p:] >= p + 3)
    out[echo] += 256
    return out


class ByteCNN:
    """``e`` (512, D) embedding of bytes and echoed bytes, ``f`` (WIDTH*D, K) filters, then a hidden
    layer ``h`` (K, M) and ``o`` (M)."""

    learning = False

    def __init__(self, dims: int = 6, filters: int = 48, hidden: int = 12, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.w = {
            "e": rng.normal(0, 0.5, (512, dims)).astype(np.float32),
            "f": rng.normal(0, 1 / np.sqrt(WIDTH * dims), (WIDTH * dims, filters)).astype(np.float32),
            "fb": np.zeros(filters, np.float32),
            "h": rng.normal(0, 1 / np.sqrt(filters), (filters, hidden)).astype(np.float32),
            "hb": np.zeros(hidden, np.float32),
            "o": rng.normal(0, 0.5, hidden).astype(np.float32),
            "ob": np.zeros(1, np.float32),
        }

    @staticmethod
    def chunks(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, chunks per text); the last chunk reaches the last byte."""
        size = np.diff(offsets)
        many = np.maximum(1, -(-(size - (WIDTH - STRIDE)) // STRIDE))
        part = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(offsets[:-1], many) + part * STRIDE, many

    def _reader(self, data: np.ndarray, offsets: np.ndarray):
        """(chunks per text, ``at``: the symbols of given chunks; past a text's
        end they count as byte 0)."""
        starts, many = self.chunks(offsets)
        ends = np.repeat(offsets[1:], many)
        padded = np.concatenate((symbols(data, offsets), np.zeros(WIDTH, np.uint16)))
        within = np.arange(WIDTH)

        def at(rows: np.ndarray) -> np.ndarray:
            pos = starts[rows][:, None] + within
            got = padded[pos]
            over = starts[rows] + WIDTH > ends[rows]
            if over.any():
                got[over] = np.where(pos[over] < ends[rows][over][:, None], got[over], 0)
            return got

        return many, at

    def pooled(self, data: np.ndarray, offsets: np.ndarray, block: int = 4096):
        """(texts, K) largest response of each filter, and where with: the chunk
        that gave it (its number among all chunks), and the chunks' reader."""
        w = self.w
        many, at = self._reader(data, offsets)
        owner = np.repeat(np.arange(len(many)), many)
        best = np.full((len(many), w["f"].shape[1]), -np.inf, np.float32)
        won = np.zeros(best.shape, np.int64)
        for i in range(0, len(owner), block):
            rows = np.arange(i, min(i + block, len(owner)))
            response = w["e"][at(rows)].reshape(len(rows), -1) @ w["f"]
            own = owner[rows]
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            top = np.maximum.reduceat(response, first, axis=0)
            texts = own[first]
            better = top > best[texts]
            best[texts] = np.where(better, top, best[texts])
            if self.learning:
                last = np.concatenate((first[1:], [len(rows)]))
                arg = np.stack([i + a + response[a:z].argmax(0) for a, z in zip(first, last)])
                won[texts] = np.where(better, arg, won[texts])
        return best + w["fb"], won, at

    def head(self, pooled: np.ndarray):
        w = self.w
        a = np.maximum(pooled, 0)
        b = np.tanh(a @ w["h"] + w["hb"])
        z = b @ w["o"] + w["ob"][0]
        return a, b, 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.head(self.pooled(data, offsets)[0])[2].astype(float)

    def gradients(self, data: np.ndarray, offsets: np.ndarray, y: np.ndarray):
        """(loss, gradients) of the mean cross entropy."""
        w = self.w
        pooled, win, at = self.pooled(data, offsets)
        a, b, p = self.head(pooled)
        n, k = pooled.shape
        dz = ((p - y) / n).astype(np.float32)
        g = {"o": b.T @ dz, "ob": np.array([dz.sum()], np.float32)}
        db = dz[:, None] * w["o"] * (1 - b * b)
        g["h"], g["hb"] = a.T @ db, db.sum(0)
        da = (db @ w["h"].T) * (pooled > 0)
        g["fb"] = da.sum(0)
        bytes_ = at(win.ravel())
        x = w["e"][bytes_].reshape(n, k, -1)
        g["f"] = np.einsum("nkd,nk->dk", x, da, optimize=True)
        dx = (da[:, :, None] * w["f"].T[None]).reshape(-1, w["e"].shape[1])
        g["e"] = np.stack([np.bincount(bytes_.ravel(), dx[:, d], 512)
                           for d in range(dx.shape[1])], 1).astype(np.float32)
        loss = -np.mean(y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))
        return loss, g

    def fit(self, texts: list[bytes], y: np.ndarray, rounds: int = 300, batch: int = 32,
            rate: float = 0.01, seed: int = 9) -> "ByteCNN":
        rng = np.random.default_rng(seed)
        self.learning = True
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        classes = [np.flatnonzero(y == k) for k in (0, 1)]
        for step in range(1, rounds + 1):
            pick = np.concatenate([rng.choice(c, batch // 2) for c in classes])
            data = np.frombuffer(b"".join(texts[i] for i in pick), np.uint8)
            offsets = np.concatenate(([0], np.cumsum([len(texts[i]) for i in pick])))
            _, g = self.gradients(data, offsets, y[pick].astype(np.float32))
            lr = rate * (1 - step / (rounds + 1))
            for k, v in g.items():
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.99 * s[k] + 0.01 * v * v
                self.w[k] -= (lr * (m[k] / (1 - 0.9 ** step)) /
                              (np.sqrt(s[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
        self.learning = False
        return self


def train(docs: DataFrame, labels: DataFrame, may_learn, key: str = "doc_id", text: str = "text",
          label: str = "quality", sample: int = 1200, **fit) -> ByteCNN | None:
    """A network fitted to at most ``sample`` rows per label of the rows for
    which ``may_learn`` (a condition on the key) holds."""
    rows = (labels.where(may_learn & F.col(label).isin(0, 1) & F.col(key).isNotNull())
            .select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).distinct())
    spark = docs.sparkSession
    chosen = [(r[0], r[1]) for y in (0, 1) for r in
              rows.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(sample).collect()]
    if len({y for _, y in chosen}) < 2:
        return None
    # At most 2 * sample rows of a key and a label.
    kind = rows.schema["k"].dataType.simpleString()
    picked = F.broadcast(spark.createDataFrame(chosen, f"k {kind}, y int"))
    # Two columns under own names: no name of the caller's can clash.
    plain = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    got = sorted((r[0].encode("utf-8", "surrogatepass"), r[1])
                 for r in plain.join(picked, "k").select("t", "y").collect())
    y = np.array([r[1] for r in got])
    if len(set(y.tolist())) < 2:
        return None
    return ByteCNN().fit([r[0] for r in got], y, **fit)


def score(docs: DataFrame, model: ByteCNN | None, text: str = "text",
          name: str = "score") -> DataFrame:
    """All columns of ``docs`` (but one of that name) and, last, the score."""
    plain = docs.drop(name)
    if model is None:
        return plain.withColumn(name, F.lit(0.5))
    at = plain.columns.index(text)

    def run(batches):
        for b in batches:
            data, offsets = bytesops.flat(b.column(at))
            out = [model.scores(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                   for i, j in bytesops.blocks(offsets, 1 << 20)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())],
                names=[*b.schema.names, name])

    return plain.mapInArrow(run, plain.withColumn(name, F.lit(0.0)).schema)
