"""Language identification by a bidirectional gated recurrent network.

Every byte of a text is labelled: one GRU reads each stretch of the text
forwards, another backwards, and a softmax over both hidden states gives a
probability per language at each position.  A document's probabilities are
the mean over all its positions.  The texts are read in stretches of
``WINDOW`` bytes (states start at zero in each), so that a very long text is as
many rows of a batch as it has stretches and none of it is cut off.

Training is numpy backpropagation through time with Adam over a bounded
sample: per language about ``sample`` distinct texts (chosen by the hash of the
text), of each a few stretches at hashed places.  Only text and language are
read.

A null text, or one without a letter, is ``und`` with score 0.0; so is every
text where there is nothing to learn from.  Repeated rows are predicted alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm import bytesops

UNDETERMINED = "und"
WINDOW = 128
_SPAN = float(1 << 63)


def tanh(x: np.ndarray) -> np.ndarray:
    return np.tanh(x, out=x)


class BiGRU:
    """Weights: ``x`` (2, 3H, 256) input columns per byte, ``u`` (2, 3H, H)
    recurrent, ``b`` (2, H) of the candidate's recurrent part, ``v`` (L, 2H) and
    ``c`` (L) of the labels.  The three gate blocks are update, reset, candidate."""

    def __init__(self, labels: list[str], hidden: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        self.w = {
            "x": rng.normal(0, 0.3, (2, 3 * hidden, 256)).astype(np.float32),
            "u": rng.normal(0, 0.4, (2, 3 * hidden, hidden)).astype(np.float32),
            "b": np.zeros((2, hidden), np.float32),
            "v": rng.normal(0, 0.3, (len(labels), 2 * hidden)).astype(np.float32),
            "c": np.zeros(len(labels), np.float32),
        }

    def _states(self, steps: np.ndarray, keep: bool):
        """steps: (2, T, N) bytes in reading order.  To learn from: the hidden
        states (T, 2, H, N) and what each step has computed; else only the two
        shares of the labels' logits (T, 2, L, N)."""
        h_, w = self.hidden, self.w
        _, t_, n = steps.shape
        states = np.empty((t_, 2, h_, n), np.float32) if keep else None
        logits = None if keep else np.empty((t_, 2, len(self.labels), n), np.float32)
        v = np.ascontiguousarray(w["v"].reshape(-1, 2, h_).transpose(1, 0, 2))
        half = w["x"].copy()
        half[:, :2 * h_] *= 0.5  # sigmoid(a) = 0.5 + 0.5 tanh(a / 2)
        u = w["u"].copy()
        u[:, :2 * h_] *= 0.5
        bias = w["b"][:, :, None]
        h = np.zeros((2, h_, n), np.float32)
        inputs = np.empty((2, 3 * h_, n), np.float32)
        back = []
        for t in range(t_):
            for d in (0, 1):
                np.take(half[d], steps[d, t], axis=1, out=inputs[d], mode="clip")
            a = np.matmul(u, h)
            gates = a[:, :2 * h_]
            gates += inputs[:, :2 * h_]
            tanh(gates)
            gates *= 0.5
            gates += 0.5
            z, r = gates[:, :h_], gates[:, h_:]
            q = a[:, 2 * h_:]
            q += bias
            cand = r * q
            cand += inputs[:, 2 * h_:]
            tanh(cand)
            if keep:
                new = states[t]
                np.subtract(h, cand, out=new)
                new *= z
                new += cand
                back.append((h, z, r, q, cand))
                h = new
            else:
                h -= cand
                h *= z
                h += cand
                np.matmul(v, h, out=logits[t])
        return (states, back) if keep else (logits, None)

    @staticmethod
    def _both(bytes_: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(2, T, N): forwards, and backwards from each stretch's last byte."""
        t_, n = bytes_.shape
        at = lengths[None, :] - 1 - np.arange(t_)[:, None]
        reverse = np.take_along_axis(bytes_, np.maximum(at, 0), axis=0)
        return np.stack((bytes_, reverse))

    def _aligned(self, states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(2H, T, N): both states at each position of the text."""
        t_, _, h_, n = states.shape
        out = np.empty((2, h_, t_, n), np.float32)
        out[0] = states[:, 0].transpose(1, 0, 2)
        back = states[:, 1].transpose(1, 0, 2)
        if (lengths == t_).all():
            out[1] = back[:, ::-1]
        else:
            at = np.maximum(lengths[None, :] - 1 - np.arange(t_)[:, None], 0)
            out[1] = np.take_along_axis(back, np.broadcast_to(at, (h_, t_, n)), axis=1)
        return out.reshape(2 * h_, t_, n)

    def _softmax(self, both: np.ndarray) -> np.ndarray:
        k, t_, n = both.shape
        p = self.w["v"] @ both.reshape(k, -1)
        p += self.w["c"][:, None]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        return p.reshape(-1, t_, n)

    def position_sums(self, bytes_: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(N, L): the positions' probabilities, summed over each stretch."""
        parts, _ = self._states(self._both(bytes_, lengths), keep=False)
        t_ = len(bytes_)
        p = parts[:, 0]
        if (lengths == t_).all():
            p += parts[::-1, 1]
        else:
            at = np.maximum(lengths - 1 - np.arange(t_)[:, None], 0)
            p += np.take_along_axis(parts[:, 1], at[:, None, :], axis=0)
        p += self.w["c"][:, None]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        if not (lengths == t_).all():
            p *= (np.arange(t_)[:, None] < lengths)[:, None, :]
        return p.sum(axis=0, dtype=np.float64).T

    def gradients(self, bytes_: np.ndarray, lengths: np.ndarray, y: np.ndarray):
        """(loss, gradients) of the positions' mean cross entropy."""
        h_, w = self.hidden, self.w
        t_, n = bytes_.shape
        steps = self._both(bytes_, lengths)
        states, back = self._states(steps, keep=True)
        both = self._aligned(states, lengths)
        p = self._softmax(both)
        live = (np.arange(t_)[:, None] < lengths).astype(np.float32)
        total = live.sum()
        loss = -(np.log(np.take_along_axis(p, y[None, None, :], 0)[0] + 1e-9) * live).sum() / total
        d = p
        np.put_along_axis(d, y[None, None, :], np.take_along_axis(d, y[None, None, :], 0) - 1, 0)
        d *= live / total
        flat = d.reshape(len(d), -1)
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["v"] = flat @ both.reshape(2 * h_, -1).T
        g["c"] = flat.sum(1)
        dh_all = (w["v"].T @ flat).reshape(2, h_, t_, n)
        at = np.maximum(lengths[None, :] - 1 - np.arange(t_)[:, None], 0)
        dh_all[1] = np.take_along_axis(dh_all[1], np.broadcast_to(at, (h_, t_, n)), axis=1) * live
        dh = np.zeros((2, h_, n), np.float32)
        da = np.empty((2, 3 * h_, n), np.float32)
        hot = np.zeros((256, n), np.float32)
        cols = np.arange(n)
        for t in reversed(range(t_)):
            h, z, r, q, cand = back[t]
            dh += dh_all[:, :, t]
            dcand = dh * (1 - z) * (1 - cand * cand)
            dz = dh * (h - cand) * z * (1 - z)
            dr = dcand * q * r * (1 - r)
            dq = dcand * r
            da[:, :h_], da[:, h_:2 * h_], da[:, 2 * h_:] = dz, dr, dq
            g["u"] += da @ h.transpose(0, 2, 1)
            g["b"] += dq.sum(2)
            dh = dh * z + w["u"].transpose(0, 2, 1) @ da
            da[:, 2 * h_:] = dcand  # the input reaches the candidate past the reset gate
            for k in (0, 1):
                hot[steps[k, t], cols] = 1
                g["x"][k] += da[k] @ hot.T
                hot[steps[k, t], cols] = 0
        return loss, g

    def fit(self, bytes_: np.ndarray, lengths: np.ndarray, y: np.ndarray, rounds: int = 160,
            batch: int = 256, rate: float = 0.02, seed: int = 3) -> "BiGRU":
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        classes = [np.flatnonzero(y == k) for k in range(len(self.labels))]
        for step in range(1, rounds + 1):
            pick = np.array([rng.choice(classes[k]) for k in
                             rng.permutation(np.arange(batch) % len(classes))])
            _, g = self.gradients(bytes_[:, pick], lengths[pick], y[pick])
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            lr = rate * (1 - step / (rounds + 1)) * min(1.0, 1.0 / max(norm, 1e-9))
            for k, v in g.items():
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.99 * second[k] + 0.01 * v * v
                hat = first[k] / (1 - 0.9 ** step)
                self.w[k] -= (lr * hat / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
        return self

    def document_probabilities(self, data: np.ndarray, offsets: np.ndarray,
                               batch: int = 1024) -> np.ndarray:
        """(texts, L) mean probabilities over all positions; 0 for empty texts."""
        size = np.diff(offsets)
        many = -(-size // WINDOW)
        owner = np.repeat(np.arange(len(size)), many)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        start = offsets[owner] + part * WINDOW
        length = np.minimum(offsets[owner + 1] - start, WINDOW)
        sums = np.zeros((len(owner), len(self.labels)))
        order = np.argsort(length, kind="stable")
        padded = np.concatenate((data, np.zeros(WINDOW, np.uint8)))
        for i in range(0, len(order), batch):
            rows = order[i:i + batch]
            longest = int(length[rows].max())
            at = start[rows][None, :] + np.arange(longest)[:, None]
            sums[rows] = self.position_sums(padded[at], length[rows])
        out = np.zeros((len(size), len(self.labels)))
        np.add.at(out, owner, sums)
        return out / np.maximum(size, 1)[:, None]


class Familiar:
    """How much of a text is made of the byte triples of a language's training texts.

    ``usual`` is the median familiarity, per language, of every fifth training text with
    the triples of the others; NaN for a language of under five texts."""

    #: Triples that count as known in every text, so that very short ones pass.
    GIVEN = 4
    STEP = 1 << 20

    def __init__(self, texts: list[list[list[bytes]]]):
        self.known, self.usual = [], []
        for own in texts:
            self.known.append(self._triples([p for i, t in enumerate(own) if i % 5 for p in t]))
            held = [self.of([b"".join(t)], [len(self.known) - 1])[0] for t in own[::5]]
            self.usual.append(float(np.median(held)) if len(own) >= 5 else np.nan)
            self.known[-1] = self._triples([p for t in own for p in t])

    @staticmethod
    def _codes(data: np.ndarray) -> np.ndarray:
        low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.int64)
        return (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]

    def _triples(self, pieces: list[bytes]) -> np.ndarray:
        return np.unique(np.concatenate([np.zeros(0, np.int64)] + [
            self._codes(np.frombuffer(p, np.uint8)) for p in pieces if len(p) >= 3]))

    def of(self, texts: list[bytes], label: list[int]) -> np.ndarray:
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        return self.shares(np.frombuffer(b"".join(texts), np.uint8), offsets, np.array(label))

    def shares(self, data: np.ndarray, offsets: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Per text: the share of its triples that its label knows."""
        n = len(offsets) - 1
        seen = np.zeros(n)
        for i in range(0, len(data) - 2, self.STEP):
            j = min(i + self.STEP, len(data) - 2)
            at = np.arange(i, j)
            owner = np.searchsorted(offsets, at, "right") - 1
            inside = at + 3 <= offsets[owner + 1]
            owner, codes = owner[inside], self._codes(data[i:j + 2])[inside]
            for k in np.unique(label[owner]):
                known = self.known[k]
                if len(known):
                    mine = np.flatnonzero(label[owner] == k)
                    place = np.minimum(np.searchsorted(known, codes[mine]), len(known) - 1)
                    seen += np.bincount(owner[mine[known[place] == codes[mine]]], minlength=n)
        return (seen + self.GIVEN) / (np.maximum(np.diff(offsets) - 2, 0) + self.GIVEN)

    def fit(self, data: np.ndarray, offsets: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The shares in terms of what is usual in the language; 1 where that is unknown."""
        usual = np.array(self.usual)[label]
        return np.where(np.isnan(usual), 1.0, self.shares(data, offsets, label) / usual)


def training_stretches(docs: DataFrame, text: str, label: str, sample: int, places: int,
                       chars: int) -> DataFrame:
    """(label, pieces) of about ``sample`` distinct texts per label: those with
    the smallest hashes, by a threshold from the label's count, so nothing is
    sorted and copies count once."""
    rows = (docs.select(F.col(label).cast("string").alias("label"), F.col(text).alias("t"))
            .where(F.col("label").isNotNull() & F.col("t").rlike("\\p{L}"))
            .withColumn("h", F.xxhash64("t")))
    share = (rows.select("label", "h").distinct().groupBy("label").count()
             .select("label", (F.lit(float(sample)) / F.col("count")).alias("share")))
    # One number per label: as small as the list of languages.
    shares = {r[0]: min(1.0, r[1]) for r in share.collect()}
    if not shares:
        return rows.select("label", F.array("t").alias("pieces")).limit(0)
    limit = F.create_map(*[F.lit(x) for kv in sorted(shares.items()) for x in kv])[F.col("label")]
    spot = F.shiftrightunsigned("h", 1).cast("double") / _SPAN
    cut = [F.substring(F.col("t"), 1 + F.pmod(F.xxhash64("t", F.lit(j)),
                                              F.greatest(F.length("t") - chars, F.lit(1))).cast("int"),
                       F.lit(chars)) for j in range(places)]
    return (rows.where(spot < limit).select("label", "h", F.array(*cut).alias("pieces"))
            .groupBy("label", "h").agg(F.first("pieces").alias("pieces"))
            .select("label", "pieces"))


def train(docs: DataFrame, text: str = "text", label: str = "lang", sample: int = 1500,
          places: int = 4, chars: int = 64, hidden: int = 8, rounds: int = 160,
          seed: int = 7) -> BiGRU | None:
    """A network fitted to at most about ``sample`` texts per language, each by
    ``places`` stretches of ``chars`` characters; None if no row has both a
    letter and a language."""
    rows = sorted((r[0], tuple(r[1])) for r in
                  training_stretches(docs, text, label, sample, places, chars).collect())
    labels = sorted({r[0] for r in rows})
    if not labels:
        return None
    pieces = [(p.encode("utf-8", "surrogatepass")[:chars], labels.index(k))
              for k, ps in rows for p in dict.fromkeys(ps) if p]
    lengths = np.array([len(p) for p, _ in pieces])
    bytes_ = np.zeros((chars, len(pieces)), np.uint8)
    for i, (p, _) in enumerate(pieces):
        bytes_[:len(p), i] = np.frombuffer(p, np.uint8)
    model = BiGRU(labels, hidden, seed).fit(bytes_, lengths, np.array([k for _, k in pieces]), rounds)
    model.familiar = Familiar([[[p.encode("utf-8", "surrogatepass") for p in ps] for k, ps in rows if k == x]
                               for x in labels])
    return model


def predict(docs: DataFrame, model: BiGRU | None, text: str = "text",
            names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs`` (but for those of the given names) and two last
    ones: the likeliest language and its probability; with a third name, also how
    familiar the text is in that language (``Familiar.fit``), which tells texts of
    no learned language: the probabilities of the learned ones add up to 1 there too."""
    plain = docs.drop(*names)
    given: Column = F.col(text).isNotNull() & F.col(text).rlike("\\p{L}")
    if model is None:
        return plain.withColumns({names[0]: F.lit(UNDETERMINED)} | {x: F.lit(0.0) for x in names[1:]})
    out = plain.withColumns({names[0]: F.lit("")} | {x: F.lit(0.0) for x in names[1:]})
    schema = out.schema
    at = plain.columns.index(text)
    flag = "_has_letter"

    def run(batches):
        arrow = None
        for b in batches:
            data, offsets = bytesops.flat(b.column(at))
            letter = np.array(b.column(b.num_columns - 1).to_pylist(), bool)
            pred, score, fit = [], [], []
            for i, j in bytesops.blocks(offsets):
                p = model.document_probabilities(data[offsets[i]:offsets[j]],
                                                 offsets[i:j + 1] - offsets[i])
                best = p.argmax(1)
                pred += [model.labels[k] for k in best]
                score += list(np.minimum(p[np.arange(j - i), best], 1.0))
                if len(names) > 2:
                    fit += list(model.familiar.fit(data[offsets[i]:offsets[j]],
                                                   offsets[i:j + 1] - offsets[i], best))
            pred = [x if ok else UNDETERMINED for x, ok in zip(pred, letter)]
            columns = [*b.columns[:-1], pa.array(pred, pa.string()),
                       *(pa.array(np.where(letter, x, 0.0), pa.float64())
                         for x in (score, fit)[:len(names) - 1])]
            arrow = arrow or [*b.schema.names[:-1], *names]
            yield pa.RecordBatch.from_arrays(columns, names=arrow)

    return plain.withColumn(flag, F.coalesce(given, F.lit(False))).mapInArrow(run, schema)
