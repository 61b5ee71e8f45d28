"""Vectorised byte, word and shingle arithmetic over Arrow string columns.

Texts are handled as one flat UTF-8 buffer plus offsets; a null text is an
empty one.  All hashes are 64-bit and depend on nothing but the bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
STRETCH_BYTES = 1 << 17
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        base = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD)
        return mix64(base + np.uint64((seed * 0xD1342543DE82EF95) & _MASK)) | np.uint64(1)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type)
                                  or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offs, np.int64 if large else np.int32)[
        column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES):
    """Runs of whole texts of about ``limit`` bytes (a longer text alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    values = constants(256, 11)
    values[65:91] = values[97:123]
    white = np.zeros(256, bool)
    white[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return values, white


BYTE_VALUES, WHITE = _byte_tables()


class Powers:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""

    def __init__(self):
        self.base = 0x5851F42D4C957F2D
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(n + 1, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that aren't ASCII white
    space; no word crosses the end of a text."""
    ink = ~WHITE[data]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    nonempty = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[nonempty] = ink[nonempty]
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[ends] = ink[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers,
                values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """A 64-bit hash of each byte span (A-Z as a-z with the default table).
    ``starts`` and ``ends`` ascend; works through short stretches of the bytes,
    so that memory follows the number of spans and the longest span."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = int(np.searchsorted(starts, starts[i] + STRETCH_BYTES))
            lo, hi = starts[i], ends[j - 1]
            up, down = powers.upto(hi - lo)
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(values[data[lo:hi]] * up[:hi - lo], out=total[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            h = (total[e] - total[s]) * down[s]
            out[i:j] = mix64(h + (e - s).astype(np.uint64) * np.uint64(_ODD))
            i = j
    return out


def shingles(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, how many per text) of all runs of ``width`` words; a text with
    fewer words, but some, has its whole sequence as its only shingle."""
    firsts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    many = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    total = int(many.sum())
    if not total:
        return np.zeros(0, np.uint64), many
    begin = np.concatenate(([0], np.cumsum(many)))[:-1]
    at = np.arange(total) - np.repeat(begin, many) + np.repeat(firsts, many)
    length = np.repeat(np.minimum(counts, width), many)
    padded = np.concatenate((words, np.zeros(width, np.uint64)))
    with np.errstate(over="ignore"):
        h = length.astype(np.uint64) * np.uint64(_ODD)
        for k, c in enumerate(constants(width, 29)):
            part = padded[at + k] * c
            h += np.where(length > k, part, np.uint64(0)) if k else part
        return mix64(h), many


def text_shingles(data: np.ndarray, offsets: np.ndarray, width: int,
                  powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes (with repeats) of every text, and how many each has."""
    starts, ends = word_bounds(data, offsets)
    words = span_hashes(data, starts, ends, powers)
    at = np.searchsorted(starts, offsets)
    return shingles(words, np.diff(at), width)
