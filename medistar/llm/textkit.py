"""Vectorised word hashing over Arrow string batches.

A word is a run of bytes other than space and 0x09-0x0D (all separators are
single bytes in UTF-8, so the byte view is exact).  Word and span hashes come
from one prefix polynomial per batch (arithmetic modulo 2^64), so hashing costs
a handful of numpy passes over the text's bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_B = np.uint64(0x9E3779B97F4A7C15)
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply) of an unsigned array."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.empty(n + 1, dtype=np.uint64)
    p[0] = 1
    if n:
        p[1:] = np.uint64(base & 0xFFFFFFFFFFFFFFFF)
        with np.errstate(over="ignore"):
            np.cumprod(p, out=p)
    return p


class Words:
    """The words of the texts of one Arrow column, hashed.

    ``buf``: the bytes; ``start``/``end``: byte bounds of every word;
    ``doc``: index of the text a word is in; ``first``: index of each text's
    first word, with the total appended; ``h``: 64-bit word hashes.
    """

    def __init__(self, col, lower: bool = False, salt: int = 0):
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        col = col.cast(pa.large_binary()).fill_null(b"")
        off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1]
        data = col.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8)[off[0]: off[-1]] if data is not None else np.zeros(0, np.uint8)
        self.off = off - off[0]
        self.n = len(col)
        self.raw = raw
        buf = _LOWER[raw] if lower else raw
        inside = ~_SEP[raw]
        # a text border ends a word as a separator does
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        b = self.off[:-1]
        b = b[b < len(raw)]
        starts[b] |= inside[b]
        self.start = np.flatnonzero(starts)
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        b = self.off[1:] - 1
        b = b[b >= 0]
        ends[b] |= inside[b]
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.off)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))
        self.h = self._hash(buf, salt)

    def _hash(self, buf, salt):
        if not len(self.start):
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            length = self.end - self.start
            # Horner by length class: exact, position-free, and short words are most of a text
            h = np.zeros(len(self.start), dtype=np.uint64)
            order = np.argsort(-length, kind="stable")
            pos = self.start[order]
            left = length[order]
            acc = np.zeros(len(pos), dtype=np.uint64)
            live = len(pos)
            step = 0
            top = 64
            while live and step < top:
                live = int(np.searchsorted(-left, -step, side="left"))  # words longer than step
                if not live:
                    break
                acc[:live] = (acc[:live] ^ buf[pos[:live] + step]) * _B
                acc[:live] ^= acc[:live] >> np.uint64(29)
                step += 1
            # the rest of very long words, one word at a time (rare), by blocks of bytes
            for i in range(int(np.searchsorted(-left, -top, side="left"))):
                rest = buf[pos[i] + top: pos[i] + left[i]].astype(np.uint64)
                p = _powers(int(_B), len(rest) - 1)
                acc[i] = (acc[i] ^ np.sum(mix(rest) * p)) * _B
            h[order] = mix(acc ^ left.astype(np.uint64), salt)
            return h

    def spans(self, salt: int = 0) -> "SpanHash":
        """Hashes of arbitrary runs of words, from prefix sums."""
        return SpanHash(self.h, salt)

    def grams(self, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of k words inside one text: (index of the first word, hash)."""
        n = len(self.h) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            acc = np.zeros(n, dtype=np.uint64)
            for j in range(k):
                acc = (acc ^ mix(self.h[j: j + n], salt)) * _B
                acc ^= acc >> np.uint64(31)
            acc = mix(acc, salt)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1:])
        return at, acc[at]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


_B_INVERSE = pow(int(_B), -1, 1 << 64)


class SpanHash:
    """hash of words[a:b] for arrays of a and b, each from two prefix values."""

    def __init__(self, h: np.ndarray, salt: int = 0):
        n = len(h)
        with np.errstate(over="ignore"):
            self.prefix = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(mix(h, 60 + salt) * _powers(int(_B), n)[:n], out=self.prefix[1:], dtype=np.uint64)
        self.back = _powers(_B_INVERSE, n)
        self.salt = salt

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.prefix[b] - self.prefix[a]) * self.back[a] + (b - a).astype(np.uint64), 70 + self.salt)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w entries, by doubling."""
    span = 1
    while 2 * span <= w and len(x) > span:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = w - span
    if rest and len(x) > rest:
        x = np.minimum(x[:-rest], x[rest:])
    elif rest:
        x = x[:0]
    return x


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20):
    """The rows of a batch in runs of at most ``most`` bytes of one text column
    (a longer text comes alone), so working memory follows a bound, not the batch."""
    col = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    at = 0
    while at < len(col):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
