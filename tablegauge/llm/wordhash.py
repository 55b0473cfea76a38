"""Word hashes of many texts at once, in numpy.

A word (a run of anything but ASCII blanks) hashes to a sum over its bytes
of a random number for the byte times a power for its place; runs of words
hash the same way over mixed word hashes.  All sums are taken modulo 2^64
from one running sum, so any run's hash costs two lookups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_CHUNK = 1 << 18


def _inverse(r: int) -> int:
    return pow(r, -1, 1 << 64)


class _Powers:
    def __init__(self, r: int):
        self.r, self.n = r, 0
        self.up = self.down = np.zeros(0, _U)

    def need(self, n: int) -> None:
        if n > self.n:
            m = max(n, 2 * self.n, 1 << 16)
            with np.errstate(over="ignore"):
                for name, r in (("up", self.r), ("down", _inverse(self.r))):
                    x = np.full(m, r, _U)
                    x[0] = 1
                    setattr(self, name, np.multiply.accumulate(x))
            self.n = m


_rng = np.random.default_rng(20231)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=_U)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_BLANK] = 0
_R = [int(x) | 1 for x in _rng.integers(0, 1 << 64, 3, dtype=_U)]
_IN_WORD, _RUN = _Powers(_R[0]), (_Powers(_R[1]), _Powers(_R[2]))


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """The words of a block of texts: ``hash`` of each, ``first`` word of
    each text (one more entry than texts)."""

    def __init__(self, texts: pa.Array):
        """:param texts: a binary array without nulls"""
        n = len(texts)
        width = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
        off = np.frombuffer(texts.buffers()[1], width, n + 1, texts.offset * np.dtype(width).itemsize).astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        off = off - off[0]
        blank = _BLANK[data]
        begins = ~blank
        begins[1:] &= blank[:-1] | ~begins[1:]
        heads = off[:-1][off[:-1] < off[1:]]
        begins[heads] = ~blank[heads]           # a text's first byte never continues a word
        at = np.flatnonzero(begins)
        self.places = at
        self.hash = mix(self._hashes(data, at))
        self.first = np.searchsorted(at, off)
        self.sums: list[np.ndarray | None] = [None, None]

    @staticmethod
    def _hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), _U)
        i = 0
        while i < len(at):                      # whole words, about _CHUNK bytes at a time
            j = max(i + 1, int(np.searchsorted(at, at[i] + _CHUNK)))
            end = int(at[j]) if j < len(at) else len(data)
            start = int(at[i])
            _IN_WORD.need(end - start)
            values = _BYTE[data[start:end]] * _IN_WORD.up[:end - start]
            local = at[i:j] - start
            out[i:j] = np.add.reduceat(values, local) * _IN_WORD.down[local]
            i = j
        return out

    def runs(self, start: np.ndarray, length, which: int = 0) -> np.ndarray:
        """Hash of the ``length`` words from each start; ``which`` of two independent hashes."""
        p, n = _RUN[which], len(self.hash)
        p.need(n + 1)
        if self.sums[which] is None:
            s = np.zeros(n + 1, _U)
            np.cumsum(self.hash * p.up[:n], out=s[1:])
            self.sums[which] = s
        s = self.sums[which]
        return mix((s[start + length] - s[start]) * p.down[start] + _U(which))


def least_places(x: np.ndarray, w: int) -> np.ndarray:
    """Place of the leftmost minimum of every ``w`` consecutive values."""
    value, place, span = x, np.arange(len(x)), 1

    def join(d):
        a, b = value[:-d], value[d:]
        right = b < a
        return np.where(right, b, a), np.where(right, place[d:], place[:-d])
    while 2 * span <= w and len(value) > span:
        value, place = join(span)
        span *= 2
    if span < w and len(value) > w - span:
        value, place = join(w - span)
    return place
