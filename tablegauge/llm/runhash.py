"""Hashes of runs of words that no pattern of bytes or words makes collide.

Every distinct word of a block is hashed by XXH64 with two seeds.  A run's
hash is two polynomials over its words' hashes, modulo two primes near 2^31
(a power of two would let patterns such as Thue-Morse collide whatever the
base); ``which`` picks one of two such pairs, each over another seed's word
hashes, so together they have four moduli and 128 bits of every word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tablegauge.llm.wordhash import _BLANK, mix

_U = np.uint64
#: Two primes below 2^31: products of residues fit 64 bits.
_PRIMES = (2147483647, 2147483629)
_BASES = [[int(x) for x in np.random.default_rng(77 + i).integers(1 << 20, 1 << 30, 2)] for i in range(2)]


class _Residues:
    """Powers of a base, and of its inverse, modulo a prime."""

    def __init__(self, base: int, prime: int):
        self.prime, self.n = _U(prime), 0
        self.steps = {"up": base, "down": pow(base, -1, prime)}
        self.up = self.down = np.ones(1, _U)

    def need(self, n: int) -> None:
        while len(self.up) < n:
            for name, step in self.steps.items():
                x = getattr(self, name)
                setattr(self, name, np.concatenate([x, x * _U(pow(step, len(x), int(self.prime))) % self.prime]))


_POWERS = [[_Residues(b, p) for b, p in zip(bases, _PRIMES)] for bases in _BASES]


class Runs:
    """The words (runs of anything but ASCII blanks) of a block of texts:
    ``first`` word of each text (one more entry than texts), ``total`` words."""

    def __init__(self, texts: pa.Array):
        """:param texts: a binary array without nulls"""
        import xxhash
        n = len(texts)
        off = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * texts.offset).astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        off -= off[0]
        inside = ~_BLANK[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = off[:-1][off[:-1] < off[1:]]
        begins[heads] = inside[heads]            # a text's first byte never continues a word
        at = np.flatnonzero(begins)
        self.first, self.total = np.searchsorted(at, off), len(at)
        place = np.append(np.cumsum(inside, dtype=np.int32)[at] - 1, np.count_nonzero(inside)).astype(np.int32)
        spelt = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(place), pa.py_buffer(data[inside])])
        coded = spelt.dictionary_encode()
        distinct, word = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self.word = [np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in distinct), _U, len(distinct))[word] for seed in (0, 1)]
        self.sums: list[list[np.ndarray] | None] = [None, None]

    def _sums(self, which: int) -> list[np.ndarray]:
        if self.sums[which] is None:
            out = []
            for part, powers in enumerate(_POWERS[which]):
                powers.need(self.total + 1)
                value = (self.word[which] >> _U(32 * part)) & _U(0xFFFFFFFF)
                s = np.zeros(self.total + 1, _U)
                np.cumsum(value % powers.prime * powers.up[:self.total] % powers.prime, out=s[1:])
                out.append(s)
            self.sums[which] = out
        return self.sums[which]

    def runs(self, start: np.ndarray, length, which: int = 0) -> np.ndarray:
        """Hash of the ``length`` words from each start; ``which`` of two independent hashes."""
        out = []
        for s, powers in zip(self._sums(which), _POWERS[which]):
            out.append((s[start + length] - s[start]) % powers.prime * powers.down[start] % powers.prime)
        return mix((out[0] << _U(32)) | out[1])
