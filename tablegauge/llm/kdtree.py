"""K-d trees over letter counts, searched for many words at once.

Two words one letter apart have counts that differ by at most one letter
more and one letter less (L1 distance two at most), so a search carries for
each query how many letters its counts lie below and above a node's box and
leaves the node when either exceeds what the edit allows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LETTERS = 90
_PLACE = np.zeros(256, np.int64)
_PLACE[97:123] = np.arange(26)
_PLACE[0xC0:0x100] = np.arange(26, 90)


def spelling(words: list[str]) -> np.ndarray:
    """Words of one length, all of a-z and U+00C0 to U+00FF, as a matrix of bytes."""
    n = len(words)
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(n, -1) if n else np.zeros((0, 0), np.uint8)


def letter_counts(spelt: np.ndarray) -> np.ndarray:
    n, width = spelt.shape
    at = np.repeat(np.arange(n) * LETTERS, width) + _PLACE[spelt.ravel()]
    return np.bincount(at, minlength=n * LETTERS).reshape(n, LETTERS).astype(np.int32)


class Tree:
    """Splits on one letter's count at a time until a leaf's share of the
    words (each standing for ``weight`` words) is at most ``leaf``, or all
    counts are equal.  ``members``: the given words of each leaf."""

    def __init__(self, counts: np.ndarray, leaf: float, weight: float = 1.0):
        self.nodes: list[tuple[int, int, int, int]] = []   # letter, count, left, right; or -1, leaf, 0, 0
        self.members: list[np.ndarray] = []
        self.nodes.append((-1, 0, 0, 0))
        todo = [(0, np.arange(len(counts)))]
        while todo:
            at, idx = todo.pop()
            cut = self._cut(counts[idx]) if len(idx) * weight > leaf else None
            if cut is None:
                self.nodes[at] = (-1, len(self.members), 0, 0)
                self.members.append(idx)
                continue
            letter, count = cut
            low = counts[idx, letter] <= count
            left = len(self.nodes)
            self.nodes += [(-1, 0, 0, 0)] * 2
            self.nodes[at] = (letter, count, left, left + 1)
            todo += [(left, idx[low]), (left + 1, idx[~low])]

    @staticmethod
    def _cut(counts: np.ndarray) -> tuple[int, int] | None:
        n = len(counts)
        best, cut = 0, None
        for value in range(4):
            low = (counts <= value).sum(axis=0)
            even = np.minimum(low, n - low)
            letter = int(np.argmax(even))
            if even[letter] > best:
                best, cut = int(even[letter]), (letter, value)
        if cut is None:                          # counts above four everywhere they differ
            spread = counts.max(axis=0) - counts.min(axis=0)
            letter = int(np.argmax(spread))
            if spread[letter]:
                cut = letter, int((counts[:, letter].max() + counts[:, letter].min()) // 2)
        return cut

    def search(self, counts: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves and the queries that may have a word there with at most
        ``more`` letters added and ``less`` letters taken away."""
        n = len(counts)
        todo = [(0, np.arange(n), np.zeros(n, np.int32), np.zeros(n, np.int32), {}, {})]
        while todo:
            at, idx, below, above, least, most = todo.pop()
            letter, count, left, right = self.nodes[at]
            if letter < 0:
                yield count, idx
                continue
            x = counts[idx, letter]
            a = above + np.maximum(x - count, 0) - (np.maximum(x - most[letter], 0) if letter in most else 0)
            b = below + np.maximum(count + 1 - x, 0) - (np.maximum(least[letter] - x, 0) if letter in least else 0)
            for child, ok, lo, hi in ((left, a <= less, least, most | {letter: count}), (right, b <= more, least | {letter: count + 1}, most)):
                if ok.any():
                    todo.append((child, idx[ok], (below if child == left else b)[ok], (a if child == left else above)[ok], lo, hi))


class Words:
    """Words of one length, in code-point order, ready to be searched."""

    def __init__(self, words: list[str], leaf: int):
        self.spelt = spelling(words)
        self.counts = letter_counts(self.spelt)
        self.tree = Tree(self.counts, leaf)
        self.exact = np.float32 if self.spelt.shape[1] < 2000 else np.float64
        self.point = self.counts.astype(self.exact)
        self.square = (self.point * self.point).sum(axis=1)

    def near(self, spelt: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) one edit apart, for queries as long as the words or one letter shorter."""
        same = spelt.shape[1] == self.spelt.shape[1]
        apart = 2 if same else 1                 # squared distance of the counts, if one letter differs
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for leaf, queries in self.tree.search(counts, 1, 1 if same else 0):
            there = self.tree.members[leaf]
            for i in range(0, len(queries), 8192):
                some = queries[i:i + 8192]
                q = counts[some].astype(self.exact)
                square = (q * q).sum(axis=1)[:, None] + self.square[there] - 2 * (q @ self.point[there].T)
                a, b = np.nonzero(square == apart)
                a, b = some[a], there[b]
                step = max(1, (8 << 20) // max(spelt.shape[1], 1))
                for j in range(0, len(a), step):
                    ok = self._one_edit(spelt[a[j:j + step]], self.spelt[b[j:j + step]])
                    found.append((a[j:j + step][ok], b[j:j + step][ok]))
        return tuple(np.concatenate(x) for x in zip(*found))

    @staticmethod
    def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = a.shape[1]
        if n == b.shape[1]:
            return (a != b).sum(axis=1) == 1
        ends = np.ones((len(a), 1), bool)        # a stop after the last letter
        head = np.argmax(np.hstack([a != b[:, :n], ends]), axis=1)
        tail = np.argmax(np.hstack([(a != b[:, 1:])[:, ::-1], ends]), axis=1)
        return head + tail >= n
