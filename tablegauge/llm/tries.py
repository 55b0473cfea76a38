"""Double-array tries of word sequences, advanced for all text positions at once.

A phrase's symbols are the base-256 digits of its words' numbers in the
trie's own vocabulary, most significant first.  Child ``s`` of the node at
slot ``x`` is the slot ``base[x] + s`` if ``check`` of that slot is ``x``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RADIX = 256
_WINDOW = 256


class Trie:
    """The phrases of one length: ``phrases`` holds words joined by one
    space, ``langs`` the language of each (a root of its own)."""

    def __init__(self, langs: pa.Array, phrases: pa.Array, size: int):
        self.size, self.phrases, self.lang_of = size, phrases, langs
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary
        words = pc.split_pattern(phrases, " ").flatten().dictionary_encode()
        self.vocabulary = words.dictionary
        v, self.digits = len(self.vocabulary), 1
        while _RADIX ** self.digits < v:
            self.digits += 1
        self.last = self.vocabulary.take(words.indices[size - 1::size]) if len(phrases) else self.vocabulary
        numbers = words.indices.to_numpy().astype(np.int64).reshape(len(phrases), size)
        shifts = 8 * np.arange(self.digits - 1, -1, -1)
        symbols = ((numbers[:, :, None] >> shifts) & 255).reshape(len(phrases), size * self.digits)
        self._build(coded.indices.to_numpy().astype(np.int64), symbols)

    def _build(self, roots: np.ndarray, symbols: np.ndarray) -> None:
        n_roots = len(self.langs)
        room = 2 * _RADIX + n_roots + 2 * symbols.size
        self.base, self.check, used = np.zeros(room, np.int64), np.full(room, -1, np.int64), np.zeros(room, bool)
        used[:_RADIX + n_roots] = True           # children lie above, so no base is negative
        slot = roots + _RADIX
        for j in range(symbols.shape[1]):
            edge, inverse = np.unique(slot * _RADIX + symbols[:, j], return_inverse=True)
            parent, symbol = edge // _RADIX, edge % _RADIX
            first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(edge) else np.zeros(0, int)
            count = np.diff(np.append(first, len(edge)))
            used = self._place(parent[first], symbol, first, count, used)
            child = self.base[parent] + symbol
            self.check[child] = parent
            slot = child[inverse]
        top = int(np.flatnonzero(used)[-1]) + 1 + _RADIX
        self.base, self.check = self.base[:top].astype(np.int32), self.check[:top].astype(np.int32)
        self.phrase = np.full(top, -1, np.int32)
        self.phrase[slot] = np.arange(len(slot))

    def _room(self, n: int, used: np.ndarray) -> np.ndarray:
        if n <= len(used):
            return used
        more = max(n, 2 * len(used)) - len(used)
        self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
        self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
        return np.concatenate([used, np.zeros(more, bool)])

    def _place(self, parents, symbol, first, count, used) -> np.ndarray:
        """Give every parent a base at which all its children find free slots."""
        order = np.argsort(-count, kind="stable")
        at, width = _RADIX, _RADIX + 1
        for p in order[count[order] > 1]:
            if 2 * count[p] <= width:            # smaller families look into the gaps again
                at, width = int(np.argmin(used)), int(count[p])
            kids = symbol[first[p]:first[p] + count[p]]
            while True:
                used = self._room(at + _WINDOW + 2 * _RADIX, used)
                fits = ~used[at:at + _WINDOW]
                for k in (kids[1:] - kids[0]):
                    fits = fits & ~used[at + k:at + k + _WINDOW]
                if fits.any():
                    base = at + int(np.argmax(fits)) - kids[0]
                    break
                at += _WINDOW
            self.base[parents[p]] = base
            used[base + kids] = True
        alone = np.flatnonzero(count == 1)
        used = self._room(len(used) + len(alone), used) if (~used).sum() < len(alone) + _RADIX else used
        free = np.flatnonzero(~used)[:len(alone)]
        self.base[parents[alone]] = free - symbol[first[alone]]
        used[free] = True
        return self._room(int(free[-1] if len(free) else 0) + 2 * _RADIX, used)

    def advance(self, lang: np.ndarray, word: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """The number of the phrase that starts at each text position, or -1.

        :param lang: number of the language in ``langs``, -1 for others
        :param word: number of the word in ``vocabulary``, -1 for others
        :param piece: number of the piece; phrases lie inside one
        """
        n, out = len(word), np.full(len(word), -1, np.int64)
        last = n - self.size + 1
        if last <= 0 or not len(self.phrases):
            return out
        at = np.flatnonzero((lang[:last] >= 0) & (word[:last] >= 0) & (piece[:last] == piece[self.size - 1:]))
        state = lang[at] + _RADIX
        for j in range(self.size):
            number = word[at + j]
            known = number >= 0
            at, state, number = at[known], state[known], number[known]
            for d in range(self.digits - 1, -1, -1):
                step = self.base[state] + ((number >> (8 * d)) & 255)
                lives = self.check[step] == state
                at, state, number = at[lives], step[lives], number[lives]
        out[at] = self.phrase[state]
        return out
