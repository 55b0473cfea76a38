"""Token ids of whole texts, through the ``tokenizers`` library.

A byte-level tokenizer never merges across its split pattern, so a text
without adjacent blanks is encoded as the sequence of its blank-led words.
Every distinct word goes through the library once and its ids are kept (up
to a bound, then once per block); any other text goes through the library whole.  Both ways give the
library's ids of the whole text (tests compare them).  Strings of special
tokens in a text are ordinary text.
"""

from __future__ import annotations

import gc
import json
import os

import numpy as np

from tablegauge.llm.common import KEPT

#: Blanks other than " " and "\n", and the mark used for cutting: such texts go through the library whole.
_RARE = ["\x00", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", " ",
         *map(chr, range(0x2000, 0x200b)), " ", " ", " ", " ", "　"]
_ADJACENT = ["  ", " \n", "\n ", "\n\n"]
#: Punctuation that may follow a word.
_TAIL = ".,!?;:$%&*#|)"


class TextEncoder:
    """``encode(texts)`` gives one ``uint32`` array per text.

    :param path: a ``tokenizers`` JSON file
    :param keep_words: when so many words' ids are kept, no more are added
    """

    def __init__(self, path: str, keep_words: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.vocab_size = self.tok.get_vocab_size()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (spec["model"]["type"] == "BPE" and not spec.get("normalizer") and not spec.get("post_processor")
                        and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        self.keep_words = keep_words
        if self.by_word:        # a byte-level token has one character for each byte
            self.n_bytes = np.zeros(self.vocab_size, dtype=np.int64)
            for token, i in self.tok.get_vocab().items():
                self.n_bytes[i] = len(token)
        self.known: dict[str, bytes] = {"": b""}

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids by word: many words go through the library as one text, which
        is then cut where the tokens' byte lengths reach the words' ends."""
        out = {w: self._library([w])[0].tobytes() for w in words if w.isspace()}
        words = [w for w in words if not w.isspace()]
        for i in range(0, len(words), 20_000):
            part = words[i:i + 20_000]
            first = [0 if w[0] == " " else 1 for w in part]      # a line break keeps a word without blank apart
            ids = self._library(["".join("\n" + w if f else w for f, w in zip(first, part))])[0]
            ends = np.cumsum([len(w.encode()) + f for f, w in zip(first, part)])
            cut = np.concatenate([[0], np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1])
            raw = ids.tobytes()
            out.update(zip(part, (raw[4 * (a + f):4 * b] for a, b, f in zip(cut[:-1].tolist(), cut[1:].tolist(), first))))
        return out

    def _new_words(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words not met before.  Punctuation after a letter or digit
        is split off by the tokenizer, so such a word is its stem and its tail."""
        parts = {}
        for w in words:
            stem = w.rstrip(_TAIL)
            if stem and len(stem) < len(w) and stem[-1].isalnum():
                parts[w] = stem, w[len(stem):]
        need = words.difference(parts).union(*parts.values()) if parts else words
        ids = self._words([w for w in need if w not in self.known])
        get = self.known.get
        for w, (stem, tail) in parts.items():
            ids[w] = (ids.get(stem) or get(stem)) + (ids.get(tail) or get(tail))
        return ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        on = gc.isenabled()
        gc.disable()            # lists of a million words and no cycles: nothing to collect
        try:
            return self._encode(texts)
        finally:
            if on:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        get = self.known.get
        cut: list[tuple[list, list[int], list[str]] | None] = []       # ids, their gaps, the words there
        for t in texts:
            if not self.by_word or any(x in t for x in _ADJACENT) or any(x in t for x in _RARE):
                cut.append(None)
            else:
                words = t.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
                ids = list(map(get, words))
                gaps = [i for i, x in enumerate(ids) if x is None]
                cut.append((ids, gaps, [words[i] for i in gaps]))
        new = {w for c in cut if c for w in c[2]}
        if new:
            found = self._new_words(new)
            for ids, gaps, words in filter(None, cut):
                for i, w in zip(gaps, words):
                    ids[i] = found[w]
            if len(self.known) < self.keep_words:
                self.known.update(found)
        whole = iter(self._library([t for t, c in zip(texts, cut) if c is None]))
        return [next(whole) if c is None else np.frombuffer(b"".join(c[0]), dtype=np.uint32) for c in cut]


def encoder(path: str) -> TextEncoder:
    """The encoder of a Python worker, made once and kept while the worker's tasks encode."""
    made = KEPT.setdefault("encoders", {})
    if path not in made:
        made[path] = TextEncoder(path)
    return made[path]
