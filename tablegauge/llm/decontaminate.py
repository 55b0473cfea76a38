"""Benchmark decontamination by q-gram lemma filtering.

Texts are lower-cased and blanks are squeezed.  An item of ``m`` characters
may occur in a document with up to ``k = floor(edit_rate * m)`` edits.  Each
edit spoils at most ``q`` of the item's ``m - q + 1`` q-grams, so a region
within the budget shares at least ``t = m - q + 1 - k * q`` of them, on
diagonals that drift by at most ``k``:

1. q-grams of the document are looked up in the items' q-grams and counted
   for each item in diagonal bands of at least ``k`` diagonals, which overlap
   by ``k``;
2. bands with at least ``t`` shared q-grams are retained (``k`` is lowered
   where needed so that ``t`` stays at least 1);
3. retained regions are verified by alignment inside the band.

Nothing within the budget is lost.  The items are the stated query set: they
are sent to the tasks in parts of bounded size, one at a time, and every
part runs over all documents.  Long texts are scanned in overlapping pieces.  Items under
``q`` characters name no passage: they match only a document that is the
item as a whole.

Edge cases: null and blank texts match nothing, nor do null or blank items;
repeated documents and items each get their rows, null ids stay null; an
empty table on either side gives no match; other columns are kept by
``clean`` and not read by ``matches``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import blocks, fresh, trimmed, write_shared
from tablegauge.llm.wordhash import _Powers, mix

Q = 8
EDIT_RATE = 0.1
#: Characters of items that are sent to the tasks at a time.
ITEM_BLOCK_CHARS = 4 << 20

_BAND = 6                      # least diagonals to a band, as a power of two
_SLOTS = 20                    # bits of the q-gram table's address
_PIECE = 1 << 16               # characters scanned at once
_BINS = 1 << 22
_FAR = 1 << 20
_POWERS = _Powers(0x9E3779B97F4A7C15)
_CHARACTER: np.ndarray | None = None


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _qgrams(codes: np.ndarray, q: int) -> np.ndarray:
    """Slot of each q-gram: the high bits of a sum of random numbers times powers."""
    global _CHARACTER
    if _CHARACTER is None:
        _CHARACTER = mix(np.arange(0x110000, dtype=np.uint64) + np.uint64(1))
    n = len(codes)
    if n < q:
        return np.zeros(0, np.int64)
    _POWERS.need(n + 1)
    s = np.zeros(n + 1, np.uint64)
    values = _CHARACTER[codes]
    values *= _POWERS.up[:n]
    np.cumsum(values, out=s[1:])
    h = s[q:] - s[:-q]
    h *= _POWERS.down[:n - q + 1]
    h >>= np.uint64(64 - _SLOTS)
    return h.view(np.int64)


@dataclass
class Match:
    item: int                  # place in the index
    distance: int
    start: int                 # in the normalised text
    end: int


class ItemIndex:
    """The items' q-grams by slot, with each item's budget."""

    def __init__(self, items: list[tuple], q: int = Q, edit_rate: float = EDIT_RATE):
        self.q = q
        texts = [(key, normalise(t)) for key, t in items]
        self.short = [(i, k, t) for i, (k, t) in enumerate(texts) if 0 < len(t) < q]
        self.keys = [k for k, _ in texts]
        self.texts = [t for _, t in texts]
        m = np.array([len(t) for t in self.texts], np.int64)
        self.size = m
        self.budget = np.clip(np.minimum((edit_rate * m + 1e-9).astype(np.int64), (m - q) // q), 0, None)
        self.need = np.where(m >= q, np.maximum(m - q + 1 - self.budget * q, 1), _FAR)
        self.longest, self.drift = int(m.max(initial=0)), int(self.budget.max(initial=0))
        # a region drifts by k at most: a band of k diagonals or more and its overlap hold it
        self.band = np.array([max(_BAND, (int(k) - 1).bit_length()) if k else _BAND for k in self.budget], np.int64)
        self.widest = 1 << int(self.band.max(initial=_BAND))
        grams = [_qgrams(_codes(t), q) for t in self.texts]
        slot = np.concatenate([*grams, np.zeros(0, np.int64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)])
        order = np.argsort(slot, kind="stable")
        self.item, self.place = item[order].astype(np.int64), place[order].astype(np.int64)
        self.count = np.bincount(slot, minlength=1 << _SLOTS).astype(np.int32)
        self.used = self.count > 0
        self.begin = np.concatenate([[0], np.cumsum(self.count)[:-1]])

    def _retained(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """Item and first diagonal of the bands that meet the bound."""
        slot = _qgrams(codes, self.q)
        at = np.flatnonzero(self.used[slot])
        if not len(at):
            return []
        slot = slot[at]
        n, shift = self.count[slot], self.longest + self.widest
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = np.repeat(self.begin[slot], n) + inside
        item = self.item[hit]
        diagonal = np.repeat(at, n) - self.place[hit] + shift
        bands = (len(codes) + shift >> _BAND) + 1
        band = self.band[item]
        key = item * bands + (diagonal >> band)
        overlap = (diagonal & (1 << band) - 1) < self.budget[item]
        key = np.concatenate([key, key[overlap] - 1])
        hit = np.concatenate([hit, hit[overlap]])
        if len(self.keys) * bands <= _BINS:
            shared = np.bincount(key, minlength=len(self.keys) * bands)[key]
        else:
            _, of, shared = np.unique(key, return_inverse=True, return_counts=True)
            shared = shared[of]
        keep = shared >= self.need[key // bands]
        # of an item's q-grams each counts once, however often the region repeats it
        key, hit = key[keep], hit[keep]
        key = np.unique(key * (self.longest + 1) + self.place[hit]) // (self.longest + 1)
        key, shared = np.unique(key, return_counts=True)
        key = key[shared >= self.need[key // bands]]
        item = key // bands
        return list(zip(item.tolist(), ((key % bands << self.band[item]) - shift).tolist()))

    def scan(self, texts: list[str | None]) -> list[list[Match]]:
        """For each text its best match with every item that it holds."""
        best: list[dict[int, Match]] = [{} for _ in texts]
        overlap = self.longest + 2 * self.drift + 2 * self.widest
        held: list[tuple[int, int, str]] = []
        size = 0

        def flush():
            nonlocal held, size
            if held:
                self._scan_pieces(held, best)
            held, size = [], 0

        for i, t in enumerate(texts):
            t = normalise(t)
            for j, _, s in self.short:
                if t == s:
                    best[i][j] = Match(j, 0, 0, len(t))
            at = 0
            while len(t) - at >= self.q:
                piece = t[at:at + max(_PIECE, 4 * overlap)]
                if size and size + len(piece) > _PIECE:
                    flush()
                held.append((i, at, piece))
                size += len(piece) + 1
                if at + len(piece) >= len(t):
                    break
                at += len(piece) - overlap
        flush()
        return [sorted(b.values(), key=lambda x: (x.start, x.item)) for b in best]

    def _scan_pieces(self, pieces: list[tuple[int, int, str]], best: list[dict[int, Match]]) -> None:
        joined = "\x00".join(p for _, _, p in pieces)        # no item holds this character
        starts = np.cumsum([0] + [len(p) + 1 for _, _, p in pieces])
        for item, first in self._retained(_codes(joined)):
            text, k = self.texts[item], int(self.budget[item])
            last = first + (1 << int(self.band[item])) + k
            lo, hi = max(0, first - k), last + len(text) + k
            a = max(0, int(np.searchsorted(starts, lo, "right")) - 1)
            while a < len(pieces) and starts[a] < hi:
                i, at, piece = pieces[a]
                base = int(starts[a])
                found = best[i].get(item)
                if found is None or found.distance:
                    got = align(text, piece, first - base - k, last - base + k, k)
                    if got and (found is None or (got[0], at + got[1]) < (found.distance, found.start)):
                        best[i][item] = Match(item, got[0], at + got[1], at + got[2])
                a += 1


def align(item: str, text: str, first: int, last: int, k: int) -> tuple[int, int, int] | None:
    """Least edits of ``item`` against any part of ``text`` with diagonals
    from ``first`` to ``last``, if at most ``k``: edits, start, end."""
    m, n = len(item), len(text)
    first, last = max(first, -m), min(last, n)
    if first > last:
        return None
    lo, hi = max(0, first), min(n, last + m)
    at = text.find(item, lo, hi)
    if at >= 0:
        return 0, at, at + m
    if not k or hi - lo < m - k:
        return None
    d = np.arange(first, last + 1)
    t, s = _codes(text), _codes(item)
    cost = np.where((d >= 0) & (d <= n), 0, _FAR)
    start, steps = d.copy(), np.arange(len(d))
    for i in range(1, m + 1):
        j = i + d
        real = (j >= 1) & (j <= n)
        sub = np.where(real, cost + (t[np.clip(j - 1, 0, n - 1)] != s[i - 1]), _FAR)
        skip = np.append(cost[1:] + 1, _FAR)
        skip[(j < 0) | (j > n)] = _FAR
        use = skip < sub
        cost, start = np.where(use, skip, sub), np.where(use, np.append(start[1:], 0), start)
        lead = cost - steps                     # characters of the text that the item lacks
        least = np.minimum.accumulate(lead)
        source = np.maximum.accumulate(np.where(lead == least, steps, 0))
        cost, start = np.where((j < 0) | (j > n), _FAR, least + steps), start[source]
        if cost.min() > k:
            return None
    b = int(np.argmin(cost))
    return (int(cost[b]), int(start[b]), int(m + d[b])) if cost[b] <= k else None


def _item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> list[DataFrame]:
    """The items in parts of about ``block_chars`` characters, by hash."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    n = -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars)
    return [rows if n == 1 else rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b) for b in range(n)]


def _send(part: DataFrame, q: int, edit_rate: float) -> Broadcast:
    """The index of one part of the items, bounded by its characters."""
    rows = sorted((r.id is not None, r.id or 0, r.text) for r in part.collect())
    return part.sparkSession.sparkContext.broadcast(ItemIndex([(k if has else None, t) for has, k, t in rows], q, edit_rate))


def _one_at_a_time(parts: list[DataFrame], q: int, edit_rate: float, search: Callable[[Broadcast], DataFrame], name: str) -> DataFrame:
    """The rows that ``search`` finds with every part.  Of several parts each
    result is written before the next index is built, so the driver and the
    tasks hold one index at a time, whatever the number of items."""
    if len(parts) == 1:
        return search(_send(parts[0], q, edit_rate))
    paths = []
    for part in parts:
        index = _send(part, q, edit_rate)
        paths.append(write_shared(search(index), name))
        index.destroy()
    spark = parts[0].sparkSession
    return spark.read.schema(spark.read.parquet(paths[0]).schema).parquet(*paths)


def matches(docs: DataFrame, items: DataFrame, q: int = Q, edit_rate: float = EDIT_RATE, id_col: str = "doc_id",
            text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
            block_chars: int = ITEM_BLOCK_CHARS) -> DataFrame:
    """One row for each document and item that it holds: ``doc_id, item_id``,
    the least ``distance`` and its place in the normalised text (of equal
    distances the first place)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, distance int, start long, end long, item_chars int"
    parts = _item_blocks(items, item_id_col, item_text_col, block_chars)
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)

    def search(index: Broadcast) -> DataFrame:
        @trimmed
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in blocks(batches, "text"):
                found = index.value.scan(b.column("text").to_pylist())
                got = [(key, index.value.keys[x.item], x.distance, x.start, x.end, int(index.value.size[x.item]))
                       for key, xs in zip(b.column("id").to_pylist(), found) for x in xs]
                if got:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
                    names = ["doc_id", "item_id", "distance", "start", "end", "item_chars"]
                    yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, t, c in zip(names, kinds, zip(*got))})
        return rows.mapInArrow(run, schema)

    return _one_at_a_time(parts, q, edit_rate, search, "matches")


def clean(docs: DataFrame, items: DataFrame, q: int = Q, edit_rate: float = EDIT_RATE, text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text", block_chars: int = ITEM_BLOCK_CHARS) -> DataFrame:
    """The documents, all columns, that hold no item.  With several parts of
    items the rows are numbered and written first, and those that hold an
    item go by their number."""
    parts = _item_blocks(items, item_id_col, item_text_col, block_chars)
    if not parts:
        return docs
    if len(parts) == 1:
        index = _send(parts[0], q, edit_rate)

        @trimmed
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in blocks(batches, text_col):
                yield b.filter(pa.array([not x for x in index.value.scan(b.column(text_col).to_pylist())]))
        return docs.mapInArrow(keep, docs.schema)
    row, gone = fresh(docs, "row", "gone")
    numbered = docs.sparkSession.read.parquet(write_shared(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"))
    rows = numbered.select(F.col(row).alias("at"), F.col(text_col).alias("text"))

    def search(index: Broadcast) -> DataFrame:
        @trimmed
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in blocks(batches, "text"):
                yield b.select(["at"]).filter(pa.array([bool(x) for x in index.value.scan(b.column("text").to_pylist())]))
        return rows.mapInArrow(run, "at long")

    holding = _one_at_a_time(parts, q, edit_rate, search, "holding").select(F.col("at").alias(gone))
    return numbered.join(holding, F.col(row) == F.col(gone), "left_anti").drop(row)
