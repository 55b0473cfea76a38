"""Spelling variants: words one edit apart, found with k-d trees over letter counts.

1. Words are counted in blocks of text and summed by Spark.
2. For each length a top tree (fitted on a sample of at most about
   ``SAMPLE`` words, which only sets where it is cut) deals every word to one
   cell of about ``CELL`` words.  A cell that turns out larger is dealt by
   hash into parts.  A word also visits the cells of its own length and of
   the next length whose box lies within one edit; of two cells of one
   length only the lower visits the higher.
3. A cell is a k-d tree of its own: box-pruned range searches give the words
   at the right distance of letter counts, and the order of letters is verified.
4. Every search gives sums and the best word per word, never lists of pairs;
   they are combined before the shuffle.
5. Forms are followed by pointer doubling; occurrences grow at least fivefold
   along a chain, which bounds the rounds.

Edge cases: null and letterless texts have no words; a null id counts as the
empty string; repeated rows count each time; ties of occurrences go to the
smaller word; words of any length take part; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import blocks, write_shared
from tablegauge.llm.kdtree import Tree, Words, letter_counts, spelling

SAMPLE = 100_000
CELL = 1 << 14
LEAF = 128
_BLOCK = 4 << 20
_SHORT = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_CRC = _crc_table()


class Runs:
    """The letter runs of at least ``shortest`` letters of a block of texts:
    ``words`` (distinct, one byte a letter, A-Z lowered), ``word`` and ``doc`` of each run."""

    def __init__(self, texts: pa.Array, shortest: int):
        """:param texts: a binary array without nulls"""
        n = len(texts)
        off = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * texts.offset).astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        off -= off[0]
        lead = data == 0xC3                      # U+00C0 to U+00FF are this byte and another
        second = np.zeros(len(data), bool)
        second[1:] = lead[:-1]
        inside = _ASCII[data] | lead | second
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = off[:-1][off[:-1] < off[1:]]
        begins[heads] = inside[heads]
        at = np.flatnonzero(begins)
        doc = np.repeat(np.arange(n), np.diff(np.searchsorted(at, off)))
        kept = inside & ~lead
        place = np.append(np.cumsum(kept, dtype=np.int32)[at] - kept[at], np.count_nonzero(kept)).astype(np.int32)
        letters = np.where(second, data + np.uint8(0x40), _LOWER[data])[kept]
        spelt = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(place), pa.py_buffer(letters)])
        long = np.flatnonzero(np.diff(place) >= shortest)
        coded = spelt.take(pa.array(long)).dictionary_encode()
        self.words, self.word, self.doc = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), doc[long]


def _checksums(names: list[str], runs: Runs) -> np.ndarray:
    """crc32 of ``<name>:<run>`` for every run: that of the name, carried over
    the run's bytes, and that of the run, combined."""
    utf8 = [w.decode("latin-1").encode() for w in runs.words]
    size = np.fromiter(map(len, utf8), np.int64, len(utf8))
    crc = np.fromiter(map(zlib.crc32, utf8), np.uint32, len(utf8))
    start = np.fromiter((zlib.crc32(f"{x}:".encode()) for x in names), np.uint32, len(names))
    carried = np.zeros((_SHORT + 1, len(names)), np.uint32)
    carried[0] = start
    for i in range(_SHORT):
        carried[i + 1] = _CRC[carried[i] & 255] ^ (carried[i] >> np.uint32(8))
    length = size[runs.word]
    out = carried[np.minimum(length, _SHORT), runs.doc] ^ crc[runs.word]
    for i in np.flatnonzero(length > _SHORT):
        out[i] = zlib.crc32(utf8[runs.word[i]], int(start[runs.doc[i]]))
    return out


def word_counts(df: DataFrame, shortest: int = 6, spoiled: int | None = 199, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``word, n``: letter runs of at least ``shortest`` letters.  Where
    ``spoiled`` divides the checksum of id and run, the letter at the
    checksum modulo the run's length is left out (None: nowhere)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text", _BLOCK):
            runs = Runs(b.column("text"), shortest)
            hit = np.zeros(len(runs.word), bool)
            counts: Counter = Counter()
            if spoiled:
                h = _checksums(b.column("id").to_pylist(), runs)
                hit = h % np.uint32(spoiled) == 0
                for i in np.flatnonzero(hit).tolist():
                    w = runs.words[runs.word[i]]
                    if len(w) > shortest:
                        at = int(h[i]) % len(w)
                        counts[w[:at] + w[at + 1:]] += 1
            whole = np.bincount(runs.word[~hit], minlength=len(runs.words)).tolist()
            for w, n in zip(runs.words, whole):
                if n:
                    counts[w] += n
            yield pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in counts], pa.string()),
                                              "n": pa.array(list(counts.values()), pa.int64())})

    rows = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                     F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class _Cells:
    """The top trees by length and where their cells' parts and tasks are."""

    def __init__(self, sample: list[str], weight: float):
        by_length = defaultdict(list)
        for w in sample:
            by_length[len(w)].append(w)
        self.trees, self.first, n = {}, {}, 0
        for length, words in sorted(by_length.items()):
            tree = Tree(letter_counts(spelling(words)), CELL, weight)
            self.first[length], self.trees[length] = n, tree
            n += len(tree.members)
            tree.members = []
        self.n = n

    def home(self, length: int, counts: np.ndarray) -> np.ndarray:
        """Every word's own cell; words of a length that the sample lacks have one cell for the length."""
        out = np.full(len(counts), -length, np.int64)
        if length in self.trees:
            for leaf, idx in self.trees[length].search(counts, 0, 0):
                out[idx] = self.first[length] + leaf
        return out

    def visits(self, length: int, counts: np.ndarray, less: int) -> Iterator[tuple[int, np.ndarray]]:
        if length not in self.trees:
            yield -length, np.arange(len(counts))
            return
        for leaf, idx in self.trees[length].search(counts, 1, less):
            yield self.first[length] + leaf, idx


def _by_length(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    words = b.column("word").to_pylist()
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        spelt = spelling([words[i] for i in at])
        yield int(length), at, spelt, letter_counts(spelt)


def _best(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs (a, b): each a, how many b it has, and its b of the largest n (ties: the first)."""
    order = np.lexsort((b, -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    return a[first], np.diff(np.append(first, len(a))), b[first]


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best`` (a struct of negative ``n`` and ``word``) of
    every word that has a word one edit away.

    :param words: ``word`` (distinct, of a-z and U+00C0 to U+00FF) and ``n``, best a written table
    """
    total = words.count()
    if not total:
        return words.select("word", F.lit(0).cast("long").alias("n_near"), F.struct(F.col("n").alias("less"), "word").alias("best"))
    every = max(1, round(total / SAMPLE))
    sample = [r.word for r in words.filter(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").collect()]
    cells = _Cells(sample, float(every))

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for length, _, _, counts in _by_length(b):
                cell, n = np.unique(cells.home(length, counts), return_counts=True)
                yield pa.RecordBatch.from_pydict({"cell": cell, "n": n})

    sizes = {r.cell: r.n for r in words.select("word").mapInArrow(at_home, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    parts = {c: -(-n // CELL) for c, n in sizes.items()}
    first, order = {}, 0
    for c in sorted(parts):
        first[c], order = order, order + parts[c]
    # the largest parts first, each to the task with the fewest words
    tasks = max(1, -(-total // (CELL // 2)))
    load, task = [0] * tasks, {}
    for c in sorted(sizes, key=lambda c: -sizes[c] / parts[c]):
        for p in range(parts[c]):
            t = load.index(min(load))
            task[first[c] + p] = t
            load[t] += sizes[c] // parts[c] + 1

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []                             # row, part, whether it visits
            for length, at, spelt, counts in _by_length(b):
                home = cells.home(length, counts)
                share = np.array([zlib.crc32(x.tobytes()) for x in spelt], np.int64)
                own = np.array([first[c] + s % parts[c] for c, s in zip(home.tolist(), share.tolist())], np.int64)
                out.append((at, own, np.zeros(len(at), bool)))
                for other, less in ((length, 1), (length + 1, 0)):
                    for cell, idx in cells.visits(other, counts, less):
                        for p in range(parts.get(cell, 0)):
                            some = idx[own[idx] < first[cell] + p] if other == length else idx
                            out.append((at[some], np.full(len(some), first[cell] + p), np.ones(len(some), bool)))
            row, part, visits = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_pydict({
                "task": np.array([task[p] for p in part.tolist()], np.int32), "part": part, "visits": visits,
                "word": b.column("word").take(pa.array(row)), "n": b.column("n").take(pa.array(row))})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names, tree = None, [], None       # the part's words; their tree once all are there
        nums = np.zeros(0, np.int64)

        def told(spelt_names, a, b, n, names_b) -> pa.RecordBatch:
            word, near, best = _best(a, b, n)
            return pa.RecordBatch.from_pydict({
                "word": pa.array([spelt_names[i] for i in word], pa.string()), "near": near.astype(np.int64),
                "less": -n[best], "best": pa.array([names_b[i] for i in best], pa.string())})

        def own():
            """The part's tree, and what its words find among themselves."""
            tree = Words(names, LEAF)
            a, b = tree.near(tree.spelt, tree.counts)
            return tree, told(names, a, b, nums, names)

        for batch in batches:
            at, visits, n = batch.column("part").to_numpy(), batch.column("visits").to_numpy(zero_copy_only=False), batch.column("n").to_numpy()
            words = batch.column("word").to_pylist()
            edge = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (visits[1:] != visits[:-1])]))
            for i, j in zip(edge.tolist(), [*edge[1:].tolist(), len(at)]):
                if at[i] != part:
                    if names and tree is None:
                        yield own()[1]
                    part, names, tree, nums = at[i], [], None, np.zeros(0, np.int64)
                if not visits[i]:
                    names += words[i:j]
                    nums = np.concatenate([nums, n[i:j]])
                    continue
                if tree is None:
                    tree, rows = own()
                    yield rows
                for size in (len(names[0]), len(names[0]) - 1):
                    some = [k for k in range(i, j) if len(words[k]) == size]
                    if some:
                        guests = [words[k] for k in some]
                        spelt = spelling(guests)
                        a, b = tree.near(spelt, letter_counts(spelt))
                        yield told(guests, a, b, nums, names)
                        yield told(names, b, a, n[some], guests)
        if names and tree is None:
            yield own()[1]

    routed = words.select("word", "n").mapInArrow(route, "task int, part long, visits boolean, word string, n long")
    found = routed.repartitionById(tasks, F.col("task")).sortWithinPartitions("part", "visits", "word") \
        .mapInArrow(search, "word string, near long, less long, best string")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("less", F.col("best").alias("word"))).alias("best"))


def variants(df: DataFrame, shortest: int = 6, least: int = 5, ratio: int = 5, spoiled: int | None = 199,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word with ``least``
    occurrences: its form is its most frequent near word, if that occurs
    ``ratio`` times as often; its root is where forms lead."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2, so that forms can't go in circles")
    spark = df.sparkSession
    words = word_counts(df, shortest, spoiled, id_col, text_col).filter(F.col("n") >= least)
    words = spark.read.parquet(write_shared(words, "words"))
    near = spark.read.parquet(write_shared(near_words(words), "near"))
    joined = words.join(near, "word", "left")
    form_n = -F.col("best.less")
    has = form_n.cast("decimal(20,0)") >= F.col("n").cast("decimal(20,0)") * ratio
    rows = joined.select("word", F.when(has, F.col("best.word")).alias("form"), "n",
                         F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, form_n).alias("form_n"))
    rows = spark.read.parquet(write_shared(rows, "forms"))
    top = rows.agg(F.max("n")).first()[0] or 1
    links = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(1.0, math.log(top, ratio)) + 1))):   # a chain has at most log(top) links
        further = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        links = spark.read.parquet(write_shared(
            links.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots"))
    return rows.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
