"""SimHash near-dedup with pivot distance tables.

Fingerprints are linked at ``max_bits`` or fewer differing bits.  For a set
of reference fingerprints (pivots) the Hamming distances of every distinct
fingerprint are tabulated.  Two linked fingerprints differ by at most
``max_bits`` in every coordinate of that table.  The pivots come as bases
and as the same bases with one block of bits turned over, so the difference
of two coordinates is the distance inside a block, and linked fingerprints
agree in those coordinates for all blocks but ``max_bits`` of them:

1. fingerprints that agree in the coordinates of all blocks but
   ``max_bits`` (for each choice of these) are candidates, found by an equi-join;
2. pairs whose largest coordinate difference exceeds ``max_bits`` are discarded;
3. survivors are verified on the bits.

Groups with more than ``PAIR_GROUP`` fingerprints under one key (large
groups of near copies) are not expanded into pairs.  Their members are
joined through the places (fingerprints) that they reach by flips inside the
free blocks, half of ``max_bits`` of them, rounded up.  Any two linked
members meet at a place that one of them reaches by the half rounded down;
such a member is linked to all that meet there, so the least one is joined
to each of them.  This second way is exact too, and linear in the group: at
most 65 fingerprints can meet at one place (2,081 above two bits).

Exact copies share a fingerprint and are handled once; components come from
star contractions over distinct fingerprints.

Edge cases: null and blank texts have no words and fingerprint zero, linked
like any other; fewer words than a shingle needs make one shingle; repeated
ids or rows each get a row; null ids stay null and don't count as smallest
id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import blocks, cut_lineage, trimmed
from tablegauge.llm.components import connected_components

SEED = 42
BITS = 64
BASES = 4
PAIR_GROUP = 8


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text (UTF-8), unsigned."""
    import xxhash
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    ends = ends[shingle - 1:] - 1
    digest, count, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(ends)
    for i in range(0, total, 1 << 15):
        cuts = zip(starts[i:i + (1 << 15)].tolist(), ends[i:i + (1 << 15)].tolist())
        h = np.array([digest(joined[a:b], SEED) for a, b in cuts], dtype="<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((1 << np.flatnonzero(2 * count > total).astype(object)).sum() or 0)


def fingerprints(df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``; ``fp`` holds the 64 bits as a signed long."""
    @trimmed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            fps = [fingerprint(t or b"", shingle) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("id"), "fp": pa.array(np.array(fps, dtype=np.uint64).view(np.int64))})

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Pivots:
    """The reference fingerprints and what their distance table tells."""

    def __init__(self, max_bits: int):
        n = max_bits + 3
        cuts = [BITS * i // n for i in range(n + 1)]
        self.blocks = [((1 << b) - (1 << a), b - a) for a, b in zip(cuts, cuts[1:])]
        rng = np.random.default_rng(SEED)
        self.bases = [int(x) for x in rng.integers(0, 1 << 64, BASES, dtype=np.uint64)]
        self.max_bits = max_bits

    @staticmethod
    def distance(fp: Column, ref: int) -> Column:
        return F.bit_count(fp.bitwiseXOR(F.lit(_signed(ref))))

    def references(self) -> list[int]:
        return [x for base in self.bases for x in (base, *(base ^ mask for mask, _ in self.blocks))]

    def in_block(self, fp: Column, base: int, block: int) -> Column:
        """Distance to ``base`` inside a block, from two coordinates."""
        mask, width = self.blocks[block]
        return ((self.distance(fp, base) - self.distance(fp, base ^ mask) + width) / 2).cast("long")

    def keys(self, fp: Column) -> Column:
        """One struct for each choice of free blocks: the choice and the
        packed coordinates of all other blocks (5 bits each)."""
        out = []
        for k, free in enumerate(combinations(range(len(self.blocks)), self.max_bits)):
            coords = [self.in_block(fp, base, b) for b in range(len(self.blocks)) if b not in free for base in self.bases]
            packed = []
            for i in range(0, len(coords), 12):
                x = F.lit(0).cast("long")
                for c in coords[i:i + 12]:
                    x = F.shiftleft(x, 5).bitwiseOR(c)
                packed.append(x.alias(f"k{i // 12}"))
            out.append(F.struct(F.lit(k).alias("free"), *packed))
        return F.array(*out)

    def key_names(self) -> list[str]:
        n = (len(self.blocks) - self.max_bits) * BASES
        return ["free", *(f"k{i}" for i in range((n + 11) // 12))]

    def far(self, a: Column, b: Column) -> Column:
        """Largest coordinate difference of two fingerprints' tables."""
        return F.greatest(*(F.abs(self.distance(a, r) - self.distance(b, r)) for r in self.references()))

    def free_masks(self) -> list[int]:
        return [sum(self.blocks[b][0] for b in free) for free in combinations(range(len(self.blocks)), self.max_bits)]


def links(distinct: DataFrame, max_bits: int = 2, pair_group: int = PAIR_GROUP) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all links among the
    distinct fingerprints ``fp``; every edge is a link, or leads over one meeting place."""
    if not 1 <= max_bits <= 4:
        raise ValueError("max_bits must be from 1 to 4")
    pivots = Pivots(max_bits)
    names = pivots.key_names()
    members = distinct.select("fp", F.explode(pivots.keys(F.col("fp"))).alias("key")).select("fp", "key.*")
    sizes = members.groupBy(*names).agg(F.count("*").alias("size")).filter("size > 1")
    groups = cut_lineage(members.join(sizes, names))
    small = groups.filter(F.col("size") <= pair_group)
    a, b = small.select(*names, F.col("fp").alias("a")), small.select(*names, F.col("fp").alias("b"))
    pairs = a.join(b, names).filter("a < b").filter(pivots.far(F.col("a"), F.col("b")) <= max_bits) \
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")
    bits = F.array(*(F.array(*(F.lit(i) for i in range(BITS) if mask >> i & 1)) for mask in pivots.free_masks()))
    reach = groups.filter(F.col("size") > pair_group) \
        .select("fp", F.col("fp").alias("place"), F.element_at(bits, F.col("free") + 1).alias("bits"), F.lit(-1).alias("last"))
    at = reach.select("fp", "place")
    for _ in range((max_bits + 1) // 2):
        reach = reach.select("fp", "place", "bits", F.explode(F.filter("bits", lambda i: i > F.col("last"))).alias("last")) \
            .withColumn("place", F.expr("place ^ shiftleft(1L, last)"))
        at = at.union(reach.select("fp", "place"))
    beyond = F.bit_count(F.col("fp").bitwiseXOR(F.col("place"))) > max_bits // 2
    met = at.distinct().groupBy("place").agg(F.collect_list("fp").alias("fps"), F.min(F.when(~beyond, F.col("fp"))).alias("a")) \
        .filter("size(fps) > 1 and a is not null")
    hubs = met.select("a", F.explode("fps").alias("b")).filter("a <> b")
    return pairs.union(hubs)


def near_duplicates(df: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text", pair_group: int = PAIR_GROUP) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` and ``component_id``, the
    smallest id that links reach from it, itself included."""
    fps = cut_lineage(fingerprints(df, shingle, id_col, text_col))
    distinct = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = cut_lineage(connected_components(links(distinct, max_bits, pair_group)))
    first = distinct.join(roots, distinct.fp == roots.node, "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    # only fingerprints in a component of several need its smallest id
    least = first.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = first.join(least, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
