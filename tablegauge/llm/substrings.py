"""Substring dedup: seed and extend on winnowed anchors.

A window is ``window`` consecutive words; words under a window whose word
sequence starts anywhere else too are removed.

* Seed: the anchor of a window is its leftmost least ``seed``-word hash.
  Equal windows have equal anchors at equal places, so only anchors that
  occur twice matter; an anchor covers a run of consecutive windows.
* Join on the anchor.  A run's *segment* is all its words.  Where two
  occurrences agree in the whole segment they agree in all its windows: the
  match extends over the whole segment both ways.  Segments that occur
  twice are settled there, whatever the number of occurrences.
* Extend: segments that occur once beside other segments of their anchor
  (the ends of a match) are compared window by window, which gives the
  exact end of the maximal repeat on either side.
* Runs of repeated windows are the maximal repeats of at least ``window`` words.

Anchors, segments and windows are compared by count aggregates that combine
before the shuffle and by equi-joins with one row for each key on one side,
so a passage that a third of all documents share is a skewed join that the
adaptive planner splits, never a group in one task.  No pairs of documents
are formed.  Windows are told apart by two hashes that share neither the
hash of a word nor a modulus' base (:mod:`tablegauge.llm.runhash`).

Edge cases: null, blank and short texts have no window and lose nothing;
repeated rows repeat each other's windows; null ids are handled like ids;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import blocks, write_shared
from tablegauge.llm.runhash import Runs
from tablegauge.llm.wordhash import least_places, mix

#: Words of an anchor; a window holds window - SEED_WORDS + 1 candidates.
SEED_WORDS = 12
_SALTS = 8
#: Bytes of text a task hashes at a time (some 20 times that in arrays).
_BLOCK = 2 << 20


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``sum`` and ``text``: id and checksum name a row (rows that
    share both have the same text, hence the same repeats).  Where no id is
    null or repeated the checksum is left out, which makes every shuffle
    of places smaller."""
    key = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    named = df.groupBy(key.alias("id")).agg(F.count("*").alias("c")).filter("c > 1 or id is null").isEmpty()
    rows = df.select(F.coalesce(key, F.lit(-1)).alias("id"), text.alias("text"), key.isNull().alias("unnamed"))
    total = F.lit(0).cast("long") if named else F.when(F.col("unnamed"), -1).otherwise(1) * (F.crc32("text") + 1)
    return rows.select("id", total.alias("sum"), "text")


def _anchored(rows: DataFrame, window: int) -> DataFrame:
    """One row for each run of windows with one anchor: ``anchor``, ``seg``,
    the row's ``id`` and ``sum``, first window ``s`` and number of windows ``n``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text", _BLOCK):
            words = Runs(b.column("text"))
            total, first = words.total, words.first
            if total < window:
                continue
            gram = words.runs(np.arange(total - SEED_WORDS + 1), SEED_WORDS)
            place = least_places(gram, window - SEED_WORDS + 1)
            doc = np.repeat(np.arange(b.num_rows), np.diff(first))
            start = np.arange(total - window + 1)
            start = start[doc[start] == doc[start + window - 1]]
            if not len(start):
                continue
            anchor = place[start]
            new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
            at = np.flatnonzero(new)
            s, n = start[at], np.diff(np.append(at, len(start)))
            a, d = anchor[at], doc[start[at]]
            seg = mix(words.runs(s, n - 1 + window, 1) + mix(((a - s) * 4096 + n).astype(np.uint64)))
            yield pa.RecordBatch.from_pydict({
                "anchor": gram[a].view(np.int64), "seg": seg.view(np.int64), "id": b.column("id").take(pa.array(d)),
                "sum": b.column("sum").take(pa.array(d)), "s": (s - first[d]).astype(np.int32), "n": n.astype(np.int32)})
    return rows.mapInArrow(run, "anchor long, seg long, id long, sum long, s int, n int")


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """``w1, w2, id, sum, s`` of the windows in the rows' ``parts`` (an array of ``s, n``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text", _BLOCK):
            words = Runs(b.column("text"))
            parts = b.column("parts")
            d = np.repeat(np.arange(b.num_rows), parts.value_lengths().to_numpy(zero_copy_only=False))
            flat = parts.flatten()
            s, n = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            local, d = np.repeat(s, n) + inside, np.repeat(d, n)
            at = words.first[d] + local
            yield pa.RecordBatch.from_pydict({
                "w1": words.runs(at, window).view(np.int64), "w2": words.runs(at, window, 1).view(np.int64),
                "id": b.column("id").take(pa.array(d)), "sum": b.column("sum").take(pa.array(d)), "s": local.astype(np.int32)})
    return rows.mapInArrow(run, "w1 long, w2 long, id long, sum long, s int")


def repeated_windows(df: DataFrame, window: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows (``id, sum, text``) and, for each that has any, ``hits``: an
    array of ``s, n`` with the first word and number of repeated windows."""
    if window <= SEED_WORDS:
        raise ValueError(f"a window needs more than {SEED_WORDS} words")
    rows = _rows(df, id_col, text_col)
    spark = df.sparkSession

    def kept(table: DataFrame, name: str) -> DataFrame:
        # a written table is shuffled by itself, so the planner can split a join's hot keys
        return spark.read.parquet(write_shared(table, name))

    seen = kept(_anchored(rows, window).groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1").select("anchor"), "seen")
    repeated = kept(_anchored(rows, window).join(seen, "anchor"), "anchors")
    segs = kept(repeated.groupBy("anchor", "seg").agg(F.count("*").alias("c"), F.min(F.struct("id", "sum", "s")).alias("one")), "segments")
    many = kept(segs.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1")
                .select("anchor", F.lit(True).alias("shared")), "shared")
    segs = segs.join(many, "anchor", "left").filter("c > 1 or shared") \
        .select("anchor", "seg", "c", "one", F.coalesce("shared", F.lit(False)).alias("shared"))
    known = repeated.join(segs, ["anchor", "seg"])
    whole = known.filter("c > 1").select("id", "sum", "s", "n")
    # the ends of matches; of segments that occur twice, one occurrence stands for all
    ends = known.filter("shared").filter((F.col("c") == 1) | (F.struct("id", "sum", "s") == F.col("one")))
    parts = ends.groupBy("id", "sum").agg(F.collect_set(F.struct("s", "n")).alias("parts"))
    wins = _windows(rows.join(parts, ["id", "sum"]), window).withColumn("salt", F.pmod("id", F.lit(_SALTS)).cast("int"))
    # a window that very many documents share meets its count in several tasks
    twice = wins.groupBy("w1", "w2").agg(F.count("*").alias("c")).filter("c > 1") \
        .select("w1", "w2", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    single = wins.join(twice, ["w1", "w2", "salt"]).select("id", "sum", "s", F.lit(1).alias("n"))
    hits = whole.union(single).groupBy("id", "sum").agg(F.collect_set(F.struct("s", "n")).alias("hits"))
    return rows, hits


def remove_repeats(df: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``text`` (the kept words joined by
    one space), ``n_words``, ``n_removed`` and ``spans``, the maximal repeats
    as first word and end word."""
    rows, hits = repeated_windows(df, window, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text", _BLOCK):
            out: dict[str, list] = {k: [] for k in ("text", "n_words", "n_removed", "spans", "sha256")}
            for text, found in zip(b.column("text").to_pylist(), b.column("hits").to_pylist()):
                words = text.split()
                total, spans, removed = len(words), [], 0
                if found:
                    step = np.zeros(total + 1, np.int64)
                    s = np.array([h["s"] for h in found])
                    n = np.array([h["n"] for h in found])
                    np.add.at(step, s, 1)
                    np.add.at(step, s + n - 1 + window, -1)
                    gone = np.cumsum(step[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                    spans = [{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])]
                    removed = int(gone.sum())
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept = b" ".join(words)
                out["text"].append(kept.decode("utf-8", "replace"))
                out["n_words"].append(total)
                out["n_removed"].append(removed)
                out["spans"].append(spans)
                out["sha256"].append(hashlib.sha256(kept).hexdigest())
            ids, sums = b.column("id"), b.column("sum")
            ids = pa.array([None if x < 0 else i for i, x in zip(ids.to_pylist(), sums.to_pylist())], pa.int64())
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": ids, "text": pa.array(out["text"], pa.string()), "n_words": pa.array(out["n_words"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()), "spans": pa.array(out["spans"], span),
                "kept_sha256": pa.array(out["sha256"], pa.string())})

    return rows.join(hits, ["id", "sum"], "left").mapInArrow(
        run, "doc_id long, text string, n_words long, n_removed long, "
        "spans array<struct<start:int,end:int>>, kept_sha256 string")
