"""Phrase collocations: frequent phrases found level by level with broadcast tries.

Level 1 counts words.  Level k broadcasts double-array tries of the frequent
phrases of k - 1 words, the only ones that a candidate may start or end with
(Apriori).  Numpy advances the states of all text positions of a block at
once, symbol by symbol; a window of k words is a candidate if its first
k - 1 words and, where one trie holds them all, its last k - 1 words reach an
accepting state.  Candidates are counted in each block by their pair of accepting
states (or state and next word) and the blocks' counts are summed by Spark,
so what is shuffled are candidates' counts and nothing else.

A trie holds at most ``MAX_PHRASES`` phrases of ``MAX_BYTES``; a level with
more gets several tries, dealt by hash, broadcast and released one after
another, each with its own pass over the texts.  Words that only such a
pass could rule out by their last k - 1 words fall at the sum instead.

Scores, containment and ranks are DataFrame operations on the frequent phrases.

Edge cases: null texts have no words; a null lang is ``und``; texts of one
piece, of breaks alone or with words of any length are as any other;
repeated rows count each time; equal scores rank by occurrences, then by
phrase in byte order; an empty table, or one without candidates, gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegauge.llm.common import blocks, write_shared
from tablegauge.llm.tries import Trie

MAX_PHRASES = 1 << 20
MAX_BYTES = 32 << 20
_BLOCK = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0 in a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2


class Positions:
    """The words of a block of texts: ``words`` (distinct), ``word`` (number
    of each position's word), ``piece`` and ``doc`` of each position."""

    def __init__(self, texts: pa.Array):
        """:param texts: a binary array without nulls"""
        n = len(texts)
        off = np.frombuffer(texts.buffers()[1], np.int32, n + 1, 4 * texts.offset).astype(np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        off -= off[0]
        data = _LOWER[data]
        kind = _KIND[data]
        inside = kind == 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = off[:-1][off[:-1] < off[1:]]
        begins[heads] = inside[heads]            # a text's first byte never continues a word
        at = np.flatnonzero(begins)
        self.doc = np.repeat(np.arange(n), np.diff(np.searchsorted(at, off)))
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[at] + self.doc
        before = np.cumsum(inside, dtype=np.int32)[at] - 1
        ends = np.append(before, np.count_nonzero(inside)).astype(np.int32)
        spelt = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
        coded = spelt.dictionary_encode()
        self.words, self.word = coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and how often each occurs."""
    if len(key) and int(key.max()) < 2 * len(key):
        n = np.bincount(key)
        key = np.flatnonzero(n)
        return key, n[key]
    return np.unique(key, return_counts=True)


def _word_counts(rows: DataFrame) -> DataFrame:
    """``lang, phrase, f`` of all single words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text", _BLOCK):
            p = Positions(b.column("text"))
            lang = b.column("lang").dictionary_encode()
            width = max(len(p.words), 1)
            key, n = _counted(lang.indices.to_numpy().astype(np.int64)[p.doc] * width + p.word)
            yield pa.RecordBatch.from_pydict({"lang": lang.dictionary.take(pa.array(key // width)),
                                              "phrase": p.words.take(pa.array(key % width)).cast(pa.string()), "n": n})
    return rows.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def _extended(rows: DataFrame, trie: Trie, whole: bool, least: int) -> tuple[DataFrame, Broadcast]:
    """``lang, phrase, f``: the trie's phrases extended by one word, ``least``
    times or more; and the broadcast, to be released when the table is written."""
    sent = rows.sparkSession.sparkContext.broadcast(trie)
    langs = trie.langs

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Trie = sent.value
        known = t.vocabulary.cast(pa.binary())
        for b in blocks(batches, "text", _BLOCK):
            p = Positions(b.column("text"))
            number = pc.fill_null(pc.index_in(p.words, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            lang = pc.fill_null(pc.index_in(b.column("lang"), langs), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            state = t.advance(lang[p.doc], number[p.word], p.piece)
            k = t.size
            if len(state) <= k:
                continue
            fits = (state[:-k] >= 0) & (p.piece[:-k] == p.piece[k:])
            follow = state[1:len(state) - k + 1] if whole else p.word[k:]
            fits &= follow >= 0
            width = len(t.phrases) if whole else len(p.words)
            key, n = _counted(state[:-k][fits] * width + follow[fits])
            if whole:
                yield pa.RecordBatch.from_pydict({"key": key, "n": n})
            else:
                yield pa.RecordBatch.from_pydict({"key": key // width, "word": p.words.take(pa.array(key % width)).cast(pa.string()), "n": n})

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Trie = sent.value
        for b in batches:
            at = b.column("key")
            if whole:                            # the next word is the last of the accepted suffix
                key = at.to_numpy()
                at, word = pa.array(key // len(t.phrases)), t.last.take(pa.array(key % len(t.phrases)))
            else:
                word = b.column("word")
            yield pa.RecordBatch.from_pydict({
                "lang": t.lang_of.take(at), "phrase": pc.binary_join_element_wise(t.phrases.take(at), word, " "), "f": b.column("f")})

    names = ["key"] if whole else ["key", "word"]
    counts = rows.mapInArrow(count, "key long, n long" if whole else "key long, word string, n long").groupBy(*names).agg(F.sum("n").alias("f"))
    return counts.filter(F.col("f") >= least).mapInArrow(spell, "lang string, phrase string, f long"), sent


def frequent_phrases(df: DataFrame, least: int = 30, longest: int = 4, text_col: str = "text",
                     lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, f)`` of all phrases of up to ``longest`` words
    that occur ``least`` times or more, and ``(lang, n)``, all words of each lang."""
    spark = df.sparkSession
    rows = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                     F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    words = spark.read.parquet(write_shared(_word_counts(rows), "words"))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    level = words.filter(F.col("f") >= least)
    out = level.withColumn("size", F.lit(1))
    for size in range(2, longest + 1):
        held = level.agg(F.count("*").alias("n"), F.sum(F.octet_length("phrase") + F.octet_length("lang")).alias("bytes")).first()
        if not held.n:
            break
        shards = max(-(-held.n // MAX_PHRASES), -(-held.bytes // MAX_BYTES))
        parts = []
        for i in range(shards):
            shard = level.filter(F.pmod(F.xxhash64("lang", "phrase"), F.lit(shards)) == i).select("lang", "phrase").toArrow().combine_chunks()
            if not shard.num_rows:
                continue
            found, sent = _extended(rows, Trie(shard["lang"].combine_chunks(), shard["phrase"].combine_chunks(), size - 1), shards == 1, least)
            parts.append(write_shared(found, f"phrases{size}"))
            sent.destroy()
        level = spark.read.parquet(*parts)
        out = out.union(level.withColumn("size", F.lit(size)))
    return out.select("lang", "phrase", "size", "f"), totals


def collocations(df: DataFrame, least: int = 30, longest: int = 4, keep: int | None = None, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the candidates that no
    longer phrase stands for; the first ``keep`` of each lang, all if None."""
    phrases, totals = frequent_phrases(df, least, longest, text_col, lang_col)
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    words = F.split("phrase", " ")
    found = phrases.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("words"))
    part = phrases.select(F.col("lang").alias("p_lang"), F.col("phrase").alias("p_phrase"), F.col("f").alias("p_f"))

    def look_up(cuts: DataFrame, column: str, name: str) -> DataFrame:
        joined = cuts.join(part, (F.col("lang") == F.col("p_lang")) & (F.col(column) == F.col("p_phrase")))
        return joined.withColumnRenamed("p_f", name).drop("p_lang", "p_phrase", column)
    cuts = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1))) \
        .withColumn("head", F.concat_ws(" ", F.slice("words", F.lit(1), F.col("cut")))) \
        .withColumn("rest", F.concat_ws(" ", F.slice("words", F.col("cut") + 1, F.col("size") - F.col("cut")))).drop("words")
    cuts = look_up(look_up(cuts, "head", "l"), "rest", "r") \
        .withColumn("a_", wide("a") * F.lit(2_000_000)).withColumn("lr", wide("l") + wide("r")).withColumn("score", F.expr("a_ div lr"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))
    # the most frequent longer phrase around each phrase
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.concat_ws(" ", F.slice("words", i, m)))))
    around = found.filter("size > 2").select("lang", F.col("a").alias("f"), F.explode(spans).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left") \
        .filter(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * 80)) \
        .select("lang", "phrase", "a", F.col("least.l").alias("l"), F.col("least.r").alias("r"), F.col("least.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    if keep is not None:
        ranked = ranked.filter(F.col("rank") <= keep)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
