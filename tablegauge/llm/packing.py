"""Packing: vector bin packing of token sequences with the dot-product heuristic.

Every example is a piece with three demands: tokens, one segment, and
loss-bearing tokens.  A sequence has a capacity in each.  A task keeps a
pool of pieces and fills one sequence at a time: of the pieces that fit in
every dimension it takes the one whose demand, as a share of capacity, has
the largest dot product with what is left.  When none fits whole, the piece
with the largest dot product is cut at the room that is left ("cut freely"),
so only a task's last sequence, or one that ran out of segments, is padded.

Tasks pack what they read, without a shuffle.  Sequence ids are unique:
the task's number in the high bits, its running count in the low 40.
The pool is bounded (a length of work, not a limit on rows: it is drained
and refilled until all rows are packed).

Edge cases: a null or empty text is a piece of one token, the end id; a
null id stays null and repeated ids are packed each on their own; an empty
table gives no row; other columns are not read.  A loss share outside 0..1
or null counts as 1.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import blocks, give_back, trimmed
from tablegauge.llm.tokens import encoder

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, segment int, loss_tokens long")


@dataclass(frozen=True)
class Limits:
    """Capacity of a sequence."""
    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048


class Packer:
    """Packs pieces ``(key, tokens, loss)``; ``place`` is called for each placed
    piece with ``(key, start, length, loss, sequence, offset, segment)``."""

    def __init__(self, limits: Limits, place, pool: int = 512):
        if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
            raise ValueError("every limit must be at least 1")
        self.cap = np.array([limits.tokens, 1 * limits.segments, limits.loss_tokens], dtype=np.float64)
        self.lim, self.place, self.pool = limits, place, pool
        self.keys: list = []
        self.start = np.zeros(0, np.int64)
        self.need = np.zeros((0, 3), np.float64)
        self.sequence = 0
        self._open()

    def _open(self) -> None:
        self.left, self.offset, self.segment = self.cap.copy(), 0, 0

    def _close(self) -> None:
        if self.segment:
            self.sequence += 1
            self._open()

    def add(self, pieces: list[tuple]) -> None:
        """Pieces ``(key, tokens, loss)``; the loss-bearing tokens are the last ones."""
        for i in range(0, len(pieces), self.pool):
            part = pieces[i:i + self.pool]
            self.keys += [p[0] for p in part]
            self.start = np.concatenate([self.start, np.zeros(len(part), np.int64)])
            self.need = np.concatenate([self.need, np.array([(p[1], 1, p[2]) for p in part], np.float64)])
            self._drain(self.pool // 2)

    def finish(self) -> None:
        self._drain(0)
        self._close()

    def _put(self, i: int, tokens: int, loss: int) -> None:
        self.place(self.keys[i], int(self.start[i]), tokens, loss, self.sequence, self.offset, self.segment)
        self.left -= (tokens, 1, loss)
        self.offset += tokens
        self.segment += 1
        if self.left[0] <= 0 or self.left[1] <= 0:
            self._close()

    def _drain(self, keep: int) -> None:
        alive = np.ones(len(self.keys), bool)
        n = len(self.keys)
        share = self.need / self.cap
        while n > keep:
            fits = alive & (self.need <= self.left).all(axis=1)
            score = share @ (self.left / self.cap)
            if fits.any():
                i = int(np.argmax(np.where(fits, score, -1.0)))
                self._put(i, int(self.need[i, 0]), int(self.need[i, 2]))
                alive[i] = False
                n -= 1
                continue
            i = int(np.argmax(np.where(alive, score, -1.0)))
            # what is left takes the piece's head: tokens without loss come first
            free = int(self.need[i, 0] - self.need[i, 2])
            head = min(int(self.left[0]), int(self.need[i, 0]), free + int(self.left[2]))
            if head < 1:
                self._close()
                continue
            loss = max(0, head - free)
            whole = head == int(self.need[i, 0])
            self._put(i, head, loss)
            self.start[i] += head
            self.need[i] -= (head, 0, loss)
            share[i] = self.need[i] / self.cap
            if whole:
                alive[i] = False
                n -= 1
            elif self.segment:          # ran out of loss-bearing room
                self._close()
        self.keys = [k for k, a in zip(self.keys, alive) if a]
        self.start, self.need = self.start[alive], self.need[alive]


def pack(df: DataFrame, tokenizer: str, end_id: int, limits: Limits = Limits(), id_col: str = "doc_id",
         text_col: str = "text", loss_share: Column | None = None) -> DataFrame:
    """Tokenize every text, append ``end_id`` and pack all ids.

    :param loss_share: the share of a text's tokens, counted from its end,
        that bear loss (default: all of them)
    :return: one row per piece; ``segment`` is its place in the sequence
    """
    share = F.lit(1.0) if loss_share is None else loss_share.cast("double")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                     F.when(share.between(0.0, 1.0), share).otherwise(1.0).alias("share"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc, base = encoder(tokenizer), TaskContext.get().partitionId() << 40
        end = np.array([end_id], dtype=np.uint32)
        out: list[tuple] = []

        def place(key, start, length, loss, sequence, offset, segment):
            doc, ids = key
            out.append((doc, start, length, zlib.crc32(ids[start:start + length].tobytes()), len(ids),
                        base + sequence, offset, segment, loss))

        packer = Packer(limits, place)
        for b in blocks(batches, "text"):
            texts = [t or "" for t in b.column("text").to_pylist()]
            pieces = []
            for key, share, ids in zip(b.column("id").to_pylist(), b.column("share").to_pylist(), enc.encode(texts)):
                ids = np.concatenate([ids, end])
                pieces.append(((key, ids), len(ids), int(round(share * len(ids)))))
            packer.add(pieces)
            if out:
                yield _batch(out)
                out.clear()
            give_back()
        packer.finish()
        if out:
            yield _batch(out)

    return rows.mapInArrow(trimmed(run, keeps="encoders"), SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int32() if c.endswith(" int") else pa.int64() for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, k, c in zip(names, kinds, zip(*rows))})


def padding(packed: DataFrame, tokens: int = 2048) -> DataFrame:
    """Sequences, tokens and padding of a packing: a sequence is padded to
    ``tokens`` unless its length is a power of two."""
    per = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    full = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    return per.agg(F.count("*").alias("sequences"), F.sum("n").alias("tokens"),
                   F.sum(F.when(full, 0).otherwise(tokens - F.col("n"))).alias("padding"))
