"""Exact nearest neighbours by largest inner product: a block matrix join.

Queries fall into row groups (bounded by bytes) and candidates into column
groups; every cell of that grid is one Spark partition, which holds its
queries and streams its candidates, so a cell's memory doesn't depend on
the number of candidates.  Inside a cell:

1. vectors are quantised to int8 codes with one scale each; the product of a
   tile of query codes and a tile of candidate codes (whole numbers, exact)
   gives every inner product up to a bound, as
   ``|q.c - q'.c'| <= |q - q'| |c| + |q'| |c - c'|`` for coded vectors q', c';
2. pairs whose upper bound is below the query's k-th best value (of the
   scores so far or, at first, of the tile's lower bounds) are dropped, which
   loses nothing;
3. survivors are recomputed on the original components in double precision,
   added up in component order, and folded into the query's best k.

A cell gives one sorted run for each query; heaps merge the runs.  Ties go
to the smaller id.

Edge cases: rows with a null id or a vector that is null, empty, zero or
holds a null or non-finite component take no part; vectors of different
lengths are not compared; a query leaves out all rows of its own id;
repeated candidate rows each take a place; query rows that agree in id and
vector are one query, those that agree in the id alone are answered one by
one under that id; fewer than k candidates are all returned; empty tables
give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.session import default_parallelism

#: Rows of a tile on either side.
TILE = 1024
#: Bytes of queries (originals, codes, best k) that a cell holds.
QUERY_BYTES = 64 << 20
#: Candidates of a cell; they are streamed, so this only sets the parallelism.
CELL_CANDIDATES = 1 << 17
#: Components whose code products add up exactly in single precision.
_SLAB = 1024
_LAST = np.iinfo(np.int64).max


def usable(vector: Column) -> Column:
    """True for a vector that can take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class _Coded:
    """Vectors (rows of a matrix) with their int8 codes and error norms."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.cols = ids, np.ascontiguousarray(rows.T, dtype=np.float64)
        full = rows.astype(np.float64)
        with np.errstate(all="ignore"):
            scale = np.abs(full).max(axis=1) / 127
            codes = np.rint(full / scale[:, None])
            codes[~np.isfinite(codes)] = 0       # a scale that underflows: everything is error
            self.codes = codes.astype(np.int8)
            near = self.codes * scale[:, None]
            self.scale = scale
            self.norm = np.sqrt((full * full).sum(axis=1))
            self.near = np.sqrt((near * near).sum(axis=1))
            self.error = np.sqrt(((full - near) ** 2).sum(axis=1))

    def __len__(self) -> int:
        return len(self.ids)

    def tile(self, a: int, b: int) -> tuple:
        return self.codes[a:b], self.scale[a:b], self.norm[a:b], self.near[a:b], self.error[a:b], self.ids[a:b]


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int8 codes; single precision holds the sums of a slab exactly."""
    out = 0.0
    for i in range(0, max(a.shape[1], 1), _SLAB):
        out = out + (a[:, i:i + _SLAB].astype(np.float32) @ b[:, i:i + _SLAB].astype(np.float32).T).astype(np.float64)
    return out


def bounds(q: tuple, c: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of two tiles."""
    with np.errstate(all="ignore"):
        mid = code_products(q[0], c[0]) * q[1][:, None] * c[1][None, :]
        slack = 4 * (q[0].shape[1] + 8) * np.finfo(np.float64).eps
        off = np.outer(q[4] + slack * q[2], c[2]) + np.outer(q[3], c[4])
        low, high = mid - off, mid + off
    low[np.isnan(low)] = -np.inf
    high[np.isnan(high)] = np.inf
    return low, high


class Best:
    """The best k candidates so far of every query of one vector length."""

    def __init__(self, queries: _Coded, k: int):
        self.queries, self.k, n = queries, k, len(queries)
        self.scores, self.ids = np.full((n, k), -np.inf), np.full((n, k), _LAST)

    def look(self, found: _Coded) -> None:
        for j in range(0, len(found), TILE):
            right = found.tile(j, j + TILE)
            for i in range(0, len(self.queries), TILE):
                self._tile(i, self.queries.tile(i, i + TILE), j, right, found)

    def _tile(self, i: int, left: tuple, j: int, right: tuple, found: _Coded) -> None:
        k, low_high = self.k, bounds(left, right)
        low, high = low_high
        own = left[5][:, None] == right[5][None, :]
        low[own] = high[own] = -np.inf
        floor = self.scores[i:i + len(low), k - 1].copy()
        new = np.flatnonzero(floor == -np.inf)
        if len(new) and low.shape[1] >= k:
            floor[new] = np.partition(low[new], low.shape[1] - k, axis=1)[:, low.shape[1] - k]
        qi, ci = np.nonzero((high >= floor[:, None]) & ~own)
        for a in range(0, len(qi), TILE * TILE // 8):
            part = slice(a, a + TILE * TILE // 8)
            at, of = qi[part] + i, ci[part] + j
            with np.errstate(all="ignore"):
                score = np.zeros(len(at))
                for x, y in zip(self.queries.cols, found.cols):
                    score += x[at] * y[of]
            score[np.isnan(score)] = -np.inf
            better = score >= self.scores[at, k - 1]
            self._fold(at[better], score[better], found.ids[of[better]])

    def _fold(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(at):
            return
        k, some = self.k, np.unique(at)
        row = np.concatenate([np.repeat(some, k), at])
        score = np.concatenate([self.scores[some].ravel(), score])
        ids = np.concatenate([self.ids[some].ravel(), ids])
        order = np.lexsort((ids, -score, row))
        row = row[order]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        keep = order[np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row)))) < k]
        self.scores[some], self.ids[some] = score[keep].reshape(-1, k), ids[keep].reshape(-1, k)


def _matrices(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of each vector length in a batch."""
    vectors = b.column("vector")
    size = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield at, flat[start[at][:, None] + np.arange(d)]


def _runs(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        best: dict[int, Best] = {}
        for b in batches:
            side, ids = b.column("side").to_numpy(), b.column("id").to_numpy()
            cut = int(np.searchsorted(side, 1))
            if cut:
                tag = b.column("tag").to_numpy()
                for at, m in _matrices(b.slice(0, cut)):
                    held.setdefault(m.shape[1], []).append((ids[at], tag[at], m))
            if cut == b.num_rows:
                continue
            for d, parts in held.items():
                i, t, m = (np.concatenate(x) for x in zip(*parts))
                once = np.unique(np.stack([i, t]), axis=1, return_index=True)[1]
                best[d] = Best(_Coded(i[once], m[once]), k)
                best[d].tags = t[once]
            held = {}
            for at, m in _matrices(b.slice(cut)):
                if m.shape[1] in best:
                    best[m.shape[1]].look(_Coded(ids[cut:][at], m))
        for x in best.values():
            for i in range(0, len(x.queries), 4096):
                s, v = x.scores[i:i + 4096], x.ids[i:i + 4096]
                there = v != _LAST
                off = pa.array(np.concatenate([[0], np.cumsum(there.sum(axis=1))]).astype(np.int32))
                yield pa.RecordBatch.from_pydict({
                    "query_id": x.queries.ids[i:i + 4096], "tag": x.tags[i:i + 4096],
                    "scores": pa.ListArray.from_arrays(off, pa.array(s[there])), "ids": pa.ListArray.from_arrays(off, pa.array(v[there]))})
    return run


def _merged(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, runs, out = None, [], []

        def close():
            found = heapq.merge(*runs)
            out.extend((key[0], rank, v, -s) for rank, (s, v) in zip(range(1, k + 1), found))

        def batch():
            q, r, v, s = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(r, pa.int32()), pa.array(v, pa.int64()),
                                               pa.array(s, pa.float64())], ["query_id", "rank", "vec_id", "score"])
        for b in batches:
            for q, t, ids, scores in zip(*(b.column(c).to_pylist() for c in ("query_id", "tag", "ids", "scores"))):
                if (q, t) != key:
                    if runs:
                        close()
                    key, runs = (q, t), []
                runs.append([(-s, v) for s, v in zip(scores, ids)])
                if len(runs) > 512:            # a bounded number of runs in memory
                    runs = [[x for _, x in zip(range(k), heapq.merge(*runs))]]
            if len(out) >= 50_000:
                yield batch()
                out.clear()
        if runs:
            close()
        if out:
            yield batch()
    return run


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` candidates of the largest
    inner product with each query, nearest first."""
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = candidates.sparkSession
    kind = "array<float>" if all(dict(x.dtypes)[vector_col] == "array<float>" for x in (queries, candidates)) else "array<double>"

    def rows(df: DataFrame, side: int) -> DataFrame:
        out = df.select(F.lit(side).alias("side"), F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("vector"))
        out = out.filter(F.col("id").isNotNull() & usable(F.col("vector")))
        return out.withColumn("tag", F.xxhash64("vector") if side == 0 else F.lit(0).cast("long"))
    left, right = rows(queries, 0), rows(candidates, 1)
    size = left.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).first()
    n_found = right.count()
    per_group = max(256, QUERY_BYTES // (12 * (size.d or 1) + 16 * k))
    groups = -(-max(size.n, 1) // per_group)
    columns = max(-(-default_parallelism(spark) // groups), -(-n_found // CELL_CANDIDATES))
    start = F.pmod(F.xxhash64("id", F.lit(0)), F.lit(groups)) * columns
    column = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(columns))
    # the grid: a query goes to all columns of its group, a candidate to all groups of its column
    grid = left.withColumn("cell", F.explode(F.sequence(start, start + (columns - 1)))) \
        .union(right.withColumn("cell", F.explode(F.sequence(column, column + (groups - 1) * columns, F.lit(columns).cast("long")))))
    cells = grid.repartitionById(groups * columns, F.col("cell").cast("int")).sortWithinPartitions("side")
    runs = cells.select("side", "id", "tag", "vector").mapInArrow(_runs(k), "query_id long, tag long, scores array<double>, ids array<long>")
    return runs.repartition(F.col("query_id")).sortWithinPartitions("query_id", "tag") \
        .mapInArrow(_merged(k), "query_id long, rank int, vec_id long, score double")
