import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablegauge.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k, every=20):
    def ok(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    rows = [(i, v) for i, v in rows if i is not None and ok(v)]
    out = []
    for q, a in sorted({(i, tuple(v)) for i, v in rows if i % every == 0}):
        found = []
        for c, b in rows:
            if c != q and len(a) == len(b):
                s = 0.0
                for x, y in zip(a, b):
                    s += x * y
                found.append((-s, c))
        out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def run(spark, rows, k=20, every=20):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumn("query_id", F.lit(1)).withColumn("side", F.lit("x"))
    return sorted(tuple(r) for r in neighbours.nearest(df.filter(F.col("vec_id") % every == 0), df, k).collect())


@pytest.mark.parametrize("tile,bytes_held", [(neighbours.TILE, neighbours.QUERY_BYTES), (32, 1)])
def test_against_brute_force(spark, monkeypatch, tile, bytes_held):
    monkeypatch.setattr(neighbours, "TILE", tile)
    monkeypatch.setattr(neighbours, "QUERY_BYTES", bytes_held)
    rng = random.Random(5)
    common = [rng.uniform(-1, 1) for _ in range(16)]
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.randint(-3, 3) for _ in range(16)]) for i in range(400)]
    rows += [(i, list(common)) for i in range(400, 700)]                         # a third are one vector: ties
    rows += [(i, [float(rng.randint(-1, 1)) for _ in range(16)]) for i in range(700, 800)]
    rows += [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(800, 850)]  # other lengths
    rows += [(860, None), (880, []), (900, [0.0] * 16), (920, [1.0, None] * 8), (940, [math.nan] + [1.0] * 15),
             (960, [math.inf] + [1.0] * 15), (861, [0.0] * 16), (None, list(common)), (20, list(rows[20][1])),
             (40, [2.0] * 16), (1, list(rows[1][1])), (980, [5e-324] * 16), (1000, [1e150] * 16)]
    assert run(spark, rows) == brute(rows, 20)


def test_few_candidates_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [0.0, -1.0]), (20, [3.0, 3.0])]
    assert run(spark, rows) == brute(rows, 20)
    assert [r[2] for r in run(spark, rows, 2) if r[0] == 0] == [20, 1]
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []
    assert run(spark, [(0, [1.0])]) == []
    with pytest.raises(ValueError):
        run(spark, rows, 0)


def test_bounds_hold_in_wide_and_odd_tiles():
    rng = np.random.default_rng(3)
    for d in (1, 7, 1500):
        a = rng.normal(size=(20, d)) * 10.0 ** rng.integers(-5, 5, (20, 1))
        b = rng.standard_cauchy(size=(30, d))
        x, y = (neighbours._Coded(np.arange(len(m)), m) for m in (a, b))
        assert (neighbours.code_products(x.codes, y.codes) == x.codes.astype(np.int64) @ y.codes.astype(np.int64).T).all()
        low, high = neighbours.bounds(x.tile(0, 20), y.tile(0, 30))
        true = a @ b.T
        assert (low <= true).all() and (true <= high).all()


def test_bounds_drop_most_pairs():
    rng = np.random.default_rng(4)
    m = rng.normal(size=(3000, 64))
    best = neighbours.Best(neighbours._Coded(np.arange(50), m[:50]), 20)
    seen = []
    fold = best._fold
    best._fold = lambda at, s, i: (seen.append(len(at)), fold(at, s, i))
    best.look(neighbours._Coded(np.arange(3000), m))
    assert sum(seen) < 0.05 * 50 * 3000
