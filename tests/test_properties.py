"""Property tests: the distributed primitives equal brute force on random inputs."""
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablegauge.functions import hashrank, prefix
from tablegauge.functions.columns import row_hash
from tablegauge.operators.evaluate import roc_auc


def _md5(*parts):
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


@settings(max_examples=6, deadline=None)
@given(n=st.integers(1, 400), k=st.integers(0, 450), seed=st.integers(0, 10**6))
def test_k_smallest_hashes(spark, n, k, seed):
    df = spark.range(0, n)
    got = {r["id"] for r in hashrank.select_smallest(df, row_hash(seed, "p", ["id"]), k, None, "sel")
           .where("sel").collect()}
    assert got == set(sorted(range(n), key=lambda i: _md5(seed, "p", i))[:k])


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(st.tuples(st.integers(0, 6), st.booleans()), min_size=2, max_size=60))
def test_auc_matches_pairwise_definition(spark, rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    df = spark.createDataFrame([(float(s) / 6, "Yes" if y else "No") for s, y in rows],
                               "p_pos double, y_true string")
    got = roc_auc(df, num_partitions=3).first()["roc_auc"]
    if not pos or not neg:
        assert got is None
    else:
        want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
        assert abs(got - want) < 1e-12


@settings(max_examples=6, deadline=None)
@given(a=st.lists(st.integers(0, 9), min_size=1, max_size=40),
       b=st.lists(st.integers(0, 9), min_size=1, max_size=40))
def test_ks_distance_matches_cdf_difference(spark, a, b):
    rows = [("f", float(v), 1, 0) for v in a] + [("f", float(v), 0, 1) for v in b]
    counts = spark.createDataFrame(rows, "g string, v double, r long, c long") \
        .groupBy("g", "v").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    got = prefix.ks_distance(counts, "g", "v", "r", "c", 3).first()["statistic"]
    want = max(abs(sum(x <= t for x in a) / len(a) - sum(x <= t for x in b) / len(b)) for t in range(10))
    assert abs(got - want) < 1e-12
