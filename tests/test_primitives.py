"""The two distributed primitives against brute force."""
import hashlib

import pandas as pd
from pyspark.sql import functions as F

from tablegauge.functions import hashrank, prefix
from tablegauge.functions.columns import row_hash


def _md5(*parts):
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


def test_select_smallest_matches_sort(spark):
    df = spark.range(0, 5000).withColumn("g", (F.col("id") % 3).cast("string"))
    k = {"0": 17, "1": 0, "2": 5000}
    out = hashrank.select_smallest(df, row_hash(9, "t", ["id"]), k, F.col("g"), flag="sel")
    got = {r["id"] for r in out.where("sel").collect()}
    pdf = pd.DataFrame({"id": range(5000)})
    pdf["g"] = (pdf.id % 3).astype(str)
    pdf["h"] = [_md5(9, "t", i) for i in pdf.id]
    want = set()
    for g, n in k.items():
        want |= set(pdf[pdf.g == g].sort_values("h").head(n).id)
    assert got == want


def test_refinement_levels_are_exact(spark, monkeypatch):
    # force several refinement levels with a tiny final-bucket size
    monkeypatch.setattr(hashrank, "_FINAL_ROWS", 2)
    df = spark.range(0, 3000)
    out = hashrank.select_smallest(df, row_hash(1, "x", ["id"]), 1234, None, flag="sel")
    got = {r["id"] for r in out.where("sel").collect()}
    want = set(sorted(range(3000), key=lambda i: _md5(1, "x", i))[:1234])
    assert got == want


def _shares(spark, total, counts):
    sizes = spark.createDataFrame(list(counts.items()), "s string, n long")
    return {r.s: r.k for r in hashrank.largest_remainder(sizes, total).collect()}


def test_largest_remainder(spark, monkeypatch):
    assert _shares(spark, 294, {"Yes": 237, "No": 1233}) == {"Yes": 47, "No": 247}
    assert _shares(spark, 10, {"c": 1, "b": 1, "a": 1}) == {"a": 4, "b": 3, "c": 3}
    monkeypatch.setattr(hashrank, "_RANK_ROWS", 7)              # remainders ranked over several partitions
    counts = {f"k{i:03d}": (i * 7919) % 101 + 1 for i in range(200)}
    n, total = sum(counts.values()), 3333
    want = {s: total * c // n for s, c in counts.items()}
    for s in sorted(counts, key=lambda s: (-(total * counts[s] % n), s))[:total - sum(want.values())]:
        want[s] += 1
    assert _shares(spark, total, counts) == want
    big = 10 ** 17
    assert _shares(spark, big, {"a": 3 * big, "b": big}) == {"a": 75 * 10 ** 15, "b": 25 * 10 ** 15}


def test_strata_of_any_name_and_null(spark):
    df = spark.range(0, 900).withColumn("g", F.when(F.col("id") % 3 > 0, F.concat(F.lit("x'"), F.col("id") % 3)))
    out = hashrank.select_smallest(df, row_hash(5, "n", ["id"]), 10, F.col("g"), flag="sel")
    for rest in (0, 1, 2):
        got = {r.id for r in out.where(F.col("sel") & (F.col("id") % 3 == rest)).collect()}
        assert got == set(sorted(range(rest, 900, 3), key=lambda i: _md5(5, "n", i))[:10])


def test_ks_distance_brute_force(spark):
    import random
    rnd = random.Random(3)
    rows = [("f", float(rnd.randint(0, 30)), rnd.randint(0, 3), rnd.randint(0, 3)) for _ in range(400)]
    rows += [("g", rnd.random(), 1, 0) for _ in range(50)] + [("g", rnd.random() + 0.3, 0, 1) for _ in range(60)]
    df = spark.createDataFrame(rows, "feature string, v double, a long, b long") \
        .groupBy("feature", "v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    got = {r["feature"]: r["statistic"] for r in prefix.ks_distance(df, "feature", "v", "a", "b", 5).collect()}
    pdf = df.toPandas().sort_values(["feature", "v"])
    for f, part in pdf.groupby("feature"):
        ca, cb = part.a.cumsum() / part.a.sum(), part.b.cumsum() / part.b.sum()
        assert abs(got[f] - (ca - cb).abs().max()) < 1e-12


def test_auc_fixture(spark, x4):
    from tablegauge.operators.evaluate import roc_auc
    r = roc_auc(x4, num_partitions=3).first()
    assert abs(r["roc_auc"] - 22 / 25) < 1e-12


def test_global_rank_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    out = prefix.global_rank(df, [F.desc("k")], "rk", 4).toPandas()
    assert sorted(out.rk) == list(range(1, 1001))
    assert list(out.sort_values("rk").k) == sorted(out.k, reverse=True)


def test_chi2_tail_against_its_definition(spark):
    """Odd and even degrees of freedom against numeric integration of the density, and limits."""
    import math

    import duckdb
    import numpy as np

    from tablegauge.functions.stats import chi2_sf, chi2_sf_sql
    cases = [(x, k) for k in (1, 2, 3, 4, 5, 8, 49, 50, 301, 2000) for x in (1e-9, 0.3, 1.7, 4.0, 5.9, 6.1, 30.0, 0.8 * k, 1.0 * k, 1.3 * k)]
    known = {(3.841458820694124, 1): 0.05, (5.991464547107979, 2): 0.05, (7.814727903251179, 3): 0.05, (0.0, 3): 1.0, (4.0, 0): 1.0}
    rows = cases + list(known)
    got = [r[0] for r in spark.createDataFrame(rows, "x double, k long").select(chi2_sf(F.col("x"), F.col("k"))).collect()]

    def numeric(x, k):                          # the density in r = sqrt(x), smooth at zero for every k
        r = np.linspace(math.sqrt(x), math.sqrt(x) + math.sqrt(k) + 12, 200_001)
        with np.errstate(divide="ignore"):
            f = np.exp((k - 1) * np.log(r) - r * r / 2 - (k / 2 - 1) * math.log(2) - math.lgamma(k / 2))
        return float((f[:-1] + f[1:]).sum() * (r[1] - r[0]) / 2)
    for (x, k), p in zip(rows, got):
        assert abs(p - (known[x, k] if (x, k) in known else numeric(x, k))) < 1e-7, (x, k, p)
    sql = [duckdb.sql(f"SELECT {chi2_sf_sql(f'CAST({x!r} AS DOUBLE)', str(k))}").fetchall()[0][0] for x, k in rows]
    assert np.allclose(sql, got, rtol=0, atol=1e-9)
    far = spark.sql("SELECT 1e6D AS x, 3L AS k UNION ALL SELECT NULL, 3L UNION ALL SELECT 1D, NULL").select(chi2_sf(F.col("x"), F.col("k"))).collect()
    assert [r[0] for r in far] == [0.0, None, None]


def test_small_sample_ks_against_all_arrangements():
    import itertools
    import math

    from tablegauge.functions.stats import ks_exact
    for n, m in ((1, 1), (2, 3), (4, 4), (3, 7), (6, 6), (5, 7)):
        found = {}
        for ref in itertools.combinations(range(n + m), n):
            a = b = top = 0
            for i in range(n + m):
                a, b = (a + 1, b) if i in ref else (a, b + 1)
                top = max(top, abs(a * m - b * n))
            found[top] = found.get(top, 0) + 1
        for top in found:
            want = sum(c for t, c in found.items() if t >= top) / math.comb(n + m, n)
            assert abs(ks_exact(top / (n * m), n, m) - want) < 1e-12
    assert ks_exact(0.0, 9, 9) == 1.0
    # equal sizes have a closed form: alternating sum of binomials
    for n, k in ((12, 7), (300, 30), (300, 45)):
        want = 2 * sum((-1) ** (j - 1) * math.comb(2 * n, n - j * k) / math.comb(2 * n, n) for j in range(1, n // k + 1))
        assert abs(ks_exact(k / n, n, n) - want) < 1e-9


def test_ks_scores_switch_from_paths_to_the_series(spark):
    from tablegauge.functions.stats import KS_EXACT_ROWS, ks_exact
    from tablegauge.operators.drift import ks_scores
    for n in (20, KS_EXACT_ROWS, KS_EXACT_ROWS + 1):
        df = spark.range(0, n).select((F.col("id") * 1.0).alias("x"))
        r = ks_scores(df, df.select((F.col("x") + n // 10 + 0.5).alias("x")), ["x"]).first()
        if n <= KS_EXACT_ROWS:
            assert r.p_value == ks_exact(r.statistic, n, n)
        else:
            assert abs(r.p_value - ks_exact(r.statistic, n, n)) < 0.01


def test_exact_median_bracketing(spark):
    import random
    from tablegauge.functions import quantile
    rnd = random.Random(11)
    vals = [rnd.random() * 1000 for _ in range(3001)] + [500.0] * 1500 + [None] * 7
    ints = [rnd.randint(0, 50) for _ in range(len(vals))]
    df = spark.createDataFrame(list(zip(vals, ints)), "x double, y long")
    got = quantile.exact_medians(df, ["x", "y"], accuracy=100, final_rows=16)
    xs = sorted(v for v in vals if v is not None)
    ys = sorted(ints)
    def med(s):
        n = len(s)
        return s[(n - 1) // 2] + (s[n // 2] - s[(n - 1) // 2]) * 0.5
    assert got["x"] == med(xs) and got["y"] == med(ys)
    assert quantile.exact_medians(df.where("x is null"), ["x"]) == {"x": None}
