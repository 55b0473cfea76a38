import math
import random
from collections import Counter

import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from tablegauge.llm import catalog, rules


def brute(text):
    text = text or ""
    words = text.encode().split()
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))


def test_counts_against_brute_force(spark):
    rng = random.Random(2)
    texts = ODD + [" ".join(rng.choice("ab") for _ in range(n)) for n in (7, 8, 9, 15, 16, 17, 40, 300)]
    texts += [" ".join([*map(str, range(20)), "x", *map(str, range(5, 14)), "y"]), "a\n a\na\n\n\na ", "#*$%&|<> é&"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").withColumn("words", F.lit(1))
    for r in rules.counts(df, ["i"]).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.i]), texts[r.i][:80]


def exact_tail(x, n, p):
    return math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p))
                     for j in range(x + 1))


def test_binomial_tail(spark):
    p = 0.004
    cases = [(x, n) for n in (0, 1, 10, 400, 1500, 20_000, 10**6) for x in (0, 1, 2, 5, 60, 3900) if x <= n]
    df = spark.createDataFrame(cases, "x long, n long")
    for r in df.withColumn("t", rules.binomial_tail(F.col("x"), F.col("n"), p)).collect():
        want = 1.0 if r.n == 0 or r.x >= r.n * p else exact_tail(r.x, r.n, p)
        assert math.isclose(r.t, want, rel_tol=1e-7, abs_tol=1e-300)


def brute_cutoffs(rows, grid, risk, delta):
    out, strata = {}, {s for s, _ in rows}
    for s in strata:
        for rule, cs in grid.items():
            good = [m[rule] for t, m in rows if t == s]
            for c in cs:
                x, n = sum(v > c for v in good), len(good)
                p = risk / len(grid)
                if x >= n * p or exact_tail(x, n, p) > delta / len(grid) / len(strata):
                    break
                out[s, rule] = c
    return out


@pytest.mark.parametrize("limit", [100_000, -1])
def test_verdicts_against_brute_force(spark, limit):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(3000):
        lang = rng.choice(["en", "en", "en", None, "xx"]) if i % 500 else "rare"
        good = rng.random() < .8
        words = [f"w{rng.randrange(5000)}" for _ in range(40)]
        if not good or rng.random() < .01:
            words = [w + "$$" for w in words]
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(good) if i % 7 else None))
    rows += [(5000 + i, t, "en") for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("stratum", F.lit(1)).withColumn("n", F.lit(1))
    lab = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("clash"))
    grid, risk = {"symbols_per_word": [3.0, 1.0, 0.1], "upper_share": [0.5]}, 0.06
    got = {r.doc_id: r for r in rules.judge(df, lab, grid=grid, risk=risk, broadcast_rows=limit).collect()}
    good = {i for i, g in labels if g == 1}
    metric = lambda r: {"symbols_per_word": r.n_symbols / r.n_words if r.n_words else 0, "upper_share": r.n_upper / r.word_chars if r.word_chars else 0}
    cut = brute_cutoffs([(r.stratum, metric(r)) for i, r in got.items() if i in good], grid, risk, rules.DELTA)
    assert ("en", "symbols_per_word") in cut and not any(s == "rare" for s, _ in cut)
    for i, t, lang in rows:
        n = brute(t)
        base = n[0] < 20 or 100 * n[4] > 30 * n[0]
        fails = {r for r in grid if metric(got[i])[r] > cut.get((lang or "", r), 9e9)}
        assert got[i].base_failed == base and set(got[i].failed_rules) == fails and got[i].kept == (not base and not fails)


def test_query_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.1"
    out = catalog.op7_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    by = {r.quality: (r.n, r.k) for r in out.groupBy("quality").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("k")).collect()}
    n, k = by[1]
    long = out.filter("quality = 1 and not base_failed").count()
    assert k >= (1 - rules.RISK) * long and by[0][1] < .6 * by[0][0]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    lab = spark.createDataFrame([], "doc_id long, quality int")
    assert rules.judge(df, lab).collect() == []
    one = spark.createDataFrame([(1, "some words " * 20, None)], "doc_id long, text string, lang string")
    assert [r.failed_rules for r in rules.judge(one, lab).collect()] == [[]]
