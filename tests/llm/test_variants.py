import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from tablegauge.llm import kdtree, variants

LOWER = {i: i + 32 for i in range(65, 91)}


def count(rows):
    out = Counter()
    for key, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if n[v] >= 5 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w) or "", root(w), n[w], len(near[w]), n[form[w]] if w in form else 0) for w in n)


def make(seed, words):
    rng = random.Random(seed)
    letters = "aeiourstlnÀéÿ÷b"
    base = ["".join(rng.choice(letters) for _ in range(rng.choice([6, 7, 8, 8, 8, 9, 14]))) for _ in range(words)] + ["x" * 700, "abcabcabc", "cbacbacba"]
    out = []
    for b in base:
        out += [b] * rng.choice([5, 30, 200])
        for _ in range(3):
            i = rng.randrange(len(b))
            v = rng.choice([b[:i] + b[i + 1:], b[:i] + rng.choice(letters) + b[i:], b[:i] + rng.choice(letters) + b[i + 1:]])
            out += [v] * rng.choice([1, 5, 6, 40])
    rng.shuffle(out)
    return [(i, rng.choice([" ", ", ", "1", "_"]).join(w.upper() if rng.random() < .1 else w for w in out[j:j + 50]))
            for i, j in enumerate(range(0, len(out), 50))]


@pytest.mark.parametrize("cell,leaf,sample", [(1 << 14, 128, 100_000), (40, 5, 60), (7, 3, 1)])
def test_against_brute_force(spark, monkeypatch, cell, leaf, sample):
    """One cell a length; many cells; cells far over their bound, dealt into parts."""
    for name, value in (("CELL", cell), ("LEAF", leaf), ("SAMPLE", sample)):
        monkeypatch.setattr(variants, name, value)
    rows = make(4, 120) + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "Straße straße strasse " * 3), (None, None), (7, "wörtchen " * 6), (7, "wörtchen " * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("x"))
    got = sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in variants.variants(df).collect())
    want = brute(count(rows))
    assert got == want
    assert sum(1 for r in want if r[1]) > 30 and sum(1 for r in want if r[1] and r[2] != r[1]) > 0


def test_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "short words only")], "doc_id long, text string")
    for d in (df, df.limit(0)):
        out = variants.variants(d)
        assert out.collect() == [] and [t for _, t in out.dtypes] == ["string"] * 3 + ["bigint"] * 3


def test_runs_and_checksums():
    texts = ["Abc é×ÿ", "", "dÉf", "漢字abc", "x" * 100, "aĀb"]
    runs = variants.Runs(pa.array([t.encode() for t in texts], pa.binary()), 1)
    got = [(int(d), runs.words[w].decode("latin-1")) for d, w in zip(runs.doc, runs.word)]
    want = [(i, w.translate(LOWER)) for i, t in enumerate(texts) for w in re.findall("[A-Za-zÀ-ÿ]+", t)]
    assert got == want
    names = ["1", "", "-5", "99", "7", "x"]
    assert variants._checksums(names, runs).tolist() == [zlib.crc32(f"{names[d]}:{w}".encode()) for d, w in want]


def test_tree_searches_against_all_pairs():
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcdé") for _ in range(7)) for _ in range(900)})
    shorter = sorted({"".join(rng.choice("abcdé") for _ in range(6)) for _ in range(400)})
    tree = kdtree.Words(words, 6)
    for queries in (words, shorter):
        spelt = kdtree.spelling(queries)
        a, b = tree.near(spelt, kdtree.letter_counts(spelt))
        assert sorted(zip(a.tolist(), b.tolist())) == [(i, j) for i, q in enumerate(queries) for j, w in enumerate(words) if one_edit(q, w)]
    seen = sum(len(i) * len(tree.tree.members[x]) for x, i in tree.tree.search(tree.counts, 1, 1))
    assert seen < 0.6 * len(words) ** 2
    assert np.bincount([x for x, i in tree.tree.search(tree.counts, 0, 0) for _ in i]).max() <= 120
