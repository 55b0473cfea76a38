import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from tablegauge.llm import substrings
from tablegauge.llm.runhash import Runs
from tablegauge.llm.wordhash import Words, least_places


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = Counter()
    for (key, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[key, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def run(spark, rows, window):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("hits", F.lit(1))
    out = substrings.remove_repeats(df, window).select("doc_id", "n_words", "n_removed", "kept_sha256")
    return Counter(tuple(r) for r in out.collect())


def test_word_hashes_and_least_places():
    texts = [b"", b"a bc  a", b"bc", b" \n", b"a", "ü bc".encode()]
    w = Words(pa.array(texts, pa.binary()))
    assert np.diff(w.first).tolist() == [0, 3, 1, 0, 1, 2]
    a, bc, a2, bc2, a3, ue, bc3 = w.hash.tolist()
    assert a == a2 == a3 and bc == bc2 == bc3 and len({a, bc, ue}) == 3
    runs = w.runs(np.array([0, 2, 4]), np.array([2, 2, 1])).tolist()
    assert runs[0] == runs[1] != runs[2]
    x = np.random.default_rng(1).integers(0, 5, 300).astype(np.uint64)
    for n in (1, 2, 5, 24):
        assert least_places(x, n).tolist() == [i + int(np.argmin(x[i:i + n])) for i in range(300 - n + 1)]


@pytest.mark.parametrize("window", [13, 35])
def test_against_brute_force(spark, window):
    rng = random.Random(window)
    vocab = [f"w{i}" for i in range(400)]
    fresh = lambda n: [rng.choice(vocab) for _ in range(n)]
    passages = [fresh(n) for n in (12, 13, 34, 35, 36, 60, 200)]
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, ODD[-1]), (None, None), (3, "x " * 40), (3, "x " * 40)]
    for i in range(60):
        w = fresh(rng.choice([0, 5, 50, 150]))
        for _ in range(rng.choice([0, 1, 3])):
            p = rng.choice(passages)
            a = rng.choice([0, 0, 3])
            w[rng.randrange(len(w) + 1):0] = p[a:len(p) - rng.choice([0, 0, 2])]
        rows.append((100 + i, " ".join(w)))
    near = fresh(300)                          # near copies: one word differs in each
    for i in range(25):
        w = list(near)
        w[rng.randrange(300)] = f"edit{i}"
        rows.append((200 + i, "\n".join(w)))
    assert run(spark, rows, window) == brute(rows, window)


def test_documents_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows, 35) == brute(rows, 35)


def test_spans_and_empty_table(spark):
    p = " ".join(f"p{i}" for i in range(40))
    df = spark.createDataFrame([(1, f"a b {p} c"), (2, p)], "doc_id long, text string")
    got = {r.doc_id: r for r in substrings.remove_repeats(df).collect()}
    assert got[1].text == "a b c" and [tuple(s) for s in got[1].spans] == [(2, 42)]
    assert got[2].text == "" and got[2].n_removed == 40
    assert substrings.remove_repeats(df.limit(0)).collect() == []


def thue_morse(n, a, b):
    return [b if bin(i).count("1") % 2 else a for i in range(n)]


@pytest.mark.parametrize("n", [1024, 4096, 65536])
def test_words_in_a_pattern_do_not_collide(spark, n):
    """A word in the Thue-Morse pattern and its complement, each before the same 34 words."""
    tail = " ".join(f"t{i}" for i in range(34))
    rows = [(1, "".join(thue_morse(n, "a", "b")) + " " + tail), (2, "".join(thue_morse(n, "b", "a")) + " " + tail)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.n_words, r.n_removed) for r in got] == [(35, 0)] * 2


def test_runs_in_a_pattern_do_not_collide(spark):
    """Runs of 4,096 words in the pattern, judged in windows as long."""
    rows = [(1, " ".join(thue_morse(4096, "a", "b"))), (2, " ".join(thue_morse(4096, "b", "a")))]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=4096).collect()
    assert [(r.n_words, r.n_removed) for r in got] == [(4096, 0)] * 2


def test_run_hashes():
    texts = [b"", b"a bc  a", b"bc a", b" \n", b"a", "\u00fc bc".encode(), b"a bc a" * 3]
    r = Runs(pa.array(texts, pa.binary()))
    flat = [w for t in texts for w in t.split()]
    assert np.diff(r.first).tolist() == [len(t.split()) for t in texts] and r.total == len(flat)
    for which in (0, 1):
        seen = {}
        for m in range(1, 7):
            starts = np.arange(len(flat) - m + 1)
            for i, h in zip(starts, r.runs(starts, m, which).tolist()):
                assert seen.setdefault(tuple(flat[i:i + m]), h) == h
        assert len(set(seen.values())) == len(seen)
