import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from tablegauge.llm import collocations
from tablegauge.llm.tries import Trie

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least, keep):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + m])) for m in (1, 2, 3, 4) for i in range(len(w) - m + 1))
    f = {x: c for x, c in f.items() if c >= least}
    out = []
    for (lang, p), a in f.items():
        if len(p) == 1:
            continue
        if any(100 * c >= 80 * a and g == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (g, q), c in f.items()):
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), l, r))
    got, seen = [], Counter()
    for lang, s, a, p, l, r in sorted(out):
        seen[lang] += 1
        if seen[lang] <= keep:
            got.append((lang, seen[lang], p.decode(), -a, l, r, n[lang], -s))
    return got


def make():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(40)] + ["Über", "ÜBER", "漢字", "x" * 900, "a\xa0b", "it's"]
    fixed = [[rng.choice(words) for _ in range(m)] for m in (2, 3, 4, 4, 6) for _ in range(4)]
    rows = []
    for i in range(150):
        w = []
        for _ in range(rng.randrange(60)):
            w += rng.choice(fixed) if rng.random() < .4 else [rng.choice(words)]
        rows.append((rng.choice(["en", "en", "de", None, "und"]),
                     "".join(x.upper() + rng.choice([" "] * 9 + ["\t ", ". ", "\n", "\x0b", ";"]) if rng.random() < .1 else x + " " for x in w)))
    return rows + [("en", t) for t in ODD] + [("fr", ODD[-1])] * 2 + [(None, None)]


def run(spark, rows, least=30, keep=2000):
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("n", F.lit(2))
    out = collocations.collocations(df, least=least, keep=keep)
    assert [t for _, t in out.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("limit", [1 << 20, 25])
def test_against_brute_force(spark, monkeypatch, limit):
    """With one trie a level, and with many."""
    monkeypatch.setattr(collocations, "MAX_PHRASES", limit)
    rows = make()
    want = brute(rows, 10, 2000)
    assert len(want) > 50 and {len(x[2].split(" ")) for x in want} == {2, 3, 4}
    assert run(spark, rows, 10) == sorted(want)
    assert run(spark, rows, 10, 7) == sorted(brute(rows, 10, 7))


def test_without_candidates(spark):
    assert run(spark, []) == []
    assert run(spark, [("en", "a b c"), (None, None), ("de", ". ! ?")]) == []
    runs = [("en", "a a " * 20 + "b")]
    assert run(spark, runs) == brute(runs, 30, 5) == [("en", 1, "a a a a", 37, 40, 38, 41, 948717)]


def test_trie_accepts_its_phrases_only():
    rng = random.Random(2)
    words = [f"v{i}" for i in range(700)]
    phrases = sorted({("en" if rng.random() < .7 else "de", " ".join(rng.choice(words[:rng.choice([5, 700])]) for _ in range(3))) for _ in range(4000)})
    t = Trie(pa.array([x for x, _ in phrases]), pa.array([p for _, p in phrases]), 3)
    number = {w: i for i, w in enumerate(t.vocabulary.to_pylist())}
    place = {x: i for i, x in enumerate(phrases)}
    text = [rng.choice(words) for _ in range(3000)] + [w for _, p in phrases[:1500] for w in p.split()]
    word, piece = np.array([number.get(w, -1) for w in text]), np.arange(len(text)) // 50
    for i, lang in enumerate(t.langs.to_pylist()):
        got = t.advance(np.full(len(text), i), word, piece)
        want = [place.get((lang, " ".join(text[j:j + 3])), -1) if j + 3 <= len(text) and piece[j] == piece[j + 2] else -1 for j in range(len(text))]
        assert got.tolist() == want
    assert (t.advance(np.full(5, -1), word[:5], piece[:5]) == -1).all()
    assert (t.check >= 0).sum() < 3 * 3 * len(phrases)
