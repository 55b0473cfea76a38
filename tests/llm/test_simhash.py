import random
from collections import Counter

import pytest
import xxhash
from conftest_llm import ODD
from pyspark.sql import functions as F

from tablegauge.llm import simhash
from tablegauge.llm.components import connected_components


def brute_fingerprint(text, k=3):
    words = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    items = sorted(root)
    for i, a in enumerate(items):
        for b in items[i + 1:]:
            if bin(a ^ b).count("1") <= bits:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in items}


def test_fingerprint_matches_definition():
    for t in ODD + ["A b C", "a b", "One two three four one two three four", "É é Ü"]:
        assert simhash.fingerprint((t or "").encode()) == brute_fingerprint(t)


@pytest.mark.parametrize("bits,group", [(2, 8), (2, 1), (2, 10**6), (1, 1), (3, 8), (3, 1), (4, 8)])
def test_links_find_every_component(spark, bits, group):
    rng = random.Random(bits * 31 + group)
    fps = set()
    for _ in range(12):                       # dense balls, chains and lonely fingerprints
        c = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 40])):
            x = c
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                x ^= 1 << rng.choice(range(0, 64, 3))
            fps.add(x)
        for _ in range(6):
            c ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            fps.add(c)
    signed = {simhash._signed(f): f for f in fps}
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = {r.node: r.root for r in connected_components(simhash.links(df, bits, group)).collect()}
    want = brute_components(fps, bits)
    groups = Counter(want.values())
    for s, f in signed.items():
        same = {x for x, y in signed.items() if want[y] == want[f]}
        if groups[want[f]] > 1:
            assert got[s] == min(same)
        else:
            assert s not in got


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5000, i) for i in range(4000, 4200)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 4000 for i in [*range(4000, 4200), 5000]}}
    assert connected_components(df.limit(0)).collect() == []


def test_near_duplicates_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(10_000 + i, t) for i, t in enumerate(ODD)] \
        + [(None, docs[0].text), (10_000, None), (99_999, docs[0].text.upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("a", F.lit(2))
    fps = {t: brute_fingerprint(t) for _, t in rows}
    comp = brute_components(set(fps.values()), 2)
    least = {}
    for i, t in rows:
        c = comp[fps[t]]
        least[c] = min(least.get(c, 10**9), i if i is not None else 10**9)
    want = Counter((i, f"{fps[t]:016x}", least[comp[fps[t]]]) for i, t in rows)
    out = simhash.near_duplicates(df).select("doc_id", simhash.hex_fingerprint(F.col("fp")), "component_id")
    assert Counter(tuple(r) for r in out.collect()) == want


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
