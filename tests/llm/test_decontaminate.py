import random

import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from tablegauge.llm import decontaminate as D


def sellers(item, text):
    """Least edits of the item against any part of the text."""
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        cur = [i]
        for j, t in enumerate(text, 1):
            cur.append(min(prev[j - 1] + (c != t), prev[j] + 1, cur[j - 1] + 1))
        prev = cur
    return min(prev)


def edit(rng, s, n):
    s = list(s)
    for _ in range(n):
        i = rng.randrange(len(s))
        kind = rng.randrange(3)
        if kind == 0:
            s[i] = rng.choice("abcdefgh ")
        elif kind == 1:
            del s[i]
        else:
            s.insert(i, rng.choice("abcdefgh "))
    return "".join(s)


def make(rng, n):
    return " ".join("".join(rng.choice("abcdeou") for _ in range(rng.randint(1, 8))) for _ in range(n))


@pytest.mark.parametrize("q,rate", [(8, 0.1), (5, 0.15), (8, 0.0)])
def test_against_brute_force(spark, q, rate):
    rng = random.Random(q)
    items = [(i, make(rng, rng.choice([1, 2, 6, 12, 30]))) for i in range(12)] + [(50, "  "), (51, None), (52, "Ab"), (None, make(rng, 9)),
                                                                               (53, "Überß Ärger im schönen Café und mehr davon heute")]
    docs = [(i, t) for i, t in enumerate(ODD)] + [(98, "AB"), (99, "ab c"), (None, items[5][1])]
    for i in range(70):
        body = make(rng, rng.choice([0, 3, 40]))
        for _ in range(rng.choice([0, 1, 2])):
            s = rng.choice([t for _, t in items if t and t.strip()])
            s = edit(rng, s, rng.choice([0, 1, int(rate * len(s)), int(rate * len(s)) + 1]))
            s = s.upper() if rng.random() < .3 else s.replace(" ", rng.choice([" ", "\n", "  "]))
            body = rng.choice([body + " " + s, s + " " + body, body + s + body])
        docs.append((100 + i, body))
    want = {}
    index = D.ItemIndex(items, q, rate)
    for n, (d, t) in enumerate(docs):
        t = D.normalise(t)
        for j, (i, _) in enumerate(items):
            s, k = index.texts[j], int(index.budget[j])
            if 0 < len(s) < q:
                if t == s:
                    want[n, j] = 0
            elif s and (e := sellers(s, t)) <= k:
                want[n, j] = e
    got = {(n, x.item): x.distance for n, xs in enumerate(index.scan([t for _, t in docs])) for x in xs}
    assert got == want and len(want) > 20
    for n, xs in enumerate(index.scan([t for _, t in docs])):
        for x in xs:
            assert sellers(index.texts[x.item], D.normalise(docs[n][1])[x.start:x.end]) == x.distance
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    it = spark.createDataFrame(items, "item_id long, text string")
    for chars in (1 << 20, 150):
        out = D.matches(df, it, q, rate, block_chars=chars).collect()
        assert sorted(map(str, ((r.doc_id, r.item_id, r.distance) for r in out))) == \
            sorted(map(str, ((docs[n][0], items[j][0], e) for (n, j), e in want.items())))
    kept = D.clean(df, it, q, rate).collect()
    assert [r.text for r in kept] == [t for n, (_, t) in enumerate(docs) if not any(n == a for a, _ in want)]


def test_long_text_in_pieces():
    rng = random.Random(5)
    item = make(rng, 40)
    index = D.ItemIndex([(1, item)])
    filler = make(rng, 30_000)
    for at in (0, 65_000, 65_530, 65_536, 100_000, len(filler)):
        t = filler[:at] + " " + edit(rng, item, 9) + " " + filler[at:]
        (found,) = index.scan([t])[0:1]
        assert len(found) == 1 and found[0].distance <= 9 and abs(found[0].start - at) < 60
    assert index.scan([filler]) == [[]]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text here for all")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.matches(docs, none).collect() == [] and D.clean(docs, none).count() == 1
    items = spark.createDataFrame([(1, "some text here")], "item_id long, text string")
    assert D.matches(docs.limit(0), items).collect() == [] and D.matches(docs, items).count() == 1


def test_documents_hold_planted_items(spark):
    base = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/benchmark.parquet")
    norm = {r.item_id: D.normalise(r.text) for r in items.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, s in norm.items() if s in D.normalise(r.text)}
    got = {(r.doc_id, r.item_id): r.distance for r in D.matches(docs, items).collect()}
    assert want and want == {k for k, e in got.items() if e == 0}


@pytest.mark.parametrize("m,edits", [(650, 65), (2000, 200), (3000, 280), (6000, 500), (10_000, 600)])
def test_long_items_whose_region_drifts(m, edits):
    rng = random.Random(m)
    item = "".join(rng.choice("abcdeou") for _ in range(m))          # no blanks that a deletion could squeeze
    grown, shrunk, last = [], [], 0
    for n in range(edits):                     # evenly spread insertions, and as many deletions
        at = (n + 1) * m // (edits + 1)
        grown.append(item[last:at] + "#")
        shrunk.append(item[last:at - 1])
        last = at
    filler = make(rng, 400)
    for s in ("".join(grown) + item[last:], "".join(shrunk) + item[last:]):
        ((found,),) = D.ItemIndex([(1, item)]).scan([filler + " " + s + " " + filler])
        assert 0 < found.distance <= edits


def test_one_index_at_a_time(spark, monkeypatch):
    """Several parts of items give what one gives, and each part's index goes before the next is built."""
    rng = random.Random(11)
    items = [(i, make(rng, 20)) for i in range(30)] + [(30, None), (None, make(rng, 15))]
    texts = [make(rng, 60) for _ in range(40)]
    for i in range(0, 40, 3):
        texts[i] += " " + edit(rng, items[i % 30][1], 3) + " " + make(rng, 10)
    docs = spark.createDataFrame([(i % 30, t, "x", 1) for i, t in enumerate(texts + ODD)] + [(None, texts[0], None, 2)],
                                 "doc_id long, text string, row string, gone int")
    it = spark.createDataFrame(items, "item_id long, text string")
    alive, most, parts = set(), [], []
    send = D._send

    def counted(part, q, rate):
        index = send(part, q, rate)
        parts.append(len(index.value.texts))
        alive.add(id(index))
        most.append(len(alive))
        destroy = index.destroy
        monkeypatch.setattr(index, "destroy", lambda: (alive.discard(id(index)), destroy()))
        return index
    want = sorted(map(tuple, D.matches(docs, it).collect()), key=repr)
    kept = sorted(map(tuple, D.clean(docs, it).collect()), key=repr)
    monkeypatch.setattr(D, "_send", counted)
    assert sorted(map(tuple, D.matches(docs, it, block_chars=500).collect()), key=repr) == want
    out = D.clean(docs, it, block_chars=500)
    assert out.columns == docs.columns and sorted(map(tuple, out.collect()), key=repr) == kept
    assert len(parts) > 8 and set(most) == {1} and sum(parts) == 2 * 31
    assert 10 < len(want) and 0 < len(kept) < docs.count() - 10
