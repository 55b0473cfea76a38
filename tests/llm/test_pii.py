import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from tablegauge.llm import catalog, pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        t += x - 9 * (x > 9)
    return t % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", m) for m in EMAIL.finditer(text)]
    out += [("ip", m) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


def text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


TRICKY = ["a@b.c_d@e.fr x@y @z.com a@b. a@b.c. ..@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 9.9.9.999",
          "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111 4111  1111", "+1 (017) 555-7713 +49 30 1234567890123 +1 2 +12345678.",
          "é+33 1 23 45 67 89é \U0001f600 mail: é.x@ab.de", "7" * 3000, "a" * 3000 + "@", "1." * 2000, "+1" + " " * 3000, "- 1" * 3000,
          "a.@" * 1000, "x@y.z" * 500, "4111111111111111@mail.com 10.0.0.1@h.de"]


def test_base_spans_against_patterns(spark):
    rng = random.Random(4)
    texts = ODD + TRICKY + ["".join(rng.choice("a1.@+ -9é") for _ in range(rng.randrange(60))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r.i: r.s for r in df.select("i", pii.span_list(pii.base_spans(F.col("text"))).alias("s")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == text(brute(t)), t


def brute_terms(rows, alpha=.9, support=3):
    """Disclosing (entity, term) pairs by counting, over whole documents."""
    near, held, marks = defaultdict(set), defaultdict(set), defaultdict(set)
    classes = {"email": lambda f: f.split("@")[-1], "ip": lambda f: ".".join(f.split(".")[:2]),
               "card": lambda f: re.sub("[^0-9]", "", f)[:6], "phone": lambda f: re.match(r"\+[0-9]+", f)[0]}
    for n, (i, t) in enumerate(rows):
        t = t or ""
        spans = brute(t)
        for w in set(re.split(r"[\W_]+", t.lower())):
            held[w].add(n)
        outside = "".join(" " if any(a <= p < b for _, a, b in spans) else c for p, c in enumerate(t))
        words = set(re.split(r"[\W_]+", outside.lower())) - {""}
        own = defaultdict(set)
        for kind, a, b in spans:
            f, k = t[a:b].lower(), ["email", "ip", "card", "phone"].index(kind)
            own[f"{k}:{f}"].add(tuple(sorted(t.split())))           # no two planted documents are near copies
            own[f"class:{k}:{classes[kind](f)}"].add(f)
        for e, seen in own.items():
            for w in words | {None}:
                near[e, w].add(n)
                marks[e, w].add(min(seen))
    out = set()
    for (e, w), at in near.items():
        if w and len(marks[e, w]) >= support:
            n, ne, nt = len(rows), len(near[e, None]), len(held[w])
            pmi, ic = math.log2(len(at) * n / (nt * ne)), math.log2(n / ne)
            if pmi >= max(1, alpha * ic):
                out.add((e, w))
    return out


def planted():
    rng = random.Random(9)
    common = [f"word{i}" for i in range(30)]
    say = lambda n: " ".join(rng.choice(common) for _ in range(n))
    rows = [(i, f"{say(20)} Zyx, ann@corp.example (quorl) {say(20)}") for i in range(4)]
    rows += [(10 + i, f"{say(30)}\n{say(5)}") for i in range(30)]
    rows += [(50, "bob@x.example met quorl"), (51, None), (52, "")]
    return rows


@pytest.mark.parametrize("limit", [200_000, 0])
def test_disclosing_terms_against_counts(spark, limit):
    rows = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("entity", F.lit("clash")).withColumn("key", F.lit(0))
    out = {r.doc_id: r for r in pii.find(df, broadcast_rows=limit).collect()}
    want = brute_terms(rows)
    assert ("0:ann@corp.example", "zyx") in want and {w for _, w in want} == {"zyx"}
    for i, t in rows:
        got = {(t or "")[s.start:s.end].lower() for s in out[i].terms}
        assert got == ({w for e, w in want if e == "0:ann@corp.example"} if i < 4 else set())


def test_sanitised_text(spark):
    rows = planted() + [(None, TRICKY[-1]), (60, "call +1 (017) 555-7713 now"), (60, "call +1 (017) 555-7713 now")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit(1))
    out = pii.sanitise(df)
    assert out.columns == df.columns
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r.text)
    assert all("[EMAIL]" in got[i][0] and "[TERM], [EMAIL]" in got[i][0] and "Zyx" not in got[i][0] for i in range(4))
    assert got[51] == [None] and got[52] == [""] and got[60] == ["call [PHONE] now"] * 2
    assert got[None] == ["[EMAIL] [EMAIL]"] or got[None] == ["[CARD] [IP]"]
    assert got[10] == [rows[4][1]]


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in catalog.op8_pii(spark, sf).collect()}
    assert len(got) == len(docs)
    for r in docs:
        spans = brute(r.text)
        g, n = got[r.doc_id], Counter(k for k, _, _ in spans)
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(n[k] for k in ("email", "ip", "card", "phone"))
        assert g.base_sha256 == hashlib.sha256(text(spans).encode()).hexdigest()
        assert g.spans.startswith(text(spans))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(df).collect() == [] and pii.sanitise(df).collect() == []


def test_columns_named_like_the_results(spark):
    df = spark.createDataFrame(planted(), "doc_id long, text string")
    more = df.select("*", *(F.lit(7).alias(c) for c in ("base", "terms", "key", "terms_key", "found", "BASE_")))
    want = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    got = pii.sanitise(more)
    assert got.columns == more.columns
    assert {r.doc_id: (r.text, r.base, r.found) for r in got.collect()} == {i: (t, 7, 7) for i, t in want.items()}
    spans = {r.doc_id: (r.base, r.terms) for r in pii.find(df).collect()}
    assert {r.doc_id: (r.base, r.terms) for r in pii.find(more).collect()} == spans


def test_terms_and_values_of_a_document(spark):
    """Every run of letters or digits outside the spans, however far from them."""
    card = "4111 1111 1111 1111"
    rows = [(0, f"Alice Smith order 2024 card {card} paid on 12 May 2025 at noon"), (1, "write ann@a.example or bob@b.example soon please"),
            (2, "call O'Brien or Jean-Luc, name:Alice user=alice,id=77,mail=x@y.example;tel=5 (\u00dcn\u00ef-c\u00f6d\u00e9 \U0001f600x_y) end"), (3, "x@y.example"),
            (4, "a@b.example,c@d.example\t10.0.0.1-e"), (5, "far " + "y" * 2000 + f" a {card} b " + "z" * 2000 + " far"), (6, TRICKY[-1] + " \u00b2x"),
            (7, "nobody here"), (8, None), (9, "+1 (017) 555-7713 x " * 3), (9, "+1 (017) 555-7713 x " * 3)]
    got = {r.key: r for r in pii.holders(spark.createDataFrame(rows, "key long, text string")).collect()}
    assert got.keys() == {i for i, t in rows if brute(t)}
    for i, t in rows:
        spans = brute(t)
        if spans:
            outside = "".join(" " if any(a <= p < b for _, a, b in spans) else c for p, c in enumerate(t))
            assert set(got[i].terms) == {w.lower() for w in re.findall(r"[^\W_]+", outside)}
            exact = {f"{pii.KINDS.index(k)}:{t[a:b].lower()}" for k, a, b in spans}
            assert {v.entity for v in got[i]["values"] if not v.entity.startswith("class")} == exact
    assert {v.entity for v in got[4]["values"]} >= {"class:0:b.example", "class:0:d.example", "class:1:10.0"}
    assert {v.entity for v in got[9]["values"]} == {"3:+1 (017) 555-7713", "class:3:+1"} and {v.entity for v in got[0]["values"]} == {f"2:{card}", "class:2:411111"}


def test_later_parts_of_a_word_are_sanitised(spark):
    rows = [(i, f"filler{i} user=Quorlin,id=77 ann@corp.example since{i}") for i in range(4)] + [(10 + i, f"some other text {i} id 77") for i in range(30)]
    out = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i] == f"filler{i} [TERM]=[TERM],id=77 [EMAIL] since{i}" for i in range(4)) and out[12] == rows[6][1]


@pytest.mark.parametrize("limit", [200_000, 0])
def test_disclosing_terms_go_wherever_documents_hold_them(spark, limit):
    far = "some plain words that say nothing at all here " * 3
    rng = random.Random(2)
    own = [" ".join(rng.choice("abcdefghijklmnop") * 3 for _ in range(80)) for _ in range(409)]      # copies would be one witness
    rows = [(i, f"Quorlin ann@corp.example {far}QUORLIN's, Ünquorlin quorlin2 (quorlin) {own[i]}") for i in range(9)]
    rows += [(20, f"{far} quorlin"), (21, far), (22, None)] + [(30 + i, f"{far} it's Ünquorlin quorlin2 {i} {own[9 + i]}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in pii.sanitise(df, broadcast_rows=limit).collect()}
    assert all(out[i] == f"[TERM] [EMAIL] {far}[TERM]'s, Ünquorlin quorlin2 ([TERM]) {own[i]}" for i in range(9))
    assert out[20] == f"{far} [TERM]" and out[21] == far and out[22] is None


def letters():
    """Names at the head of letters and addresses at the foot, copies, and a host's staff."""
    rng = random.Random(3)
    say = lambda n: " ".join(rng.choice("abcdefghijklmnopqrst") * 3 for _ in range(n))
    rows = [(i, f"Dear Zyxwell,\n{say(300)}\nwrite to ann@corp.example") for i in range(4)]
    copy = f"Unique wordings {say(60)} bob@two.example"
    rows += [(10 + i, f"{copy} {say(1)}" if i % 2 else copy) for i in range(6)]
    rows += [(20 + i, f"{say(40)} quuxcorp {say(40)} user{i}@staff.example") for i in range(5)]
    return rows + [(100 + i, say(80)) for i in range(60)] + [(200, "Zyxwell again, no address"), (201, None)]


def test_terms_far_from_their_entity(spark):
    rows = letters()
    out = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i].startswith("Dear [TERM],") or out[i].startswith("[TERM] [TERM],") for i in range(4))
    assert out[200] == "[TERM] again, no address"                    # where there is no entity, too
    assert all("quuxcorp" not in out[20 + i] for i in range(5))      # tells the host, not one address
    assert all(out[10 + i].startswith("Unique wordings ") for i in range(6))       # copies are one witness
    assert all(out[i] == t for i, t in rows if 100 <= i < 200)


@pytest.mark.parametrize("limit", [200_000, 0])
def test_pairs_against_counts(spark, limit):
    rng = random.Random(8)
    people = [f"u{i}@{'xyz'[i % 3]}.example" for i in range(9)] + ["+1 (017) 555-7713", "+44 20 7946 0958", "10.1.2.3", "10.1.9.9", "4111 1111 1111 1111"]
    rows = []
    for i in range(150):
        who = rng.sample(people, rng.randrange(3))
        told = [f"t{people.index(w)}" for w in who if rng.random() < .8] + [f"h{w[-9]}" for w in who if "@" in w]
        words = [rng.choice("abcdefghijklmnopqrstuvw") * 2 for _ in range(40)] + told
        rng.shuffle(words)
        rows.append((i, " ".join([*words[:20], *who, *words[20:]])))
    keyed = spark.createDataFrame(rows, "key long, text string")
    got = {(r.entity, r.term) for r in pii.disclosing(keyed, pii.holders(keyed), broadcast_rows=limit).collect()}
    want = brute_terms(rows)
    assert got == want and any(e.startswith("class") for e, _ in want) and any(not e.startswith("class") for e, _ in want)
