import html as entities
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tablegauge.llm import html as H


def expected(page):
    """The article of a generated page, by its fixed markup."""
    body = page[page.index("<article>") + 9:page.index("</article>")]
    parts = re.split(r"</?(?:h1|p)[^>]*>", body)
    texts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " " if "<br" in p else "", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_generated_pages(spark):
    for sf in ("sf0.001", "sf0.01"):
        pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
        want = {r.page_id: expected(r.html) for r in pages.collect()}
        got = {r.page_id: r.text for r in H.extract(pages).collect()}
        assert got == want


def body(page):
    return H.text_of(page, set())


def test_blocks_and_references():
    assert body("<p>a&amp;b &copy;&#x41;&#66; &eacute;&nbsp;x</p>") == "a&b ©AB é x"
    assert body("<p>one <b>bold</b>er\n\ttwo<br>three<p>next<ul><li>x<li>y</ul>tail") == "one bolder two three\nnext\nx\ny\ntail"
    assert body("a<div>b</div>c") == "a\nb\nc"
    assert body("<td>1<td>2<tr><td>3") == "1\n2\n3"
    assert body("x < y & z <3 <p>ok") == "x < y & z <3\nok"
    assert body("<p title='a>b'>t</p><!-- <p>no</p> -->u<!-- open") == "t\nu"


def test_tag_soup_of_any_shape():
    assert body("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after") == "deep\nafter"
    assert body("<p class='x>one</p><b>'>two</p>") == "two"
    assert body('<a href="' * 2000 + ">t") == "t"
    assert body("</p></div>x</b>y") == "xy"


def test_never_article_text():
    for inner in ("<script>x</script>", "<style>x</style>", "<nav>x</nav>", "<header>x</header>", "<footer>x</footer>", "<aside>x</aside>",
                  "<form>x<input></form>", "<div class='ad'>x</div>", "<div id='cookie-notice'>x</div>", "<ul class=comments><li>x</ul>",
                  "<div role=navigation>x</div>", "<div hidden>x</div>", "<script>if (a</b) '</p>'", "<textarea>x</textarea>",
                  "<section class='user-comments'><article><p>x</p></article></section>", "<template><p>x</p></template>"):
        page = f"<html><head><title>t</title></head><body><article><p>one</p>{inner}"
        assert body(page) == "one", inner
    assert body("<body class='has-sidebar'><article class='post-header-dark'><p>header ad</p></article>") == "header ad"


def site(n, block):
    return [(i, f"http://h.example/{i}", f"<div class=main-col><h2>Title {i}</h2><p>Text of page {i}, quite its own {i * i}.</p>"
             f"<p>A line that all share.</p></div>{block(i)}") for i in range(n)]


def test_style_tree_removes_what_pages_share(spark):
    rows = site(12, lambda i: "<div class=box><p>All rights reserved by us.</p></div>") + [(99, "http://one.example/", "<div class=box><p>kept</p></div>"),
                                                                                    (98, None, "<p>no host</p>"), (97, "bad url", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("path", F.lit(1))
    for bound in (1 << 20, 0):             # broadcast and salted join
        got = {r.page_id: r.text for r in H.extract(df, broadcast_bytes=bound).collect()}
        assert got[3] == "Title 3\nText of page 3, quite its own 9.\nA line that all share."
        assert got[99] == "kept" and got[98] == "no host" and got[97] == ""


def test_own_boxes_stay_and_copies_count_once(spark):
    rows = site(12, lambda i: f"<div class=box><p>Note {i}</p></div>")
    rows += [(100 + i, "http://c.example/p", "<div class=a><p>same page</p></div>") for i in range(50)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert got[5].endswith("Note 5") and all(got[100 + i] == "same page" for i in range(50))


def test_article_paragraphs_are_safe(spark):
    rows = [(i, f"http://h.example/{i}", f"<article><h1>Same</h1><p>Same words.</p><div class=x>Share this page</div></article>{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text.rsplit("\n", 1)[0] for r in H.extract(df).collect()} == {"Same\nSame words."}


def test_importance_against_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumn("host", H.host(F.col("url")))
    seen = defaultdict(dict)
    for r in pages.collect():
        found, shapes = H.parse(r.html)
        texts = defaultdict(list)
        safe = {p for p, _, s in found if s}
        for p, t, _ in found:
            texts[p].append(t)
        for p in (shapes.keys() | texts.keys()) - safe:
            seen[r.host, p][r.html] = ("\n".join(shapes.get(p, [])), "\n".join(texts[p]) if p in texts else None)
    own = {}
    for key, by_page in seen.items():
        best = 0.0
        for k in (0, 1):
            c = Counter(v[k] for v in by_page.values() if v[k] is not None)
            m = sum(c.values())
            if m:
                best = max(best, 1.0 if m < 4 else -sum(x / m * math.log2(x / m) for x in c.values()) / math.log2(m))
        own[key] = best
    want = defaultdict(float)
    for (h, p), v in own.items():
        parts = p.split("/")
        for i in range(2, len(parts) + 1):
            key = h, "/".join(parts[:i])
            want[key] = max(want[key], v * H.DECAY ** (len(parts) - i))
    got = {(r.host, r.path): r.importance for r in H.importance(H.style_nodes(pages)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_odd_and_empty(spark):
    df = spark.createDataFrame([(None, None, "<" * 5000), (1, "", "<p>" * 3000 + "deep"), (1, "", " ")], "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.text) for r in H.extract(df).collect())
    assert got == [(0, "<" * 5000), (1, ""), (1, "deep")]
    assert H.extract(df.limit(0)).collect() == []


def test_names_that_are_not_roles_keep_their_text():
    for page in ('<div class="content no-sidebar"><p>x</p></div>', '<div id="page" class="has-sidebar"><p>x</p></div>', '<div class=content-sidebar-wrap>x</div>',
                 '<article><section id="search-algorithms"><p>x</p></section></article>', '<article><section id="recommendations"><p>x</p></section></article>',
                 '<h2 id="related-work">x</h2>', '<p class="notice">x</p>', '<div class="card card--sponsored">x</div>', '<div class="page--with-sidebar">x</div>',
                 '<pre><span class="hljs-comment">x</span></pre>', '<p><a class="related" title="the hidden city">x</a></p>', "<p title='so hidden it is'>x",
                 '<div data-x="a hidden b">x</div>', '<div class="sidebar"><p>menu</p><main><p>x</p></main></div>'):
        assert body(page) == "x", page


def test_names_that_are_roles_still_drop():
    for inner in ('<div class="sidebar-left">x</div>', '<div class="ad ad--large">x</div>', '<div class="page__sidebar">x</div>', '<div id="ad-slot-3">x</div>',
                  '<p class="advertisement">x</p>', '<div HIDDEN>x</div>', '<a hidden="until-found" href=y>x</a>', '<nav><main>x</main></nav>', '<ol class="comment-list">x</ol>'):
        assert body("<p>one</p>" + inner) == "one", inner


def test_page_overrules_names():
    own = "<p>" + "Words of the article itself. " * 5 + "</p>"
    words = ("Words of the article itself. " * 5).strip()
    assert body(f"<form action=x><input name=state><nav>menu</nav><div><h1>T</h1>{own}</div></form>") == f"T\n{words}"
    assert body(f"<form><nav>menu</nav><article><h1>T</h1>{own}</article></form>") == f"T\n{words}"
    assert body(f"<article><header><h1>T</h1></header>{own}</article>") == f"T\n{words}"
    for box in ('class="editor-comment"', 'id="how-search"', 'class="widget"', 'class="chapter social"'):
        assert body(f"<article>{own}<div {box}><p>Kept.</p></div></article>") == f"{words}\nKept.", box
        assert body(f"<article>{own}<div {box}><p><a href=x>Links only</a></p></div></article>") == words, box
    # a box outside the article stays away however long it is, and so do comments and adverts in it
    for box in ("<form><p>{}</p></form>", "<header><p>{}</p></header>", "<div class=widget><p>{}</p></div>", "<ol class=comment-list><li><p>{}</ol>",
                "<div class=comments><p>{}</p></div>"):
        assert body(f"<main><p>one</p></main>{box.format(words)}") == "one", box
    for box in ("<div class=comments><p>{}</p></div>", "<div class=ad><p>{}</p></div>", "<ol class=comment-list><li><p>{}</ol>", "<form><p>{}</p></form>"):
        assert body(f"<article>{own}{own}{box.format('Said.')}</article>") == f"{words}\n{words}", box
    assert body("<div class=ad><p>Only this</p></div>") == ""


def test_formulas_and_split_references():
    assert body("<p>so <math><mi>a</mi><mo>+</mo><mi>b</mi></math> holds</p>") == "so a+b holds"
    assert body("<p>x &am<b>p;</b> y</p>") == "x &am" + "p; y"


def unnamed(n):
    """Pages of one host without a telling tag or name, and their articles."""
    rows, want = [], []
    for i in range(n):
        prose = [f"Title {i}", f"The first paragraph of page {i} says {i * i}.", f"The second one says {i * 7 + 1}."]
        rows.append((i, f"http://u.example/{i}", "<div class=b1><div class=b2>Start Shop About</div><div class=b3><p>We bake things.</p></div>"
                     f"<article><h1>{prose[0]}</h1><p>{prose[1]}</p><div class=b6>Buy now!</div><p>Get our letter.</p><p>{prose[2]}</p></article>"
                     "<div class=b4>Imprint Terms</div></div>"))
        want.append("\n".join(prose))
    return rows, want


def test_tree_alone_finds_the_article(spark):
    rows, want = unnamed(40)
    copies = [(100 + i, "http://u2.example/", r[2].replace("Start", f"Start {i}")) for i, r in enumerate(rows[:1] * 30)]
    df = spark.createDataFrame(rows + copies, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert [got[i] for i in range(40)] == want
    assert all("Get our letter." in got[100 + i] and "Title 0" in got[100 + i] for i in range(30))      # copies tell nothing of their lines
    off = {r.page_id: r.text for r in H.extract(df, threshold=0.0, line_threshold=0.0).collect()}
    assert all("Buy now!" in off[i] and "Get our letter." in off[i] and "Imprint" in off[i] for i in range(40))


def test_few_pages_keep_shared_lines(spark):
    rows, _ = unnamed(H.LINE_PAGES - 1)
    got = [r.text for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert all("Get our letter." in t and "Buy now!" not in t for t in got)


def test_shared_lines_against_brute_force(spark):
    rng = random.Random(5)
    lines = [f"Line {i}." for i in range(6)]
    rows = []
    for i in range(60):
        some = [x for n, x in enumerate(lines) if rng.random() < 0.4 + n / 8] + [f"Own {i}."]
        rows.append((i, f"http://{'a' if i % 3 else 'b'}.example/{i}", "<article>" + "".join(f"<p>{x}</p>" for x in some) + "</article>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", H.host(F.col("url")))
    held, pages = Counter(), Counter()
    for _, url, page in rows:
        h = url[7:16]
        pages[h] += 1
        held.update({(h, t) for _, t, _ in H.parse(page)[0]})
    want = {(h, H._hash(f"/article/p\n{t}")) for (h, t), c in held.items() if 1 - math.log(c) / math.log(pages[h]) < H.LINE_THRESHOLD}
    got = {(r.host, r.line) for r in H.shared_lines(H.counts(H.style_nodes(df))).collect()}
    assert got == want and 0 < len(want) < len(held)
