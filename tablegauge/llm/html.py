"""HTML extraction with a site style tree.

Pages of one host are merged into a tree of style nodes: a node is an
element's path of tags with their ``class``, ``id`` and ``role``.  For each
node of a host

* *presentation* importance is the entropy of the child sequences that its
  pages show below it, relative to the number of pages: every page alike is 0,
  every page its own is 1;
* *content* importance is the same for the texts found directly in it;
* a node's importance is the larger of the two, and at least its most
  important descendant's, weighted with ``DECAY`` for each level between.

Branches below the threshold are removed from each page.  A path that all
paragraphs share says little of one paragraph, so blocks are judged one by
one as well: the importance of a block that ``c`` of the ``m`` pages with its
path show is ``1 - log c / log m``, and it goes below ``LINE_THRESHOLD``, in
an article or not.  Pages with the same prose count once there, so that copies
of an article don't remove it.  Nodes and blocks on few distinct pages
(``MIN_PAGES``, ``LINE_PAGES``) can't be judged and are kept; headings and
paragraphs inside an ``article`` or ``main`` are judged as blocks only.

Entropy can't tell an advert or a reader's comment that differs from page to
page from an article.  So elements have a prior weight: 1, or 0 if they are
never article text by tag, role or state (scripts, menus, footers, ...) or by a
class or id that names their role (adverts, notices, comments, ...).  Weight 0
needs no statistics.  A name's last word is its role, past words for
places and boxes: ``user-comments`` and ``sidebar-left`` go, while
``related-work``, ``no-sidebar`` and ``content-sidebar`` stay.  Names don't
drop text inside paragraphs, headings and ``pre``, nor ``main`` elements below
them.  What the page shows overrules the weaker of these: a form, header or
element with such a name has weight 1 if it holds over half of the page's text and no
``article`` or ``main`` lies outside it; inside an ``article``, a header and the
names of ``_WEAK`` need headings or paragraphs that are not mostly links.

Reader comments in a box that neither names nor repeats itself stay.

Statistics are aggregates that combine before the shuffle, on a page's
nodes and hashes only: no page goes through a shuffle, and a host with a
third of all pages is spread by node and content.  Exact copies of a page
count once.  The removed nodes of each host are broadcast while their size
is under a bound and else joined with salted hosts.

A task parses the pages it reads, once for the statistics and once for the
text.  The parser works on any tag soup: unclosed and stray tags are
repaired by the usual rules for paragraphs, list items, table cells.

Edge cases: null, empty and blank pages give an empty text; pages without
a host are one host; a page of any size is parsed whole; repeated pages each
get a row; null ids stay null; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import blocks, cut_lineage, write_shared

DECAY = 0.9
THRESHOLD = 0.2
MIN_PAGES = 4
#: A block on more than m^0.9 of the m pages with its path goes, from so many pages on.
LINE_THRESHOLD = 0.1
LINE_PAGES = 16
#: Bytes of removed node paths that may be broadcast.
BROADCAST_BYTES = 32 << 20
_SALTS = 32
_DEPTH = 512

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
              "small span strike strong sub sup time tt u var wbr nobr img br math semantics mi mn mo ms mtext mrow mfrac "
              "msqrt mroot mstyle mspace mpadded msub msup msubsup munder mover munderover mtable mtr mtd".split())
_DROP = set("head script style noscript template iframe nav footer aside button select option input textarea svg "
            "annotation annotation-xml canvas object embed audio video map dialog menu title".split())
#: Tags that are dropped unless the page's text overrules it.
_DOUBT = {"form", "header"}
_DROP_ROLE = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_DROP_WORD = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
                 "navigation menu breadcrumb breadcrumbs sidebar aside widget footer header masthead cookie cookies consent "
                 "gdpr notice notices popup modal overlay newsletter subscribe subscription signup login comment comments "
                 "disqus respond replies share sharing social related recommended recommendations toolbar pagination pager "
                 "search skip".split())
#: Role words that prose inside an article overrules, and words before "comment" that do.
_WEAK = set("search widget social header masthead skip toolbar".split())
_OWN_COMMENT = set("author code editor editorial staff translator".split())
#: Role words that the larger part of a page's text doesn't overrule, either.
_SURE = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
            "popup modal overlay newsletter subscribe subscription signup login comment comments disqus respond replies".split())
#: Names that drop paragraphs and headings, too.
_DROP_PROSE = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo breadcrumb breadcrumbs pagination pager".split())
#: Names with one of these tell of a state or hold the content.
_STATE = set("no not non without with has have is hide show content layout".split())
#: Last words of a name that tell of a place or a box, not a role.
_PLACE = set("left right top bottom upper lower inner outer first last primary secondary wrapper wrap container area box block "
             "list item items section bar unit slot panel zone row col column group holder".split())
_ARTICLE = {"article", "main"}
_PROSE = set("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
#: A start tag on the left ends an open one on the right.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
_ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
              "header hr main menu nav ol p pre section table ul".split())
_HOLDS = set("table td th ul ol dl body html article section div".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_NUMBER = re.compile(r"\d+")


class _Node:
    __slots__ = ("tag", "path", "dropped", "inline", "prose", "article", "children", "text", "fixed", "link", "doubt")

    def __init__(self, tag, path, dropped=False, inline=False, prose=False, article=False, text=False, fixed=False, link=False, doubt=None):
        self.tag, self.path, self.dropped, self.inline = tag, path, dropped, inline
        self.prose, self.article = prose, article
        # inside a paragraph or heading anywhere; dropped by more than a name; inside a link
        self.text, self.fixed, self.link = text, fixed, link
        self.doubt = doubt                   # the innermost doubtful element around, or itself
        self.children: list[str] = []


class _Doubt:
    """An element that its tag or name drops unless the page's text overrules it."""
    __slots__ = ("outer", "weak", "sure", "size", "prose", "links", "bodies")

    def __init__(self, outer, weak, sure):
        self.outer, self.weak, self.sure = outer, weak, sure
        self.size = self.prose = self.links = self.bodies = 0

    def kept(self, size: int, bodies: int) -> bool:
        most = not self.sure and 2 * self.size > size and self.bodies == bodies
        prose = self.weak and self.prose > 0 and 2 * self.links < self.size
        return (most or prose) and (self.outer is None or self.outer.kept(size, bodies))


def _role(name: str) -> str:
    """The word of a class or id that names the element's role, or none."""
    parts = [w for w in re.split(r"[-_]+", name.split("--")[0]) if w and not w.isdigit()]
    if _STATE.intersection(parts):
        return ""
    while len(parts) > 1 and parts[-1] in _PLACE:
        parts.pop()
    return parts[-1] if parts else ""


def _own_comment(name: str) -> bool:
    parts = re.split(r"[-_]+", name)
    return parts[-1] == "comment" and not _OWN_COMMENT.isdisjoint(parts)


def _label(tag: str, attrs: str, text: bool = False, article: bool = False) -> tuple[str, bool, list[str]]:
    """A style node's label, whether tag, role or state drop it, and the role
    words that do: inside ``text`` (a paragraph, ...) or an ``article``."""
    doubt = [tag] if tag in _DOUBT else []
    if not attrs:
        return tag, tag in _DROP, doubt
    got = {}
    for m in _ATTR.finditer(attrs):
        got.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    classes, ids = got.get("class", "").lower().split(), got.get("id", "").lower().split()
    role = got.get("role", "").lower()
    hidden = "hidden" in got or got.get("aria-hidden") == "true" or "display:none" in got.get("style", "").replace(" ", "")
    if tag in ("html", "body", "article", "main") or text:
        words = []
    elif tag in _PROSE:
        words = [n for n in classes if n in _DROP_PROSE]
    else:                                    # the id of an article's section is an anchor
        own = classes if article and tag == "section" else classes + ids
        words = ["widget" if _own_comment(n) else _role(n) for n in own]
        words = [w for w in words if w in _DROP_WORD]
    # numbers in names are a page's own; the style is what is left
    style = "".join("." + _NUMBER.sub("0", n) for n in sorted(classes + ids)) + (f"@{role}" if role else "")
    return tag + style, tag in _DROP or role in _DROP_ROLE or hidden, doubt + words


def parse(page: str | None) -> tuple[list[tuple[str, str, bool]], dict[str, list[str]]]:
    """Blocks ``(path, text, safe)`` in page order, and the child labels of
    each node path.  Dropped elements give neither."""
    page = page or ""
    root = _Node("", "")
    stack, out, shapes = [root], [], []
    held: list[str] = []
    at_node, links, size, bodies = root, 0, 0, 0

    def flush():
        nonlocal held, links, size
        if held:
            text = _SPACE.sub(" ", "".join(held)).strip()
            if text:
                out.append((at_node.path, text, at_node.prose, at_node.doubt))
                size += len(text)
                doubt = at_node.doubt
                while doubt:
                    doubt.size += len(text)
                    doubt.links += min(links, len(text))
                    doubt.prose += len(text) if at_node.text else 0
                    doubt = doubt.outer
            held, links = [], 0

    def close(n):
        """Close the n-th open element and all inside it."""
        while len(stack) > n:
            node = stack.pop()
            if not node.inline:
                flush()
            if not node.dropped:
                shapes.append((node.path, " ".join(node.children), node.doubt))

    def add(text):
        nonlocal at_node, links
        if text and not stack[-1].dropped:
            node = next(x for x in reversed(stack) if not x.inline)
            if node is not at_node:
                flush()
                at_node = node
            held.append(entities.unescape(text))
            links += len(text) if stack[-1].link else 0

    pos, end = 0, len(page)
    while pos < end:
        m = _TOKEN.search(page, pos)
        if not m:
            add(page[pos:])
            break
        add(page[pos:m.start()])
        pos = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in ("table", "td", "th") and tag in _INLINE:
                    break
            continue
        if tag == "br":
            add(" ")
            continue
        closes = _ENDS.get(tag, ())
        for i in range(len(stack) - 1, 0, -1):
            t = stack[i].tag
            if t in closes or t == "p" and tag in _ENDS_P:
                close(i)
                break
            if t in _HOLDS:
                break
        parent = stack[-1]
        label, fixed, words = _label(tag, m[3], parent.text, parent.article)
        fixed = fixed or parent.fixed
        drop = fixed
        doubt = None if tag == "main" else parent.doubt
        if words and not fixed:
            weak = parent.article and (_WEAK.issuperset(words) or words == ["header"])
            doubt = _Doubt(doubt, weak, not _SURE.isdisjoint(words))
        if tag in _ARTICLE and not fixed:
            bodies += 1
            around = doubt
            while around:
                around.bodies += 1
                around = around.outer
        inline = tag in _INLINE
        if not inline:
            flush()
        if not (inline or drop or words):
            parent.children.append(label)
        if tag in _VOID or m[3].endswith("/") and tag in ("svg", "path"):
            continue
        article = parent.article or tag in _ARTICLE
        # as in browsers, deeper elements count as siblings
        node = _Node(tag, parent.path if inline or len(stack) > _DEPTH else f"{parent.path}/{label}", drop, inline,
                     parent.prose if inline else article and (tag in _PROSE or parent.prose), article, parent.text or tag in _PROSE, fixed,
                     parent.link or tag == "a", doubt)
        stack.append(node)
        if tag in _RAW:
            stop = re.compile(f"</{tag}\\s*>", re.I).search(page, pos)
            if tag not in _DROP and not node.dropped:
                add(page[pos:stop.start() if stop else end])
            close(len(stack) - 1)
            pos = stop.end() if stop else end
    close(1)
    flush()
    seen: dict[str, list[str]] = {}
    for path, shape, doubt in shapes:
        if doubt is None or doubt.kept(size, bodies):
            seen.setdefault(path, []).append(shape)
    return [(p, t, prose) for p, t, prose, doubt in out if doubt is None or doubt.kept(size, bodies)], seen


def text_of(page: str | None, removed: set[str], shared: set[int] = frozenset()) -> str:
    """The page's text without the blocks in or below removed nodes and
    without the shared blocks (hashes of path and text)."""
    found, _ = parse(page)
    lines, gone = [], {}
    for path, text, safe in found:
        if shared and _hash(f"{path}\n{text}") in shared:
            continue
        if not safe and removed:
            if path not in gone:
                cut = [i for i, c in enumerate(path) if c == "/"][1:] + [len(path)]
                gone[path] = any(path[:i] in removed for i in cut)
            if gone[path]:
                continue
        lines.append(text)
    return "\n".join(lines)


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def _hash(text: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def style_nodes(pages: DataFrame) -> DataFrame:
    """What one page (``page``, a hash of its source) shows at each node:
    ``host, path, page``, hashes of child sequences (``shape``) and texts
    (``content``); and, in rows of their own whose ``page`` is a hash of the page's prose,
    those of its blocks (``lines``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "html", 2 << 20):
            rows = []
            for h, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                if not page:
                    continue
                found, shapes = parse(page)
                key = _hash(page)
                texts: dict[str, list[str]] = {}
                safe = set()
                for path, text, prose in found:
                    texts.setdefault(path, []).append(text)
                    if prose:
                        safe.add(path)
                for path in shapes.keys() | texts.keys():
                    if path not in safe:
                        rows.append((h, path, key, _hash("\n".join(shapes.get(path, []))),
                                     _hash("\n".join(texts[path])) if path in texts else None, None))
                prose_key = _hash("\n".join([t for _, t, prose in found if prose] or [t for _, t, _ in found]))
                for path, lines in texts.items():
                    rows.append((h, path, prose_key, None, None, sorted({_hash(f"{path}\n{t}") for t in lines})))
            if rows:
                cols = list(zip(*rows))
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, t, c in zip(("host", "path", "page", "shape", "content", "lines"), kinds, cols)})
    return pages.select("host", "html").mapInArrow(run, "host string, path string, page long, shape long, content long, lines array<long>")


def counts(nodes: DataFrame) -> DataFrame:
    """``host, path, kind, feature, c``: pages that show a child sequence (0),
    text (1) or block (2, from two pages on) at a node, or any block (3)."""
    once = nodes.groupBy("host", "path", "page").agg(*(F.first(c).alias(c) for c in ("shape", "content", "lines")))

    def feature(kind, value):
        return F.struct(F.lit(kind).alias("kind"), value.alias("feature"))
    lines = F.concat(F.array(feature(3, F.lit(0).cast("long"))), F.transform("lines", lambda x: feature(2, x)))
    each = F.when(F.col("lines").isNull(), F.array(feature(0, F.col("shape")), feature(1, F.col("content")))).otherwise(lines)
    return once.select("host", "path", F.explode(each).alias("f")).select("host", "path", "f.*").filter("feature is not null") \
        .groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("c")).filter("kind <> 2 or c > 1")


def shared_lines(each: DataFrame, line_pages: int = LINE_PAGES, threshold: float = LINE_THRESHOLD) -> DataFrame:
    """``host, line`` of the blocks whose importance is below the threshold."""
    pages = each.filter((F.col("kind") == 3) & (F.col("c") >= line_pages)).select("host", "path", F.col("c").alias("m"))
    return each.filter("kind = 2").join(pages, ["host", "path"]).filter(1 - F.log2("c") / F.log2("m") < threshold) \
        .select("host", F.col("feature").alias("line"))


def importance(each: DataFrame, min_pages: int = MIN_PAGES, decay: float = DECAY) -> DataFrame:
    """``host, path, importance`` of the nodes, from their :func:`counts` (or
    from :func:`style_nodes`), that at least ``min_pages`` distinct pages of
    the host show; nodes on fewer pages have importance 1."""
    each = counts(each) if "page" in each.columns else each
    entropy = each.filter("kind < 2").groupBy("host", "path", "kind") \
        .agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.log2("c")).alias("s"), F.count("*").alias("kinds"))
    # relative entropy over the pages that show it; texts on few pages can't be judged
    own = F.when(F.col("m") < min_pages, 1.0).otherwise((F.log2("m") - F.col("s") / F.col("m")) / F.log2("m"))
    by_node = entropy.groupBy("host", "path").agg(F.max(own).alias("own"))
    # a node is worth its best descendant: each node tells its ancestors
    up = F.split("path", "/")
    tell = F.transform(F.sequence(F.lit(2), F.size("up")), lambda i: F.struct(
        F.array_join(F.slice("up", 1, i), "/").alias("path"),
        (F.col("own") * F.pow(F.lit(decay), F.col("depth") - i)).alias("worth")))
    return by_node.select("host", "own", up.alias("up")).withColumn("depth", F.size("up")) \
        .select("host", F.explode(tell).alias("t")).groupBy("host", F.col("t.path").alias("path")) \
        .agg(F.max("t.worth").alias("importance"))


def extract(pages: DataFrame, threshold: float = THRESHOLD, min_pages: int = MIN_PAGES, line_threshold: float = LINE_THRESHOLD,
            line_pages: int = LINE_PAGES, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per page: ``page_id, url, text``."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"),
                        F.col(html_col).alias("html"))
    each = pages.sparkSession.read.parquet(write_shared(counts(style_nodes(rows)), "style-counts"))
    low = importance(each, min_pages).filter(F.col("importance") < threshold).select("host", "path", F.lit(None).cast("long").alias("line"))
    low = low.unionByName(shared_lines(each, line_pages, line_threshold).select("host", F.lit(None).cast("string").alias("path"), "line"))
    removed = cut_lineage(low.groupBy("host").agg(F.collect_set("path").alias("removed"), F.collect_set("line").alias("shared")))
    size = removed.agg(F.sum(F.length("host") + F.length(F.array_join("removed", ",")) + 8 * F.size("shared")), F.count("*")).first()
    if (size[0] or 0) + 64 * size[1] <= broadcast_bytes:
        joined = rows.join(F.broadcast(removed), "host", "left")
    else:                                    # beyond the bound, pages of a host spread over several tasks
        salted = removed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS)).cast("int")
        joined = rows.withColumn("salt", salt).join(salted, ["host", "salt"], "left").drop("salt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "html", 2 << 20):
            low = zip(b.column("html").to_pylist(), b.column("removed").to_pylist(), b.column("shared").to_pylist())
            texts = [text_of(p, set(r or ()), set(s or ())) for p, r, s in low]
            yield pa.RecordBatch.from_pydict({"page_id": b.column("page_id"), "url": b.column("url"), "text": pa.array(texts, pa.string())})

    return joined.select("page_id", "url", "html", "removed", "shared").mapInArrow(run, "page_id long, url string, text string")
