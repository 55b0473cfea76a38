"""PII by patterns and information-theoretic sanitisation, in SQL functions only.

Patterns find protected entities: e-mail addresses, IPv4 addresses, payment
card numbers (Luhn) and phone numbers.  Protected is an entity itself and the
class that it tells: the host of an address, the first two parts of an IP, a
card's issuer digits, a phone's country code.  Terms in the same document may
give them away.  How strongly is estimated over the corpus, in documents:

    PMI(t; e) = log2( p(t, e) / (p(t) p(e)) ),    IC(e) = -log2 p(e)

with p(t, e) the share of documents that hold entity or class e and, outside all
entities and however far from it, term t, and p(t) the share that hold t.
PMI reaches IC(e) when t occurs with e only.  A term whose PMI is at least
``ALPHA * IC(e)`` (and one bit) exceeds the disclosure threshold and is
generalised wherever a document holds it, near that entity or not; everything
protected is replaced by the name of its kind.

A pair needs ``SUPPORT`` witnesses, and copies of one document are one: documents
of an entity are told apart by the least hash of their 3-word shingles, those of a class by
their least entity of that class.  Otherwise any rare word of a text that was
copied three times would go.

Only documents with entities are cut into terms.  A term that more of them
show than any pair with its entities allows is left out before pairs are
built, which drops common words; what is left is exact.  Entities, terms and
pairs are counted by aggregates that combine before the shuffle, so an entity
or word in a third of all documents is a partial count in every task.  Terms
meet documents by a broadcast while their measured number is under
``BROADCAST_ROWS`` and by a shuffled join with a written table beyond.

The quantified groups of the patterns are possessive, which changes no
match and keeps the regular expression engine from recursing or rescanning.

Edge cases: null texts are empty and have no span; repeated rows are
sanitised alike and count as documents; null ids are kept; an empty table
gives no rows; other columns are kept by ``sanitise``, whatever their names,
and by ``find`` unless they are called like its two results.  Offsets count code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import fresh, write_shared

KINDS = ["email", "ip", "card", "phone"]
ALPHA = 0.9
SUPPORT = 3
BROADCAST_ROWS = 200_000
SHINGLE = 3

_USER = r"[A-Za-z0-9._%+-]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: A match begins at the start of a run, or where the match before it ended.
_PATTERN = {
    "email": rf"(?:(?<!{_USER})|\G){_USER}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SPAN = "array<struct<kind:int,start:int,end:int,found:string>>"
_TERM_BREAK = r"[^\p{L}\p{N}]+"
_TERM = r"[\p{L}\p{N}]++"


def _maybe(kind: str, text: Column) -> Column:
    """A cheap test that every text with a match passes."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "ip":
        return text.rlike(r"[0-9]\.[0-9]")
    if kind == "card":
        return text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}")
    return text.rlike(r"\+[0-9]")


def _luhn(digits: Column) -> Column:
    """The checksum of 16 to 19 digits."""
    def add(acc, i):
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return found.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 15)


def _matches(text: Column, kind: str) -> Column:
    """All leftmost matches of one kind with the piece of text before each:
    what the pattern finds, and what it splits."""
    found = F.regexp_extract_all(text, F.lit(_PATTERN[kind]), F.lit(0))
    pieces = F.split(text, _PATTERN[kind], -1)
    return F.zip_with(F.slice(pieces, F.lit(1), F.size(pieces) - 1), found, lambda p, m: F.struct(p.alias("before"), m.alias("found")))


def _spans(text: Column, kind: str) -> Column:
    """The valid spans of a kind, in order of their start."""
    def step(acc, z):
        start = acc["at"] + F.length(z["before"])
        fields = [F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), (start + F.length(z["found"])).alias("end"), z["found"].alias("found")]
        return F.struct((start + F.length(z["found"])).alias("at"), F.concat(acc["out"], F.array(F.struct(*fields))).alias("out"))
    empty = F.array().cast(_SPAN)
    spans = F.aggregate(_matches(text, kind), F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return F.when(_maybe(kind, text), F.filter(spans, lambda s: _valid(kind, s["found"]))).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Pattern spans of a text, by kind and start: ``kind, start, end, found``."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(*(_spans(text, k) for k in KINDS))


def _class(kind: Column, found: Column) -> Column:
    """The class of values that an entity belongs to."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    return F.when(kind == 0, F.substring_index(found, "@", -1)).when(kind == 1, F.substring_index(found, ".", 2)) \
        .when(kind == 2, F.substring(digits, 1, 6)).otherwise(F.regexp_extract(found, r"^\+[0-9]+", 0))


def _signature(text: Column) -> Column:
    """The least hash of the word shingles: mostly the same for near copies."""
    words = F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " ")

    def least(w):
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)), lambda i: F.xxhash64(F.array_join(F.slice(w, i, SHINGLE), " ")))
        return F.when(F.size(w) < SHINGLE, F.xxhash64(F.array_join(w, " "))).otherwise(F.array_min(hashes))
    # as a lambda's argument the words are split once, not once a shingle
    return F.element_at(F.transform(F.array(words), least), 1)


def _terms(text: Column, at: Column, pattern: Column | None = None) -> Column:
    """Every run of letters or digits of a text that begins at an offset, as ``start, term``:
    all, or those that match a pattern."""
    def step(acc, z):
        start = acc["at"] + F.length(z["gap"])
        return F.struct((start + F.length(z["run"])).alias("at"),
                        F.concat(acc["out"], F.array(F.struct(start.alias("start"), z["run"].alias("term")))).alias("out"))
    pattern = F.lit(_TERM) if pattern is None else pattern
    runs, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, -1)
    start = F.struct(at.alias("at"), F.array().cast("array<struct<start:int,term:string>>").alias("out"))
    return F.aggregate(F.zip_with(F.slice(gaps, F.lit(1), F.size(runs)), runs, lambda g, r: F.struct(g.alias("gap"), r.alias("run"))),
                       start, step, lambda acc: acc["out"])


def holders(docs: DataFrame) -> DataFrame:
    """Documents with entities: ``key``, their ``values`` (each entity and each
    class with the mark that tells its witnesses apart) and the distinct
    ``terms`` outside the entities, in lower case."""
    text = F.coalesce(F.col("text"), F.lit(""))
    maybe = _maybe("email", text) | _maybe("ip", text) | _maybe("card", text) | _maybe("phone", text)
    held = docs.filter(maybe).select("key", text.alias("text"))
    # exploded, so that both are computed once a row and not wherever they are named
    once = F.explode(F.array(F.struct(base_spans(F.col("text")).alias("spans"), _signature(F.col("text")).alias("mark"))))
    held = held.select("key", "text", once.alias("x")).select("key", "text", "x.*").filter(F.size("spans") > 0)
    exact = F.transform("spans", lambda s: F.struct(F.concat_ws(":", s["kind"].cast("string"), F.lower(s["found"])).alias("entity"), F.col("mark").alias("mark")))
    wide = F.transform("spans", lambda s: F.struct(F.concat_ws(":", F.lit("class"), s["kind"].cast("string"), _class(s["kind"], F.lower(s["found"]))).alias("entity"),
                                                   F.xxhash64(F.lower(s["found"])).alias("mark")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    rest = F.lower(_replaced(F.col("text"), F.col("spans"), none, blank=True))
    return held.select(
        "key", F.array_distinct(F.concat(exact, wide)).alias("values"),
        F.filter(F.array_distinct(F.split(rest, _TERM_BREAK)), lambda t: t != "").alias("terms")).dropDuplicates(["key"])


def _occurrences(text: Column, terms: Column) -> Column:
    """``start, end`` of every occurrence of the terms (lower case) as whole runs of the text."""
    def spans(t):
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])"), t, F.lit(r"(?![\p{L}\p{N}])"))
        return F.transform(_terms(text, F.lit(0), pattern), lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.length(x["term"])).alias("end")))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(terms, spans))))


def _small(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def disclosing(docs: DataFrame, held: DataFrame, alpha: float = ALPHA, support: int = SUPPORT,
               broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``entity, term, pmi, ic`` of the pairs above the disclosure threshold."""
    read = docs.sparkSession.read.parquet
    total = float(max(docs.count(), 1))
    n = F.lit(total)
    ic = F.log2(n / F.col("n_e"))
    enough = F.greatest(F.lit(1.0), F.lit(alpha) * ic)

    def pmi(n_t):
        return F.log2(F.col("n_te") * n / (n_t * F.col("n_e")))

    def beside(df, small, on, how="inner"):
        return df.join(F.broadcast(small) if _small(small, broadcast_rows) else small, on, how)
    has = held.select("key", F.explode("values").alias("v")).groupBy("key", F.col("v.entity").alias("entity")).agg(F.min("v.mark").alias("mark"))
    # in how many documents a term may be at most, if all of the entity's hold it; rounding is left to the last filter
    entities = has.groupBy("entity").agg(F.count("*").alias("n_e"), F.count_distinct("mark").alias("marks")).filter(F.col("marks") >= support) \
        .select("entity", "n_e", (n / F.pow(F.lit(2.0), enough) + 1).alias("reach"))
    entities = read(write_shared(entities, "entities"))
    furthest = entities.agg(F.max("reach")).first()[0] or 0.0
    cells = held.select("key", F.explode("terms").alias("term"))
    # documents with any entity that show the term: at least so many hold it
    shown = cells.groupBy("term").agg(F.count("*").alias("n_shown")).filter(F.col("n_shown").between(support, F.lit(furthest)))
    shown = read(write_shared(shown, "shown"))
    pairs = beside(cells, shown, "term").join(beside(has, entities, "entity"), "key").filter("n_shown <= reach") \
        .groupBy("entity", "term").agg(F.count("*").alias("n_te"), F.count_distinct("mark").alias("marks"),
                                       F.first("n_e").alias("n_e"), F.first("n_shown").alias("n_shown"))
    pairs = pairs.filter((F.col("marks") >= support) & (pmi(F.col("n_shown")) >= enough)).drop("marks")
    pairs = read(write_shared(pairs, "pairs"))
    wanted = pairs.select("term").distinct()
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(F.col("text")), _TERM_BREAK))).alias("term"))
    if _small(wanted, broadcast_rows):
        counts = words.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_t"))
    else:
        counts = words.groupBy("term").agg(F.count("*").alias("n_t")).join(wanted, "term", "left_semi")
    return pairs.join(counts, "term").select("entity", "term", pmi(F.greatest("n_t", "n_shown")).alias("pmi"), ic.alias("ic"), enough.alias("enough")) \
        .filter("pmi >= enough").drop("enough")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
         support: int = SUPPORT, broadcast_rows: int = BROADCAST_ROWS, base_col: str = "base", terms_col: str = "terms") -> DataFrame:
    """The rows, all columns, with ``base_col`` (pattern spans) and ``terms_col``
    (spans of disclosing terms outside them, ``start, end``); columns of
    these names are replaced."""
    spark = docs.sparkSession
    # rows that share id and text share their spans
    key = F.struct(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(id_col).isNull().alias("no_id"),
                   F.xxhash64(text_col).alias("hash"))
    keyed = docs.select(key.alias("key"), F.col(text_col).alias("text"))
    held = spark.read.parquet(write_shared(holders(keyed), "holders"))
    wanted = spark.read.parquet(write_shared(disclosing(keyed, held, alpha, support, broadcast_rows).select("term").distinct(), "disclosing"))
    # a disclosing term gives its entity away in any document that holds it
    words = keyed.select("key", F.explode(F.array_distinct(F.split(F.lower("text"), _TERM_BREAK))).alias("term"))
    terms = words.join(F.broadcast(wanted) if _small(wanted, broadcast_rows) else wanted, "term", "left_semi") \
        .groupBy("key").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    mine, other, spans = fresh(docs.withColumns({base_col: F.lit(0), terms_col: F.lit(0)}), "key", "terms_key", "found")
    terms = spark.read.parquet(write_shared(terms.select(F.col("key").alias(other), F.col("terms").alias(spans)), "terms"))
    small = _small(terms, broadcast_rows // 10)
    out = docs.withColumns({mine: key, base_col: base_spans(F.col(text_col))})
    out = out.join(F.broadcast(terms) if small else terms, F.col(mine) == F.col(other), "left")
    outside = F.filter(_occurrences(F.col(text_col), F.col(spans)), lambda t: ~F.exists(base_col, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return out.withColumn(terms_col, F.when(F.col(spans).isNull(), none).otherwise(outside)).drop(mine, other, spans)


def span_list(base: Column, terms: Column | None = None) -> Column:
    """``kind:start:end`` of all spans, by kind and start, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = F.transform(base, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    if terms is not None:
        one = F.concat(one, F.transform(terms, lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string"))))
    return F.array_join(one, ",")


def count_kind(base: Column, kind: str) -> Column:
    return F.size(F.filter(base, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def _replaced(text: Column, base: Column, terms: Column, blank: bool = False) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind or a blank."""
    both = F.array_sort(F.concat(F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))),
                                 F.transform(terms, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(len(KINDS)).alias("kind")))))
    names = F.array(*(F.lit(" " if blank else f"[{k.upper()}]") for k in [*KINDS, "term"]))

    def step(acc, s):
        inside = s["start"] < acc["at"]
        more = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(more).alias("out"))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(both, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(both) == 0, text).otherwise(rest)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows, all columns, with everything protected replaced in the text."""
    base, terms = fresh(docs, "base", "terms")
    out = find(docs, id_col, text_col, **settings, base_col=base, terms_col=terms)
    return out.withColumn(text_col, _replaced(F.col(text_col), F.col(base), F.col(terms))).drop(base, terms)
