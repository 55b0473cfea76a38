"""Quality rules with risk-controlled thresholds, in SQL functions only.

Counts of each text give a few rule metrics (higher is worse).  A cutoff is
chosen for every rule in every stratum such that the share of good documents
that the rules reject together is at most ``risk``, at confidence
``1 - delta`` for all strata and rules at once:

* labelled good documents are the holdout; cutoffs come from a fixed grid;
* a cutoff that rejects ``x`` of ``n`` good documents has the exact binomial
  p-value ``P(Bin(n, risk / rules) <= x)`` against the claim that it rejects
  more than its share of the risk;
* the grid is tested from the most lenient cutoff on and stops at the first
  that fails (fixed-sequence testing needs no correction inside a rule);
  Bonferroni divides ``delta`` among rules and strata.

A rule for which nothing is certified rejects nothing, as in strata with
few labels.  Counts are made once, in a projection without a shuffle, and
written; only counts and labels are joined.  Strata are pre-aggregated.

Edge cases: a null text has no words; a null stratum is a stratum of its own
with the empty one; labels other than 0 and 1 are ignored; repeated rows are
each counted; without words every share is 0; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegauge.llm.common import sql_words, write_shared

RISK = 0.02
DELTA = 0.05
WINDOW = 8

#: Rule metrics and their cutoffs, from lenient to strict; a document fails above the cutoff.
GRID = {
    "symbols_per_word": [3.0, 2.0, 1.0, 0.6, 0.4, 0.25],
    "duplicate_line_share": [0.9, 0.75, 0.6, 0.5, 0.4],
    "repeated_word_share": [0.9, 0.75, 0.6, 0.45, 0.3],
    "upper_share": [0.95, 0.8, 0.65, 0.5, 0.35],
    "exclamations_per_word": [2.0, 1.0, 0.6, 0.4, 0.25],
}
BROADCAST_ROWS = 100_000


def _bind(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, whatever it uses."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _pairs(df: DataFrame, name: str, source: str, step: int) -> DataFrame:
    """Hash of each run from the hashes of its two halves."""
    n = F.greatest(F.size(source) - step, F.lit(0))
    return df.withColumn(name, F.zip_with(F.slice(source, F.lit(1), n), F.slice(source, F.lit(1 + step), n), lambda a, b: F.xxhash64(a, b)))


def _covered(windows: Column, width: int) -> Column:
    """Words under the windows that occur twice, from sorted (hash, place) pairs."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s):
        return F.filter(s, lambda x, k: (F.get(s, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, k + 1)["h"].eqNullSafe(x["h"])))
    places = F.sort_array(F.transform(_bind(placed, twice), lambda x: x["i"]))

    def step(acc, i):
        return F.struct((i + width).alias("end"), (acc["n"] + F.least(F.lit(width), i + width - acc["end"])).alias("n"))
    return F.aggregate(places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step, lambda acc: acc["n"])


def counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and the counts of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # each step is a projection of its own, so that an array is computed once
    df = docs.select(*keep, F.col(text_col).alias("text")).withColumn("words", sql_words(F.col("text")))
    df = df.withColumn("w1", F.transform("words", lambda w: F.xxhash64(w)))
    for half in (1, 2, 4):
        df = _pairs(df, f"w{2 * half}", f"w{half}", half)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("lines", lines)
    # most texts repeat no window, which one hash set tells
    repeats = F.when(F.size(F.array_distinct(f"w{WINDOW}")) < F.size(f"w{WINDOW}"), _covered(F.col(f"w{WINDOW}"), WINDOW)).otherwise(0)
    return df.select(
        *keep, F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), repeats.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclamations"))


def metrics() -> dict[str, Column]:
    """The rule metrics from the counts."""
    def share(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {"symbols_per_word": share("n_symbols", "n_words"), "duplicate_line_share": share("n_dup_lines", "n_lines"),
            "repeated_word_share": share("n_repeat_words", "n_words"), "upper_share": share("n_upper", "word_chars"),
            "exclamations_per_word": share("n_exclamations", "n_words")}


def _log_factorial(n: Column) -> Column:
    """ln n!: a table for small n, Stirling's series beyond."""
    table = F.array(*(F.lit(math.lgamma(i + 1)) for i in range(30)))
    x = n.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5)
    return F.when(n < 30, F.element_at(table, F.least(n, F.lit(29)).cast("int") + 1)).otherwise(series)


def binomial_tail(x: Column, n: Column, p: float) -> Column:
    """``P(Bin(n, p) <= x)``, the sum of its terms from the last one down;
    1 where x is at or over the mean, where nothing is certified anyway."""
    last = F.exp(_log_factorial(n) - _log_factorial(x) - _log_factorial(n - x) + x * math.log(p) + (n - x) * math.log1p(-p))

    def step(acc, k):
        j = (x - k).cast("double")
        term = acc["term"] * (j + 1) * (1 - p) / ((n - j) * p)
        return F.struct((acc["sum"] + term).alias("sum"), term.alias("term"))
    total = F.aggregate(F.when(x > 0, F.sequence(F.lit(1).cast("long"), x)).otherwise(F.array().cast("array<bigint>")),
                        F.struct(last.alias("sum"), last.alias("term")), step, lambda acc: acc["sum"])
    return F.when((n <= 0) | (x >= n * p), 1.0).otherwise(total)


def stratum(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def cutoffs(holdout: DataFrame, grid: dict[str, list[float]] = GRID, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``stratum, rule, cutoff`` of the certified rules, from the counts of
    good documents with their ``stratum``."""
    m = metrics()
    tests = [(r, k, c) for r, cs in grid.items() for k, c in enumerate(cs)]
    hits = holdout.groupBy("stratum").agg(
        F.count("*").alias("n"), *(F.count(F.when(m[r] > c, 1)).alias(f"x{i}") for i, (r, _, c) in enumerate(tests)))
    rows = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(k).alias("k"), F.lit(c).alias("cutoff"), F.col(f"x{i}").alias("x"))
                     for i, (r, k, c) in enumerate(tests)))
    strata = hits.agg(F.count("*").alias("strata"))
    each = hits.select("stratum", "n", F.explode(rows).alias("t")).select("stratum", "n", "t.*")
    level = F.lit(delta / len(grid)) / F.greatest(strata.select("strata").scalar(), F.lit(1))
    failed = each.withColumn("failed", (binomial_tail(F.col("x"), F.col("n"), risk / len(grid)) > level).cast("int"))
    so_far = F.max("failed").over(Window.partitionBy("stratum", "rule").orderBy("k"))
    return failed.withColumn("stopped", so_far).filter("stopped = 0").groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, label_col: str = "quality", stratum_col: str = "lang", id_col: str = "doc_id",
          text_col: str = "text", grid: dict[str, list[float]] = GRID, risk: float = RISK, delta: float = DELTA,
          broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: its id, stratum and counts, ``base_failed``,
    ``failed_rules`` (names) and ``kept``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), stratum(stratum_col).alias("stratum"), F.col(text_col).alias("text"))
    table = spark.read.parquet(write_shared(counts(rows, ["doc_id", "stratum"]), "counts"))
    good = labels.filter(F.col(label_col) == 1).select(F.col(id_col).alias("doc_id")).distinct()
    found = cutoffs(table.join(good, "doc_id"), grid, risk, delta)
    by_stratum = found.groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in grid))
    by_stratum = spark.read.parquet(write_shared(by_stratum, "cutoffs"))
    small = by_stratum.limit(broadcast_rows + 1).count() <= broadcast_rows
    m = metrics()
    failed = F.filter(F.array(*(F.when(m[r] > F.col(f"cut_{r}"), F.lit(r)) for r in grid)), lambda r: r.isNotNull())
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = table.join(F.broadcast(by_stratum) if small else by_stratum, "stratum", "left") \
        .withColumn("base_failed", base).withColumn("failed_rules", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop(*(f"cut_{r}" for r in grid))
