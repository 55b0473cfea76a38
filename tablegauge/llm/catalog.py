"""Named queries of the operators: thin, each derives its digest columns
from the operator's own result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.llm import (collocations, collocations_sql, decontaminate, html, licenses, licenses_sql, neighbours, neighbours_sql,
                            packing, pii, quality, records, rules, simhash, substrings, variants)
from tablegauge.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public vocabulary lies (the default tokenizer of the queries)."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op6_token_records")
def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token records, in ascending doc_id order, read back from the files."""
    return records.token_records(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: 3-word shingles, 2 bits."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents under a 35-word window that occurs twice, removed."""
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item with up to 10 % edits, and where."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by attention over passages, learned
    from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    train = quality.labelled(docs, table(spark, sf_dir, "labels").filter(~held_out), "quality")
    scored = quality.score(docs, quality.fit(train))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    out = html.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: pattern spans and disclosing terms."""
    out = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [pii.count_kind(F.col("base"), name).alias(f"n_{name}") for name in pii.KINDS]
    return out.select("doc_id", *counts, F.sha2(pii.span_list(F.col("base")), 256).alias("base_sha256"),
                      pii.span_list(F.col("base"), F.col("terms")).alias("spans"))


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdicts of all documents; cutoffs certified by language."""
    out = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op3_license_scan", licenses_sql.SQL)
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, laid out as the files of a repository for
    each source: a directory for a language, below it one for each hundred
    ids; every 25th document is its directory's licence file, and every
    1000th its language's."""
    files = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("repo"), "text", F.expr(
        "concat_ws('/', lang, CASE WHEN doc_id % 1000 = 0 THEN 'LICENSE' WHEN doc_id % 25 = 0 THEN concat('d', doc_id div 100, '/LICENSE') "
        "ELSE concat('d', doc_id div 100, '/', doc_id, '.txt') END)").alias("path"))
    out = licenses.scan(files, licenses.templates(spark), id_col="doc_id", forms=licenses.form_templates(spark))
    return out.select(F.col("file_id").alias("doc_id"), "path", "license", "origin", F.round("cosine", 6).alias("cosine"), "from_dir")


@query("op11_neighbours", neighbours_sql.SQL)
def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every 20th embedding, by largest inner product."""
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows.filter(F.col("vec_id") % 20 == 0), rows, k=20)


@query("op12_collocations", collocations_sql.SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language, over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"), keep=2000)


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents with its more frequent form and root."""
    return variants.variants(table(spark, sf_dir, "documents"))
