"""Extra columns whose names the operators use themselves change no result."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablegauge.llm import decontaminate, html, licenses, packing, pii, quality, records, rules, simhash, substrings
from tablegauge.llm.common import fresh, table

SF = "/root/testdata/sf0.001"
NAMES = ["id", "key", "row", "chosen", "first", "at", "fp", "a", "b", "base", "terms", "found", "words", "stratum", "label", "score",
         "bag", "n", "s", "seg", "sum", "anchor", "hits", "parts", "count", "c", "host", "removed", "own", "up", "salt", "share", "path",
         "name", "dir", "license", "cosine", "kept", "passages", "component_id", "sequence_id", "item_id", "distance", "unit", "part"]


def crowded(df, names=NAMES):
    return df.select("*", *(F.lit("clash").alias(n) for n in names if n not in df.columns))


def rows(df):
    return sorted(map(repr, df.collect()))


def model(spark):
    return quality.fit(quality.labelled(table(spark, SF, "documents"), table(spark, SF, "labels"), "quality"), epochs=2)


OPERATORS = {
    "html": lambda s, d, _: html.extract(d(table(s, SF, "pages"))),
    "quality": lambda s, d, _: quality.score(d(table(s, SF, "documents")), model(s)),
    "licenses": lambda s, d, _: licenses.scan(
        d(table(s, SF, "documents").selectExpr("doc_id", "source", "concat(lang, '/LICENSE') AS place", "text")),
        d(licenses.templates(s)), id_col="doc_id", repo_col="source", path_col="place"),
    "simhash": lambda s, d, _: simhash.near_duplicates(d(table(s, SF, "documents"))),
    "substrings": lambda s, d, _: substrings.remove_repeats(d(table(s, SF, "documents"))),
    "records": lambda s, d, tok: records.token_records(d(table(s, SF, "documents")), tok, end_id=2),
    "rules": lambda s, d, _: rules.judge(d(table(s, SF, "documents")), d(table(s, SF, "labels"))),
    "packing": lambda s, d, tok: packing.pack(d(table(s, SF, "documents")), tok, end_id=1).groupBy("doc_id").agg(F.sum("length")),
    "decontaminate": lambda s, d, _: decontaminate.matches(d(table(s, SF, "documents")), d(table(s, SF, "benchmark"))),
    "pii": lambda s, d, _: pii.find(d(table(s, SF, "documents"))).select("doc_id", "base", "terms"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(spark, tokenizer, name):
    run = OPERATORS[name]
    want = rows(run(spark, lambda df: df, tokenizer))
    assert want and rows(run(spark, crowded, tokenizer)) == want


@pytest.mark.parametrize("repeat", [False, True])
def test_stages(spark, repeat):
    plain = table(spark, SF, "documents").filter("doc_id < 80")
    if repeat:
        plain = plain.union(plain.filter("doc_id < 3"))
    full = crowded(plain)
    for name, stage in corpus_pipeline.STAGES:
        a, b = stage(spark, plain, SF), stage(spark, full, SF)
        if name == "packing":
            a, b = (df.groupBy("doc_id").agg(F.sum("length")) for df in (a, b))
            assert rows(a) == rows(b)
        else:
            assert b.columns == full.columns
            assert rows(b.select(*plain.columns)) == rows(a) and b.filter("terms <> 'clash' or row <> 'clash'").isEmpty()
            plain, full = (spark.createDataFrame(df.collect(), df.schema) for df in (a, b))


def test_fresh_names(spark):
    df = spark.createDataFrame([], "a int, A_ int, b int")
    assert fresh(df, "a", "b", "c", "c") == ["a__", "b_", "c", "c_"]
