"""The training-data pipeline: five operators over ``documents``, each
stage's result written as Parquet and read again as the next one's input.

Every stage works on all rows that its predecessor kept; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.llm import decontaminate, packing, pii, quality, simhash
from tablegauge.llm.catalog import tokenizer_path
from tablegauge.llm.common import fresh, table, write_shared


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (2): documents that score under 0.3 go.  It learns
    from the labels of this stage's input, without the held-out fifth."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    train = quality.labelled(docs, table(spark, sf_dir, "labels").filter(~held_out), "quality")
    return quality.keep(docs, quality.fit(train), threshold=0.3)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (4): of each group linked at 2 bits of 3-word
    shingles, the document with the smallest id stays.  Where ids are null
    or repeated, rows are numbered first and one row of each group stays."""
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("c")).filter("c > 1 or doc_id is null")
    row, chosen = fresh(docs, "row", "chosen")
    if odd.isEmpty():
        groups = simhash.near_duplicates(docs, shingle=3, max_bits=2)
        first = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(chosen))
        return docs.join(first, F.col("doc_id") == F.col(chosen), "left_semi")
    numbered = spark.read.parquet(write_shared(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"))
    groups = simhash.near_duplicates(numbered, shingle=3, max_bits=2, id_col=row).select(F.col("doc_id").alias("at"), "component_id")
    names = numbered.select("doc_id", F.col(row).alias("at"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "at")
    first = names.join(groups, "at").groupBy("component_id").agg(F.min_by("at", order).alias(chosen))
    return numbered.join(first, F.col(row) == F.col(chosen), "left_semi").drop(row)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (10): documents that hold an item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII (8): personal data and disclosing terms are replaced in the text."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (9): every token id lies in one sequence of up to 2,048."""
    return packing.pack(docs, tokenizer_path(), end_id=1)


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: The first stage learns a model, which SQL can't express; a test holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spark.read.parquet(write_shared(stage(spark, docs, sf_dir), name))
    return STAGES[-1][1](spark, docs, sf_dir)
