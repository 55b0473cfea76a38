"""License scans: sparse TF-IDF cosine to templates and inheritance along
directories, in SQL functions only.

A file's units are its lines with a licence word, anywhere in the text, and
for licence files (LICENSE, COPYING, ...) the whole text.  Units and
templates are sparse vectors of words weighted by TF-IDF, with document
frequencies over the templates.  Vectors meet in an equi-join on the word,
pre-summed for each unit and template, and the best template with a cosine
of at least ``THRESHOLD`` is the file's own licence.

With ``forms`` (titles, SPDX identifiers, standard headers and full texts, see
``license_forms``) files are also held against those: by line, by blocks of
adjacent lines (up to a blank line, or one without words) that have a licence
word, and licence files as a whole.  There a word's count is damped to
``1 + ln(count)``, so that long texts don't meet in their common words.  A
file that is a full text, or else has one as a block, has that licence; the
notices above come next, and other forms last.

A file without one inherits from the nearest ancestor directory, its own
first, that has a licence file with a licence.  Ancestors are joined for
each directory, not each file, so a repository with a third of all files
costs a row for each of its directories and levels.

The templates' words are broadcast while there are at most
``BROADCAST_ROWS`` of them and joined by shuffle beyond.

Edge cases: null and blank texts have no unit; null repositories and paths
are taken as empty ones, so such files share the root; ties go to the
smallest licence name; several licence files in a directory: the best
cosine, then the smallest name; repeated rows each get a row; empty tables
give no rows, or no licences; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.llm import license_forms
from tablegauge.llm.common import cut_lineage

THRESHOLD = 0.75
BROADCAST_ROWS = 500_000
TRIGGER = r"(?i)licen[cs]e|copyright|spdx|copying permission|all rights reserved|public domain"
#: Of lines and blocks that are held against the forms.
FORM_TRIGGER = TRIGGER + r"|permission is hereby granted|redistribution and use|neither the name of|gnu|gpl|mozilla|creative commons|cc0"
_BLOCKS = [r"\n[\x20\t\r]*(?=\n)", r"\n[^\p{L}\p{N}\n]*(?=\n)"]
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"

#: Names and notices of common licences (fixed values).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Redistribution and use under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Redistribution and use under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released to the public domain under CC0 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "Copyright. All rights reserved."),
]


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, text string")


def form_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(license_forms.forms(), "license string, kind string, text string")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _weights(units: DataFrame, keys: list[str], idf: DataFrame | None, unseen: Column, damped: bool = False) -> DataFrame:
    """``keys, word, weight`` with the vector's ``norm`` (not normalised)."""
    tf = units.select(*keys, F.explode(_words(F.col("text"))).alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("tf"))
    tf = tf.withColumn("tf", 1 + F.log("tf")) if damped else tf
    return tf.join(idf, "word", "left").withColumn("weight", F.col("tf") * F.coalesce("idf", unseen))


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _scored(units: DataFrame, known: DataFrame, threshold: float, broadcast_rows: int, damped: bool = False) -> DataFrame:
    """``key, unit, license, cosine`` of the units (``key, unit, text``) and
    templates (``license, text``) that meet the threshold."""
    n = known.count()
    unseen = F.log(F.lit(1.0 + n)) + 1
    known = known.select("license", F.coalesce("text", F.lit("")).alias("text"))
    idf = known.select("license", F.explode(F.array_distinct(_words(F.col("text")))).alias("word")).groupBy("word") \
        .agg((F.log(F.lit(1.0 + n) / (1 + F.countDistinct("license"))) + 1).alias("idf"))
    vectors = cut_lineage(_weights(known, ["license"], idf, unseen, damped))
    norms = vectors.groupBy("license").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("t_norm"))
    vectors = cut_lineage(vectors.join(norms, "license").select("license", "word", (F.col("weight") / F.col("t_norm")).alias("t")))
    weights = _weights(units, ["key", "unit"], _maybe_broadcast(idf, broadcast_rows), unseen, damped)
    meet = weights.join(_maybe_broadcast(vectors, broadcast_rows), "word", "left")
    # one pass gives the unit's norm (a word joins each template once) and the products
    square = weights.groupBy("key", "unit").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    dots = meet.filter("license is not null").groupBy("key", "unit", "license").agg(F.sum(F.col("weight") * F.col("t")).alias("dot"))
    return dots.join(square, ["key", "unit"]).select("key", "unit", "license", F.round(F.col("dot") / F.col("norm"), 9).alias("cosine")) \
        .filter(F.col("cosine") >= threshold)


def own_licenses(files: DataFrame, known: DataFrame, threshold: float = THRESHOLD, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``key, license, cosine`` of the files (``key, name, text``) with a licence of their own."""
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = F.when(F.col("name").rlike(LICENSE_FILE), F.array(text)).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(TRIGGER))
    units = files.select("key", F.posexplode(F.array_distinct(F.concat(whole, lines))).alias("unit", "text"))
    scored = _scored(units, known, threshold, broadcast_rows)
    best = scored.groupBy("key").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b"))
    return best.select("key", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def form_licenses(files: DataFrame, forms: DataFrame, threshold: float = THRESHOLD, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``key, license, cosine, full`` of the files (``key, name, text``) that hold
    a form (``license, kind, text``); ``full``: a full text, as a file or a block."""
    text = F.coalesce(F.col("text"), F.lit(""))
    held = F.col("name").rlike(LICENSE_FILE)
    parts = F.array_distinct(F.concat(F.split(text, "\n"), *(F.split(text, b) for b in _BLOCKS)))
    parts = F.filter(parts, lambda x: x.rlike(FORM_TRIGGER))
    # unit 0 is the whole text of a licence file
    units = files.select("key", F.posexplode(F.concat(F.array(F.when(held, text)), parts)).alias("unit", "text")).filter("text is not null")
    named = cut_lineage(forms.select("license", "kind", "text").distinct().withColumn("form", F.sha2(F.concat_ws("\x00", "license", "kind", "text"), 256)))
    scored = _scored(units, named.select(F.col("form").alias("license"), "text"), threshold, broadcast_rows, damped=True) \
        .withColumnRenamed("license", "form").join(F.broadcast(named.select("form", "license", "kind")), "form")
    part = F.when(F.col("kind") != "text", 2).when(F.col("unit") == 0, 0).otherwise(1)
    best = scored.groupBy("key").agg(F.min(F.struct(part.alias("part"), (-F.col("cosine")).alias("c"), "license")).alias("b"))
    return best.select("key", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"), (F.col("b.part") < 2).alias("full"))


def scan(files: DataFrame, known: DataFrame, threshold: float = THRESHOLD, id_col: str = "file_id", repo_col: str = "repo",
         path_col: str = "path", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS, forms: DataFrame | None = None) -> DataFrame:
    """One row per file: ``file_id, repo, path``, its ``license`` (null: none),
    ``origin`` (``own``, ``inherited`` or ``none``), ``cosine`` and, if inherited, ``from_dir``."""
    path = F.regexp_replace(F.coalesce(F.col(path_col), F.lit("")), "^/+", "")
    rows = files.select(F.col(id_col).alias("file_id"), F.coalesce(F.col(repo_col), F.lit("")).alias("repo"), path.alias("path"),
                        F.col(text_col).alias("text"))
    name = F.regexp_extract("path", "([^/]*)$", 1)
    rows = rows.withColumn("name", name).withColumn("dir", F.regexp_replace("path", "/?[^/]*$", "")) \
        .withColumn("key", F.struct(F.coalesce(F.col("file_id").cast("string"), F.lit("")).alias("id"), F.col("file_id").isNull().alias("null"),
                                    "repo", "path", F.xxhash64("text").alias("hash")))
    # texts without a licence word and no licence file have no unit
    maybe = rows.filter(F.col("text").rlike(TRIGGER if forms is None else FORM_TRIGGER) | F.col("name").rlike(LICENSE_FILE)) \
        .select("key", "name", "text", "repo", "dir").dropDuplicates(["key"])
    own = own_licenses(maybe, known, threshold, broadcast_rows)
    if forms is not None:
        more = form_licenses(maybe, forms, threshold, broadcast_rows).select("key", F.struct("license", "cosine").alias("more"), "full")
        first = F.when(F.col("full"), F.col("more")).when(F.col("license").isNotNull(), F.struct("license", "cosine")).otherwise(F.col("more"))
        own = own.join(more, "key", "full").select("key", first.alias("b")).select("key", "b.license", "b.cosine")
    own = cut_lineage(own)
    held = maybe.filter(F.col("name").rlike(LICENSE_FILE)).select("key", "repo", "dir").join(own, "key") \
        .groupBy("repo", "dir").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("held"))
    dirs = rows.select("repo", "dir").distinct()
    up = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    ancestors = dirs.withColumn("up", up).select("repo", "dir", F.explode(F.sequence(F.lit(0), F.size("up"))).alias("level"), "up") \
        .select("repo", "dir", "level", F.array_join(F.slice("up", F.lit(1), F.col("level")), "/").alias("at"))
    nearest = ancestors.join(held.select("repo", F.col("dir").alias("at"), "held"), ["repo", "at"]) \
        .groupBy("repo", "dir").agg(F.max(F.struct("level", "at", "held")).alias("near")) \
        .select("repo", "dir", F.col("near.at").alias("from_dir"), F.col("near.held.license").alias("dir_license"))
    slim = rows.drop("text", "name")
    out = slim.join(own, "key", "left").join(nearest, ["repo", "dir"], "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("dir_license").isNotNull(), "inherited").otherwise("none")
    return out.select("file_id", "repo", "path", F.coalesce("license", "dir_license").alias("license"), origin.alias("origin"), "cosine",
                      F.when(origin == "inherited", F.col("from_dir")).alias("from_dir"))
