"""Table audit (A1–A12): shape, column types, missing values, duplicate
rows, distinct values, candidate targets, class balance, constraints and a
combined long-format report.

Per-column facts (missing and distinct counts) come from ONE aggregate over
the table; duplicates and class balance are one grouped aggregate each
(partial aggregation map-side, so a hot key collapses before the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.errors import ValidationError, refuse
from tablegauge.functions.columns import fresh, is_fractional, is_integral, is_numeric, missing, present
from tablegauge.functions.prefix import in_order
from tablegauge.sources.files import source_order

# Fixed values of the audit's constraint checks.
MIN_ROWS = 1000
MIN_FEATURES = 8
CANDIDATE_MIN_EXCLUSIVE = 1
CANDIDATE_MAX_INCLUSIVE = 20


def _long(pairs: list[tuple[str, Column]], name_col: str, value_col: str) -> Column:
    """inline(array(struct(name, value), ...)) — wide one-row to long rows."""
    return F.inline(F.array(*[
        F.struct(F.lit(n).alias(name_col), v.alias(value_col)) for n, v in pairs
    ]))


def audit_shape(df: DataFrame) -> DataFrame:
    """A1: one row ``(row_count, column_count)``."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).cast("long").alias("column_count"))


def audit_columns(df: DataFrame) -> DataFrame:
    """A2/A3: ``(position, column_name, data_type, is_numeric)`` from the
    schema alone (no job).  ``is_numeric`` follows the audit rule: numbers
    only, booleans are not numeric."""
    rows = [(i, f.name, f.dataType.simpleString(), is_numeric(f.dataType))
            for i, f in enumerate(df.schema.fields)]
    schema = "position long, column_name string, data_type string, is_numeric boolean"
    return df.sparkSession.createDataFrame(rows, schema)


def _profile_wide(df: DataFrame, *, approx_distinct: bool = False, rsd: float = 0.01) -> DataFrame:
    """One aggregate: ``__rows``, then ``m<i>`` (missing) and ``d<i>``
    (distinct, NULL counted) for column ``i``."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, f in enumerate(df.schema.fields):
        aggs.append(F.sum(missing(f.name, f.dataType).cast("long")).alias(f"m{i}"))
        x = present(f.name, f.dataType)
        nd = F.approx_count_distinct(x, rsd) if approx_distinct else F.count_distinct(x)
        aggs.append((nd + F.max(x.isNull().cast("long"))).alias(f"d{i}"))
    return df.agg(*aggs)


def column_profile(df: DataFrame, *, approx_distinct: bool = False, rsd: float = 0.01) -> DataFrame:
    """One aggregate over the table giving, per column,
    ``(position, column_name, missing_count, distinct_count)``.

    ``distinct_count`` counts NULL as one value.  With ``approx_distinct``
    the HyperLogLog++ estimate replaces the exact count (no Expand of the
    table per column; for very wide, very large tables)."""
    wide = _profile_wide(df, approx_distinct=approx_distinct, rsd=rsd)
    items = F.array(*[
        F.struct(F.lit(i).cast("long").alias("position"), F.lit(f.name).alias("column_name"),
                 F.coalesce(F.col(f"m{i}"), F.lit(0)).cast("long").alias("missing_count"),
                 F.coalesce(F.col(f"d{i}"), F.lit(0)).cast("long").alias("distinct_count"))
        for i, f in enumerate(df.schema.fields)])
    return wide.select(F.inline(items))


def audit_missing(df: DataFrame) -> DataFrame:
    """A4: ``(column_name, missing_count)``, NULL or NaN counted."""
    aggs = [F.sum(missing(f.name, f.dataType).cast("long")).alias(f.name) for f in df.schema.fields]
    wide = df.agg(*aggs)
    return wide.select(_long([(c, F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long")) for c in df.columns],
                             "column_name", "missing_count"))


def duplicate_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each distinct row (NULLs equal each other, as
    do NaNs and the two zeros): one row ``(duplicate_row_count)``.

    Rows are counted by a 128-bit fingerprint (two 64-bit hashes with
    different seeds), so a row costs the shuffle 24 bytes whatever it holds;
    rows whose fingerprint occurs once are unique for certain, and only the
    others are grouped by all their columns."""
    keys = cols or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    one, two, n = fresh(df, "print_one", "print_two", "rows_alike")
    # NaN and -0.0 as grouping sees them
    alike = [F.when(F.col(f"`{c}`") == 0, F.lit(0.0).cast(types[c])).otherwise(F.col(f"`{c}`")) if is_fractional(types[c]) else F.col(f"`{c}`")
             for c in keys]
    # a NULL leaves a hash as it is, so where the NULLs are is part of the print
    holes = F.concat(*[F.when(F.col(f"`{c}`").isNull(), F.lit("1")).otherwise(F.lit("0")) for c in keys])
    prints = df.select("*", F.xxhash64(*alike, holes).alias(one), F.xxhash64(F.lit(7919), holes, *reversed(alike)).alias(two))
    twice = prints.groupBy(one, two).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).select(one, two)
    repeated = prints.join(twice, [one, two], "left_semi")
    grouped = repeated.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count(F.lit(1)).alias(n))
    return grouped.agg(F.coalesce(F.sum(F.col(n) - 1), F.lit(0)).cast("long").alias("duplicate_row_count"))


def audit_duplicates(df: DataFrame) -> DataFrame:
    """A5."""
    return duplicate_rows(df)


def audit_distinct(df: DataFrame, *, approx: bool = False) -> DataFrame:
    """``(column_name, distinct_count)`` with NULL counted as a value."""
    return column_profile(df, approx_distinct=approx).select("column_name", "distinct_count")


#: Values up to which :func:`bounded_distinct` is exact (2 to this power).
_EXACT_BITS = 12


def bounded_distinct(name: str, dt: T.DataType) -> Column:
    """Distinct values of a column (NULL counted) as an aggregate of constant
    size: a theta sketch, which keeps the smallest 64-bit value hashes.  Up
    to 4,096 values it holds them all and the count is exact; beyond, it is
    an estimate that is never near the small numbers asked for.  One pass,
    no copy of the rows for each column."""
    x = present(name, dt)
    if is_integral(dt):
        x = x.cast("long")
    elif is_fractional(dt):
        x = x.cast("double")
    else:
        x = F.concat(F.lit("="), x.cast("string"))      # the sketch passes over empty strings
    return F.round(F.theta_sketch_estimate(F.theta_sketch_agg(x, _EXACT_BITS))).cast("long") + F.max(x.isNull().cast("long"))


def audit_candidates(df: DataFrame, *, lo: int = CANDIDATE_MIN_EXCLUSIVE,
                     hi: int = CANDIDATE_MAX_INCLUSIVE) -> DataFrame:
    """Columns with ``lo < distinct_count <= hi`` (candidate targets),
    from one pass of bounded counts."""
    refuse(ValidationError, hi=(hi > 1 << (_EXACT_BITS - 1), f"{hi} is beyond the counts that are exact here"))
    wide = df.agg(*[bounded_distinct(f.name, f.dataType).alias(f"d{i}") for i, f in enumerate(df.schema.fields)])
    d = wide.select(_long([(f.name, F.coalesce(F.col(f"d{i}"), F.lit(0)).cast("long")) for i, f in enumerate(df.schema.fields)],
                          "column_name", "distinct_count"))
    return d.where((F.col("distinct_count") > lo) & (F.col("distinct_count") <= hi))


def audit_class_balance(df: DataFrame, target: str, total: int | None = None) -> DataFrame:
    """``(class_value, class_count, class_proportion)``; the NULL
    class is kept.  The total is a known row count or a scalar subquery over
    the class table."""
    counts = df.groupBy(F.col(f"`{target}`").cast("string").alias("class_value")).agg(
        F.count(F.lit(1)).alias("class_count"))
    total = F.lit(int(total)).cast("long") if total is not None else \
        counts.select(F.sum("class_count")).scalar()
    return counts.withColumn("class_proportion", F.col("class_count") / total)


def audit_target_values(df: DataFrame, target: str, order: Sequence[Column | str] | None = None) -> DataFrame:
    """A10: ``(position, target_value, data_type)``: the distinct target
    values (NULL included) in the order in which they are first seen.  The
    order of rows is ``order``; by default that of the files that ``df`` is
    scanned from.  Each value's least place is a partial aggregate; only the
    distinct values are sorted."""
    places = source_order() if order is None else [F.col(f"`{c}`") if isinstance(c, str) else c for c in order]
    seen = df.select(F.col(f"`{target}`").alias("target_value"), F.struct(*[p.alias(f"p{i}") for i, p in enumerate(places)]).alias("place"))
    least = seen.groupBy("target_value").agg(F.min("place").alias("place"))
    return in_order(least, ["place"]).select("position", "target_value", F.lit(df.schema[target].dataType.simpleString()).alias("data_type"))


def audit_constraints(df: DataFrame, target: str | None = None, *, min_rows: int = MIN_ROWS,
                      min_features: int = MIN_FEATURES) -> DataFrame:
    """``(constraint_name, required, actual, passed)``.  The feature
    count is ``columns - 1`` whether or not a target is named (the audit
    assumes exactly one target column)."""
    num = sum(1 for f in df.schema.fields if is_numeric(f.dataType))
    non = len(df.columns) - num
    feats = len(df.columns) - 1
    total_missing = F.coalesce(F.sum(F.lit(0).cast("long")), F.lit(0))
    miss_terms = [missing(f.name, f.dataType).cast("long") for f in df.schema.fields]
    if miss_terms:
        total_missing = F.coalesce(F.sum(sum(miss_terms[1:], miss_terms[0])), F.lit(0))
    wide = df.agg(F.count(F.lit(1)).alias("rows"), total_missing.alias("miss"))
    def item(name, required, actual, passed):
        return F.struct(F.lit(name).alias("constraint_name"), F.lit(required).alias("required"),
                        actual.cast("string").alias("actual"), passed.alias("passed"))
    rows = F.array(
        item("minimum_rows", str(min_rows), F.col("rows"), F.col("rows") >= min_rows),
        item("minimum_feature_columns", str(min_features), F.lit(str(feats)), F.lit(feats >= min_features)),
        item("has_numeric_columns", "true", F.lit(str(num > 0).lower()), F.lit(num > 0)),
        item("has_non_numeric_columns", "true", F.lit(str(non > 0).lower()), F.lit(non > 0)),
        item("missing_values_present", "> 0", F.col("miss"), F.col("miss") > 0),
    )
    return wide.select(F.inline(rows))


def audit_report(df: DataFrame, target: str | None = None, *, approx_distinct: bool = False) -> DataFrame:
    """The whole audit as one long table
    ``(section, column_name, metric, value)`` with text values.

    Three passes over the table: the column profile (one aggregate: row
    count, missing and distinct counts of every column — one row, brought
    to the driver), the duplicate count (one grouped aggregate, one value)
    and the class counts (one grouped aggregate, kept distributed)."""
    spark = df.sparkSession
    fields = df.schema.fields
    # one row: 1 + 2 values per column; approx_distinct uses HyperLogLog++
    # instead of an exact distinct count per column (no per-column Expand)
    wide = _profile_wide(df, approx_distinct=approx_distinct).first()
    n_rows = int(wide["__rows"])
    prof = {f.name: {"missing_count": wide[f"m{i}"] or 0, "distinct_count": wide[f"d{i}"] or 0}
            for i, f in enumerate(fields)}
    dup = duplicate_rows(df).first()[0]
    n_cols = len(fields)
    num = sum(1 for f in fields if is_numeric(f.dataType))
    non = n_cols - num
    feats = n_cols - 1
    miss_total = sum(int(r["missing_count"]) for r in prof.values())
    rows = [("shape", None, "row_count", str(n_rows)),
            ("shape", None, "column_count", str(n_cols)),
            ("shape", None, "duplicate_row_count", str(dup))]
    for f in fields:
        r = prof[f.name]
        d = int(r["distinct_count"])
        rows += [("columns", f.name, "data_type", f.dataType.simpleString()),
                 ("columns", f.name, "is_numeric", str(is_numeric(f.dataType)).lower()),
                 ("columns", f.name, "missing_count", str(int(r["missing_count"]))),
                 ("columns", f.name, "distinct_count", str(d)),
                 ("columns", f.name, "candidate_target",
                  str(CANDIDATE_MIN_EXCLUSIVE < d <= CANDIDATE_MAX_INCLUSIVE).lower())]
    for name, required, actual, passed in (
            ("minimum_rows", str(MIN_ROWS), str(n_rows), n_rows >= MIN_ROWS),
            ("minimum_feature_columns", str(MIN_FEATURES), str(feats), feats >= MIN_FEATURES),
            ("has_numeric_columns", "true", str(num > 0).lower(), num > 0),
            ("has_non_numeric_columns", "true", str(non > 0).lower(), non > 0),
            ("missing_values_present", "> 0", str(miss_total), miss_total > 0)):
        rows += [("constraints", name, "required", required), ("constraints", name, "actual", actual),
                 ("constraints", name, "passed", str(passed).lower())]
    if target and target not in df.columns:
        rows.append(("target", target, "target_exists", "false"))
    out = spark.createDataFrame(rows, "section string, column_name string, metric string, value string")
    if target and target in df.columns:
        bal = audit_class_balance(df, target, total=n_rows).select(
            F.lit("target").alias("section"), F.coalesce(F.col("class_value"), F.lit("<null>")).alias("column_name"),
            _long([("class_count", F.col("class_count").cast("string")),
                   ("class_proportion", F.format_string("%.6f", F.col("class_proportion")))], "metric", "value"))
        out = out.unionByName(bal)
    return out
