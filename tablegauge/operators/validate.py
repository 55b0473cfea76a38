"""Validation rules.

All row-level rules are computed in ONE aggregate pass (plus one grouped
pass for duplicate rows) and returned as rule rows
``(rule_no, rule, column_name, observed, expected, passed)``.
:func:`enforce` raises for the lowest failing ``rule_no``, which preserves
the order in which the rules are meant to be applied.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.errors import EvaluationError, ValidationError
from tablegauge.operators.audit import bounded_distinct, duplicate_rows
from tablegauge.functions.columns import is_numeric, present

# Defaults of the labelled-table rules (target domain, domain
# ranges, expected constant columns, identifier, size limits).
DEFAULT_TARGET_VALUES = ("Yes", "No")
DEFAULT_RANGES = {
    "Age": (18, 60),
    "DistanceFromHome": (1, 29),
    "PercentSalaryHike": (11, 25),
    "TotalWorkingYears": (0, 60),
    "YearsAtCompany": (0, 60),
}
DEFAULT_CONSTANT_COLUMNS = ("EmployeeCount", "Over18", "StandardHours")
DEFAULT_KEY_COLUMN = "EmployeeNumber"
MIN_ROWS = 1000
MIN_FEATURES = 8

RULES = (
    (1, "non_empty"),
    (2, "required_columns"),
    (3, "target_column"),
    (4, "numeric_ranges"),
    (5, "expected_constants"),
    (6, "key_unique"),
    (7, "duplicate_rows"),
    (8, "minimum_rows"),
    (9, "usable_features"),
)
_NO = dict((name, no) for no, name in RULES)

_SCHEMA = ("rule_no long, rule string, column_name string, observed string, "
           "expected string, passed boolean")


def _row(rule: str, column: str | None, observed: Column, expected: str, passed: Column) -> Column:
    return F.struct(F.lit(_NO[rule]).cast("long").alias("rule_no"), F.lit(rule).alias("rule"),
                    F.lit(column).cast("string").alias("column_name"),
                    observed.cast("string").alias("observed"), F.lit(expected).alias("expected"),
                    passed.alias("passed"))


def _fmt(v) -> str:
    return str(int(v)) if float(v).is_integer() else repr(float(v))


def validate_dataset(df: DataFrame, *, target: str, required_columns: Iterable[str] = (),
                     excluded_columns: Iterable[str] = (),
                     allowed_target_values: Sequence[str] = DEFAULT_TARGET_VALUES,
                     ranges: Mapping[str, tuple[float, float]] | None = None,
                     constant_columns: Sequence[str] = (),
                     key_column: str | None = None,
                     max_duplicate_rows: int | None = 0,
                     min_rows: int = MIN_ROWS, min_features: int = MIN_FEATURES) -> DataFrame:
    """Compute every rule as rows; nothing is raised here (see :func:`enforce`).

    Schema-level rules (required columns, range column types, feature count)
    need no job; the rest come from one aggregate of constant size and one
    grouped aggregate each for the key and, when ``max_duplicate_rows`` is
    not None, the duplicates."""
    cols = set(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    ranges = dict(ranges or {})
    allowed = list(allowed_target_values)
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    rows: list[Column] = [_row("non_empty", None, F.col("rows"), ">= 1", F.col("rows") > 0)]

    for c in sorted(set(required_columns)):
        rows.append(_row("required_columns", c, F.lit("present" if c in cols else "missing"),
                         "present", F.lit(c in cols)))

    if target in cols:
        t = F.col(f"`{target}`")
        aggs += [F.sum(t.isNull().cast("long")).alias("t_null"),
                 F.sum((t.isNotNull() & ~t.cast("string").isin(allowed)).cast("long")).alias("t_bad")]
        rows.append(_row("target_column", target, F.concat(
            F.lit("nulls="), F.coalesce(F.col("t_null"), F.lit(0)).cast("string"),
            F.lit(";invalid="), F.coalesce(F.col("t_bad"), F.lit(0)).cast("string")),
            "nulls=0;invalid=0 of " + ",".join(sorted(allowed)),
            (F.coalesce(F.col("t_null"), F.lit(0)) == 0) & (F.coalesce(F.col("t_bad"), F.lit(0)) == 0)))
    else:
        rows.append(_row("target_column", target, F.lit("missing"), "present", F.lit(False)))

    for i, (c, (lo, hi)) in enumerate(ranges.items()):
        expected = f"[{_fmt(lo)}, {_fmt(hi)}]"
        if c not in cols:
            rows.append(_row("numeric_ranges", c, F.lit("missing column"), expected, F.lit(False)))
        elif not is_numeric(types[c]):
            rows.append(_row("numeric_ranges", c, F.lit("not numeric"), expected, F.lit(False)))
        else:
            x = present(c, types[c])        # NaN is missing, not out of range
            aggs.append(F.sum(((x < F.lit(lo)) | (x > F.lit(hi))).cast("long")).alias(f"r{i}"))
            bad = F.coalesce(F.col(f"r{i}"), F.lit(0))
            rows.append(_row("numeric_ranges", c, bad, expected, bad == 0))

    for i, c in enumerate(constant_columns):
        if c not in cols:
            rows.append(_row("expected_constants", c, F.lit("missing column"), "1", F.lit(False)))
        else:
            # least and greatest value decide; the count is told (exact up to 4,096)
            x = present(c, types[c])
            aggs += [bounded_distinct(c, types[c]).alias(f"k{i}"),
                     ((F.count(x) == 0) | ((F.min(x) == F.max(x)) & (F.count(x) == F.count(F.lit(1))))).alias(f"c{i}")]
            rows.append(_row("expected_constants", c, F.col(f"k{i}"), "1", (F.col("rows") > 0) & F.col(f"c{i}")))

    if key_column is not None and key_column not in cols:
        rows.append(_row("key_unique", key_column, F.lit("missing column"), "0", F.lit(False)))

    rows.append(_row("minimum_rows", None, F.col("rows"), f">= {min_rows}", F.col("rows") >= min_rows))
    excluded = set(excluded_columns)
    usable = len([c for c in df.columns if c != target and c not in excluded])
    rows.append(_row("usable_features", None, F.lit(str(usable)), f">= {min_features}",
                     F.lit(usable >= min_features)))

    out = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if key_column in cols:
        keys = key_duplicates(df, key_column).select(F.inline(F.array(_row(
            "key_unique", key_column, F.col("duplicate_count"), "0", F.col("passed")))))
        out = out.unionByName(keys)
    if max_duplicate_rows is not None:
        dup = duplicate_rows(df).select(F.inline(F.array(_row(
            "duplicate_rows", None, F.col("duplicate_row_count"), f"<= {max_duplicate_rows}",
            F.col("duplicate_row_count") <= max_duplicate_rows))))
        out = out.unionByName(dup)
    return out


def key_duplicates(df: DataFrame, key_column: str) -> DataFrame:
    """V6 as a grouped job: ``(key_column, duplicate_count, passed)`` where
    duplicates are rows beyond the first per key value (NULLs equal)."""
    grouped = df.groupBy(F.col(f"`{key_column}`")).agg(F.count(F.lit(1)).alias("n"))
    return grouped.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_count")) \
        .select(F.lit(key_column).alias("key_column"), "duplicate_count",
                (F.col("duplicate_count") == 0).alias("passed"))


def enforce(rule_rows: DataFrame, *, exc=ValidationError, data: DataFrame | None = None, target: str | None = None,
            allowed: Sequence[str] = DEFAULT_TARGET_VALUES) -> None:
    """Raise for the first failing rule (lowest ``rule_no``).  Only the
    failing rule rows — a bounded set — reach the driver.  With ``data``, a
    failing target rule (V3) also says which values offend, the 20 smallest."""
    failing = (rule_rows.where(~F.col("passed"))
               .orderBy("rule_no", F.asc_nulls_first("column_name")).limit(1).collect())
    if failing:
        r = failing[0]
        col = f" '{r['column_name']}'" if r["column_name"] else ""
        values = ""
        if r["rule"] == "target_column" and data is not None and target in data.columns:
            values = f"; not allowed: {invalid_target_examples(data, target, allowed)}"
        raise exc(f"rule {r['rule_no']} {r['rule']}{col} failed: observed {r['observed']}, "
                  f"expected {r['expected']}{values}")


def invalid_target_examples(df: DataFrame, target: str, allowed: Sequence[str], n: int = 20) -> list:
    """The ``n`` smallest invalid target values, for error messages (a
    top-k over the distinct invalid values, never the whole set)."""
    t = F.col(f"`{target}`")
    return [r[0] for r in df.where(t.isNotNull() & ~t.cast("string").isin(list(allowed)))
            .select(t.cast("string").alias("v")).distinct().orderBy("v").limit(n).collect()]


def check_batch_schema(df: DataFrame, expected_columns: Sequence[str], *, target: str | None = None,
                       allowed_target_values: Sequence[str] | None = None) -> DataFrame:
    """Compare a batch's columns with the expected order.  Rows
    ``(position, expected_column, actual_column, status)`` where status is
    ``ok``, ``moved``, ``missing`` or ``extra``.  With ``target`` and
    ``allowed_target_values`` one more row (position NULL) checks the
    target's values (V3) with one aggregate: ``target_ok`` or
    ``target_invalid=<rows>`` (NULL or not allowed)."""
    schema_rows = _batch_schema_rows(df, expected_columns)
    if target is None or allowed_target_values is None:
        return schema_rows
    if target not in df.columns:
        extra = df.sparkSession.createDataFrame(
            [(None, target, None, "target_missing")], schema_rows.schema)
        return schema_rows.unionByName(extra)
    t = F.col(f"`{target}`")
    bad = F.coalesce(F.sum((t.isNull() | ~t.cast("string").isin(list(allowed_target_values))).cast("long")),
                     F.lit(0))
    row = df.agg(bad.alias("bad")).select(
        F.lit(None).cast("long").alias("position"), F.lit(target).alias("expected_column"),
        F.lit(target).alias("actual_column"),
        F.when(F.col("bad") == 0, F.lit("target_ok"))
        .otherwise(F.concat(F.lit("target_invalid="), F.col("bad").cast("string"))).alias("status"))
    return schema_rows.unionByName(row)


def _batch_schema(actual: Sequence[str], exp: Sequence[str]) -> list[tuple]:
    rows = []
    for i in range(max(len(actual), len(exp))):
        e = exp[i] if i < len(exp) else None
        a = actual[i] if i < len(actual) else None
        if e is not None and e == a:
            status = "ok"
        elif e is not None and e not in actual:
            status = "missing"
        elif a is not None and a not in exp:
            status = "extra"
        else:
            status = "moved"
        rows.append((i, e, a, status))
    return rows


def _batch_schema_rows(df: DataFrame, expected_columns: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        _batch_schema(list(df.columns), list(expected_columns)),
        "position long, expected_column string, actual_column string, status string")


def enforce_batch_schema(df: DataFrame, expected_columns: Sequence[str], label: str = "batch") -> None:
    """Raise with every position of V10's comparison that is not ``ok``."""
    wrong = [r for r in _batch_schema(df.columns, expected_columns) if r[3] != "ok"]
    if wrong:
        raise ValidationError(f"{label}: " + ", ".join(f"column {i} is {a or 'absent'}, not {e or 'any'} ({s})" for i, e, a, s in wrong))


def validate_predictions(preds: DataFrame, *, y_true: str = "y_true", y_pred: str = "y_pred",
                         p_pos: str = "p_pos", labels: Sequence[str] = ("No", "Yes")) -> DataFrame:
    """One aggregate over a prediction set; one row
    ``(rows, bad_true, bad_pred, nan_proba, out_of_range_proba, passed)``.
    The three arrays of the single-machine version are columns of one row
    here, so the equal-length rule holds by construction."""
    lab = list(labels)
    p = F.col(p_pos)
    agg = preds.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum((F.col(y_true).isNull() | ~F.col(y_true).isin(lab)).cast("long")).alias("bad_true"),
        F.sum((F.col(y_pred).isNull() | ~F.col(y_pred).isin(lab)).cast("long")).alias("bad_pred"),
        F.sum((p.isNull() | F.isnan(p)).cast("long")).alias("nan_proba"),
        F.sum(((p < 0.0) | (p > 1.0)).cast("long")).alias("out_of_range_proba"))
    z = [F.coalesce(F.col(c), F.lit(0)).alias(c)
         for c in ("bad_true", "bad_pred", "nan_proba", "out_of_range_proba")]
    agg = agg.select("rows", *z)
    return agg.withColumn("passed", (F.col("rows") > 0) & (F.col("bad_true") == 0)
                          & (F.col("bad_pred") == 0) & (F.col("nan_proba") == 0)
                          & (F.col("out_of_range_proba") == 0))


def enforce_predictions(check: DataFrame) -> None:
    """Raise with every count of V11's row that speaks against the set."""
    row = check.first()
    found = {k: v for k, v in row.asDict().items() if k not in ("rows", "passed") and v}
    if not row["passed"]:
        raise EvaluationError(f"{row['rows']} predictions, unusable: {found or 'none at all'}")
