import pytest
from pyspark.sql import functions as F

from tablegauge.errors import ValidationError
from tablegauge.operators import audit as A
from tablegauge.operators import validate as V


def test_audit_counts(spark, x3):
    df = x3.union(x3.limit(1))
    assert A.audit_shape(df).first().asDict() == {"row_count": 5, "column_count": 9}
    assert A.audit_duplicates(df).first()[0] == 1
    d = {r["column_name"]: r["distinct_count"] for r in A.audit_distinct(df).collect()}
    assert d["maker"] == 3 and d["plant"] == 1
    cand = {r["column_name"] for r in A.audit_candidates(df).collect()}
    assert "plant" not in cand and "maker" in cand


def test_missing_counts_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    m = {r["column_name"]: r["missing_count"] for r in A.audit_missing(df).collect()}
    assert m == {"x": 2, "s": 1}
    d = {r["column_name"]: r["distinct_count"] for r in A.audit_distinct(df).collect()}
    assert d["s"] == 3      # null counted as a value


def test_class_balance_keeps_null_class(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "t string")
    rows = {r["class_value"]: (r["class_count"], r["class_proportion"]) for r in
            A.audit_class_balance(df, "t").collect()}
    assert rows == {"a": (2, 0.5), None: (1, 0.25), "b": (1, 0.25)}


RANGES = {"hours": (10, 500), "load": (0, 20)}


def _x2(spark):
    rows = [(55, "No", 4, 1, 21, "A", 230, "west"), (410, "Broken", 9, 1, 22, "A", 230, "east")]
    return spark.createDataFrame(rows, "hours long, failed string, load long, plant long, unit long, grade string, volt long, site string")


def _validate(df, **kw):
    args = dict(target="failed", required_columns=["failed", "unit"], excluded_columns=["unit", "plant", "grade", "volt"],
                ranges=RANGES, constant_columns=("plant", "grade", "volt"), key_column="unit", min_rows=1, min_features=3)
    args.update(kw)
    return V.validate_dataset(df, **args)


def test_invalid_target_is_first_failure(spark):
    rules = _validate(_x2(spark))
    with pytest.raises(ValidationError, match="target_column"):
        V.enforce(rules)
    assert V.invalid_target_examples(_x2(spark), "failed", ["Yes", "No"]) == ["Broken"]


def test_rules_order_and_pass(spark):
    ok = _x2(spark).withColumn("failed", F.lit("No"))
    rules = _validate(ok)
    V.enforce(rules)  # passes
    dup = ok.withColumn("unit", F.lit(7))
    with pytest.raises(ValidationError, match="key_unique"):
        V.enforce(_validate(dup))
    bad_range = ok.withColumn("hours", F.lit(700))
    with pytest.raises(ValidationError, match="numeric_ranges 'hours'"):
        V.enforce(_validate(bad_range))
    with pytest.raises(ValidationError, match="minimum_rows"):
        V.enforce(_validate(ok, min_rows=1000))


def test_batch_schema(spark, x3):
    rows = V.check_batch_schema(x3.withColumnRenamed("hours", "hours2"), x3.columns).collect()
    assert {r["status"] for r in rows} == {"ok", "missing"}
    with pytest.raises(ValidationError):
        V.enforce_batch_schema(x3.select(*reversed(x3.columns)), x3.columns)


def test_csv_missing_markers(spark, tmp_path):
    from tablegauge.sources.files import read_table
    p = tmp_path / "t.csv"
    p.write_text("a,b\n1,x\nNA,\n3,n/a\n,NULL\n")
    df = read_table(spark, str(p))
    m = {r["column_name"]: r["missing_count"] for r in A.audit_missing(df).collect()}
    assert m == {"a": 2, "b": 3}
    with pytest.raises(ValidationError):
        read_table(spark, str(tmp_path / "absent.csv"))


def test_report_flags_missing_target(spark, x3):
    rows = A.audit_report(x3, "NoSuchTarget").where("metric = 'target_exists'").collect()
    assert [(r["column_name"], r["value"]) for r in rows] == [("NoSuchTarget", "false")]
