"""Edge cases: empty inputs, zero sizes, booleans, NaN, absent columns."""
import pytest
from pyspark.sql import functions as F

from tablegauge.errors import ValidationError
from tablegauge.operators import drift as D
from tablegauge.operators import prepare as P
from tablegauge.operators import rank as RK
from tablegauge.operators import split as S
from tablegauge.operators import validate as V
from tablegauge.sources.files import read_table


def test_rank_empty_and_sample_zero(spark):
    runs = spark.createDataFrame([], "run_id string, run_name string, quality_gate_status string, "
                                     "model_algorithm string, f1_pos double")
    assert RK.rank_runs(runs).count() == 0
    assert RK.best_run(runs).count() == 0
    df = spark.range(0, 50)
    assert S.sample_rows(df, keys=["id"], n=0, seed=1).count() == 0
    assert S.sample_rows(df, keys=["id"], n=50, seed=1).count() == 50


def test_plain_split_sizes(spark):
    df = spark.range(0, 101).withColumn("t", F.lit("a"))
    out = S.split_train_test(df, keys=["id"], test_size=0.25, seed=3, target="t", stratify=False)
    assert out.where("part = 'test'").count() == 26      # ceil(101 * 0.25)


def test_missingness_with_boolean_feature(spark):
    df = spark.createDataFrame([(i, i % 2 == 0, str(i % 3)) for i in range(40)], "k long, b boolean, s string")
    out, rep = P.inject_missing(df, keys=["k"], fraction=0.1, seed=2)
    assert rep.applied_columns == ["b", "s"] and rep.cells_per_column == 4
    assert out.where(F.col("b").isNull()).count() == 4 and out.where(F.col("s").isNull()).count() == 4
    assert dict(out.dtypes)["b"] == "boolean"


def test_nan_passthrough_and_json(spark, tmp_path):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert read_table(spark, df).where(F.col("x").isNull()).count() == 1
    p = str(tmp_path / "t.json")
    spark.createDataFrame([(1, "a")], "i long, s string").write.json(p)
    assert read_table(spark, p, fmt="json").count() == 1


def test_missing_target_rule(spark):
    df = spark.range(0, 5)
    rules = V.validate_dataset(df, target="nope", min_rows=1, min_features=0, max_duplicate_rows=None)
    row = rules.where("rule = 'target_column'").first()
    assert row["observed"] == "missing" and row["passed"] is False
    with pytest.raises(ValidationError, match="target_column"):
        V.enforce(rules)


def test_drift_on_double_with_nulls(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 50.0)], "k long, x double")
    out = D.apply_drift(df, {"x": {"kind": "numeric", "transform": "scale", "magnitude": 2.0,
                                   "clip_min": 0, "clip_max": 60}})
    assert [r["x"] for r in out.orderBy("k").collect()] == [20.0, None, 60.0]
