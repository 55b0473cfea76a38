import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablegauge.errors import PreparationError
from tablegauge.operators import prepare as P

EXCL = ["unit", "plant", "grade", "volt"]


def test_feature_columns_and_types(spark, x3):
    feats = P.feature_columns(x3, "failed", EXCL + ["not_there"])
    assert feats == ["hours", "load", "site", "maker"]
    num, cat = P.feature_types(x3, feats)
    assert num == ["hours", "load"] and cat == ["site", "maker"]
    with pytest.raises(PreparationError):
        P.feature_columns(x3, "nope")
    with pytest.raises(PreparationError):
        P.feature_types(x3, ["hours"])


def test_missingness_exact_and_deterministic(spark, x3):
    kw = dict(keys=["unit"], fraction=0.2, seed=42, protected=["failed"],
              strategy="selected_columns", columns=["hours", "maker"])
    a, rep = P.inject_missing(x3, **kw)
    b, _ = P.inject_missing(x3, **kw)
    assert rep.cells_per_column == 1 and rep.missing_cells_introduced == 2
    assert a.where(F.col("hours").isNull()).count() == 1
    assert a.where(F.col("maker").isNull()).count() == 1
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    # the target and the keys are untouched
    assert a.select("failed", "unit").collect() == x3.select("failed", "unit").collect()
    with pytest.raises(PreparationError):
        P.inject_missing(x3, keys=["unit"], fraction=0.5, seed=1)
    with pytest.raises(PreparationError):
        P.inject_missing(x3, keys=["unit"], fraction=0.1, seed=1, strategy="selected_columns",
                         columns=["hours"])


def test_missingness_on_real_table(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        "o_orderkey", "o_totalprice", "o_orderpriority")
    out, rep = P.inject_missing(orders, keys=["o_orderkey"], fraction=0.1, seed=5)
    n = orders.count()
    for c in ("o_totalprice", "o_orderpriority"):
        assert out.where(F.col(c).isNull()).count() == max(1, int(n * 0.1))


def test_imputation_x3(spark, x3):
    holes = x3.withColumn("hours", F.when(F.col("unit") == 12, None).otherwise(F.col("hours"))) \
              .withColumn("maker", F.when(F.col("unit") == 13, None).otherwise(F.col("maker")))
    assert P.column_medians(holes, ["hours"]) == {"hours": 120.0}
    assert P.column_modes(holes, ["maker"]) == {"maker": "Acme"}
    filled = P.impute(holes, {"hours": 120.0, "maker": "Acme"})
    assert filled.where(F.col("hours").isNull() | F.col("maker").isNull()).count() == 0
    # mean of the middle pair for an even count
    ev = spark.createDataFrame([(1,), (2,), (3,), (10,)], "v long")
    assert P.column_medians(ev, ["v"]) == {"v": 2.5}


def test_mode_ties_lowest_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert P.column_modes(df, ["c"]) == {"c": "a"}


def test_encoding_unseen_is_zero(spark, x3):
    feats = P.feature_columns(x3, "failed", EXCL)
    num, cat = P.feature_types(x3, feats)
    spec = P.fit_features(x3, num, cat, keep=["unit"])
    names = [r.feature_name for r in spec.names(spark).orderBy("position").collect()]
    assert len(names) == 8 and names[:2] == [f"numeric__{c}" for c in num]
    assert not any(e in n for n in names for e in EXCL)
    new = x3.limit(1).withColumn("maker", F.lit("NewDept"))
    vec = spec.transform(new).select(vector_to_array("features").alias("v")).first()["v"]
    dept_idx = [i for i, n in enumerate(names) if n.startswith("categorical__maker_")]
    assert [vec[i] for i in dept_idx] == [0.0, 0.0, 0.0] and sum(vec) == 1.0 + sum(vec[:2])
    long = P.onehot_long(new, P.fit_categories(x3, ["maker"]), keep=["unit"]).collect()
    assert sorted(r.feature_name for r in long) == [f"categorical__maker_{v}" for v in ("Acme", "Bolt", "Crane")]
    assert {r.value for r in long} == {0.0}


def test_model_save_load_same_predictions(spark, x3, tmp_path):
    from pyspark.ml.classification import LogisticRegression

    from tablegauge.plans.training import FittedModel
    feats = P.feature_columns(x3, "failed", EXCL)
    num, cat = P.feature_types(x3, feats)
    spec = P.fit_features(x3, num, cat, keep=["unit", "failed"])
    fit = LogisticRegression(maxIter=3).fit(spec.transform(x3).withColumn("label", (F.col("failed") == "Yes").cast("double")))
    model = FittedModel(spec, fit)
    model.save(spark, str(tmp_path / "model"))
    again = FittedModel.load(spark, str(tmp_path / "model"))
    a, b = ([tuple(r) for r in m.transform(x3).select("unit", vector_to_array("features"), vector_to_array("probability")).orderBy("unit").collect()]
            for m in (model, again))
    assert a == b and len(a) == 4


def test_columns_without_values(spark):
    df = spark.createDataFrame([(1.0, None, "x"), (None, None, None)], "n double, c string, d string")
    spec = P.fit_features(df, ["n"], ["c", "d"], keep=["n"][:0])
    assert spec.categories.width == [0, 1] and spec.modes == {"c": None, "d": "x"}
    assert [r[0] for r in spec.transform(df).select(vector_to_array("features")).collect()] == [[1.0, 1.0]] * 2
    none = P.fit_features(df.select("c", "d", F.lit(None).cast("double").alias("n")), ["n"], ["d"])
    with pytest.raises(Exception, match="median"):
        none.transform(df).collect()
