"""Sizes, missing markers, paths and arguments at their limits."""
import math

import pytest
from pyspark.sql import functions as F

from tablegauge.errors import EvaluationError, TrainingError, ValidationError
from tablegauge.functions import prefix, quantile
from tablegauge.operators import audit as A
from tablegauge.operators import drift as D
from tablegauge.operators import prepare as P
from tablegauge.operators import split as S
from tablegauge.operators import train as TR
from tablegauge.operators import validate as V
from tablegauge.plans import training as TP
from tablegauge.sources import runs_store as RS
from tablegauge.sources.files import read_table


def test_split_with_fifty_thousand_classes(spark):
    df = spark.range(0, 200_000).withColumn("c", F.col("id") % 50_000)
    out = S.split_train_test(df, keys=["id"], test_size=0.25, seed=1, target="c")
    per = out.where("part = 'test'").groupBy("c").count().agg(F.count("*"), F.min("count"), F.max("count")).first()
    assert tuple(per) == (50_000, 1, 1)


def test_statistics_beyond_64_bits(spark):
    big = 10 ** 12
    counts = spark.createDataFrame([("f", 1.0, 3 * big, big), ("f", 2.0, big, 5 * big)], "g string, v double, a long, b long")
    r = prefix.ks_distance(counts, "g", "v", "a", "b", 2).first()
    assert math.isclose(r.statistic, 3 / 4 - 1 / 6, rel_tol=1e-15) and (r.n_ref, r.n_cur) == (4 * big, 6 * big)
    r = prefix.roc_auc_counts(counts, "v", "b", "a", 2).first()
    want = (1 * 3 / 2 + 5 * 3 + 5 * 1 / 2) / (6 * 4)
    assert math.isclose(r.auc, want, rel_tol=1e-15)
    e = (F.col("a").cast("decimal(19,0)") * F.col("b").cast("decimal(19,0)"))
    assert counts.select(e.alias("x")).first().x == 3 * big * big


def test_nan_is_missing_everywhere(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 7.0), (2.0, nan), (3.0, None), (nan, 7.0), (nan, 7.0)], "x double, k double")
    assert P.column_medians(df, ["x"]) == {"x": 2.0}
    assert [r.x for r in P.impute(df, {"x": 2.0}).collect()] == [1.0, 2.0, 3.0, 2.0, 2.0]
    d = {r["column_name"]: r["distinct_count"] for r in A.audit_distinct(df).collect()}
    assert d == {"x": 4, "k": 2}
    rule = V.validate_dataset(df, target="k", ranges={"x": (0, 5)}, min_rows=1, min_features=0, max_duplicate_rows=None) \
        .where("rule = 'numeric_ranges'").first()
    assert rule["passed"] is True
    ks = D.ks_scores(df, df.where("x < 3"), ["x"]).first()
    assert (ks.n_ref, ks.n_cur) == (3, 2)


def test_medians_of_many_columns_and_ties(spark):
    df = spark.range(0, 5000).select(*[(F.col("id") * (i + 3) % 1009).cast("double").alias(f"c{i}") for i in range(6)])
    got = quantile.exact_medians(df, df.columns, final_rows=50, accuracy=20)
    for c in df.columns:
        v = sorted(r[0] for r in df.select(c).collect())
        assert got[c] == (v[2499] + v[2500]) / 2


def test_csv_types_after_markers(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("a,b,s,t\n1,2.5,x,true\nNA,3.5,1,n/a\n3,n/a,NULL,false\n")
    df = read_table(spark, str(p))
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "s": "string", "t": "boolean"}
    assert [r.a for r in df.collect()] == [1, None, 3]
    again = read_table(spark, str(p), schema="a int, b double, s string, t boolean")
    assert dict(again.dtypes)["a"] == "int" and [r.b for r in again.collect()] == [2.5, 3.5, None]


def test_paths_are_spark_paths(spark, tmp_path):
    for prefix_ in ("", "file:"):
        assert RS.load_runs(spark, f"{prefix_}{tmp_path}/none", "e").count() == 0
        with pytest.raises(ValidationError):
            read_table(spark, f"{prefix_}{tmp_path}/none.parquet")
    (tmp_path / "bad" / "commits" / "append=x").mkdir(parents=True)
    (tmp_path / "bad" / "commits" / "append=x" / "part-0.parquet").write_text("no table")
    (tmp_path / "bad" / "data").mkdir()
    with pytest.raises(Exception):
        RS.load_runs(spark, str(tmp_path / "bad"), "e").collect()


def test_backslash_in_the_mode(spark):
    df = spark.createDataFrame([(1.0, "a\\b'c"), (2.0, "a\\b'c"), (3.0, None)], "x double, s string")
    spec = P.fit_features(df, ["x"], ["s"])
    assert {r.s for r in spec.transform(df).collect()} == {"a\\b'c"}


def test_repeated_keys_are_refused(spark):
    df = spark.createDataFrame([(i // 4,) for i in range(40)], "k long")
    with pytest.raises(ValueError):
        for n in range(1, 20):
            S.sample_rows(df, keys=["k"], n=n, seed=1).count()


def _rows(spark, labels):
    return spark.createDataFrame([(i, float(i % 7), "uv"[i % 2], t) for i, t in enumerate(labels)], "id long, x double, c string, t string")


def _cfg(**kw):
    return TP.TrainingConfig(target="t", keys=["id"], positive="Yes", negative="No", thresholds={"accuracy": 0.0}, primary="accuracy",
                             **({"model": TR.ModelSpec("logistic_regression", None, 5, {}), "validation": None} | kw))


def test_training_refuses_other_and_missing_classes(spark):
    for labels in (["Yes", "No", "Maybe"] * 20, ["No"] * 40):
        with pytest.raises(TrainingError):
            TP.train_run(_rows(spark, labels), _cfg())


def test_training_records_weights_matrix_and_seed(spark):
    cfg = _cfg(model=TR.ModelSpec("logistic_regression", {"Yes": 2, "No": 1}, 5, {}), seed=77)
    res = TP.train_run(_rows(spark, ["Yes", "No", "No"] * 30), cfg)
    assert sum(res.confusion.values()) == res.test_rows
    params = res.run.first()["params"]
    assert params["seed"] == "77" and params["confusion.No/No"] == str(res.confusion["No/No"])


def test_estimator_arguments():
    for spec in (TR.ModelSpec("random_forest", None, None, {"max_features": 3}), TR.ModelSpec("gradient_boosting", None, None, {"foo": 1})):
        with pytest.raises(TrainingError):
            TR.build_estimator(spec, seed=1, n_train=10)
    deep = TR.build_estimator(TR.ModelSpec("random_forest", None, None, {"max_depth": None}), seed=1, n_train=10)
    assert deep.getMaxDepth() == 30
    lr = TR.build_estimator(TR.ModelSpec("logistic_regression", None, 5, {"C": 0.5}), seed=1, n_train=10, weight_sum=40)
    assert lr.getRegParam() == 1 / 20
    with pytest.raises(TrainingError):
        TR.class_weight_map(None, "label", {"Other": 1})


def test_prediction_set_is_refused_with_its_counts(spark):
    bad = spark.createDataFrame([("Yes", "Perhaps", 1.5)], "y_true string, y_pred string, p_pos double")
    with pytest.raises(EvaluationError, match="bad_pred"):
        V.enforce_predictions(V.validate_predictions(bad))


def test_monitoring_writes_its_summary(spark, tmp_path):
    from tablegauge.plans.monitoring import run_monitoring
    df = spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") % 50).cast("double").alias("x"),
                                    F.concat(F.lit("c"), F.col("id") % 3).alias("c"), F.lit("Yes").alias("t"))
    mon = run_monitoring(df, keys=["k"], target="t", size=100, seed=1, current="drifted", excluded=["k"], persist_dir=str(tmp_path),
                         settings={"x": {"kind": "numeric", "transform": "add", "magnitude": 30}})
    row = spark.read.json(f"{tmp_path}/drift_summary.json").first()
    scores = {r.feature: r.score for r in mon.features.collect()}
    assert row.feature_drift_scores.asDict() == pytest.approx(scores) and row.drifted_feature_names == "x"
    assert row.batch_paths.asDict() == {k: mon.paths[k] for k in ("reference", "drifted")}


def test_nested_columns_in_a_csv_report(spark, tmp_path):
    from tablegauge.sources.files import write_report
    df = spark.createDataFrame([("r1", {"a": 1.0}, ["x", "y"])], "run_id string, metrics map<string,double>, names array<string>")
    write_report(df, f"{tmp_path}/r.csv", fmt="csv")
    row = spark.read.option("header", True).csv(f"{tmp_path}/r.csv").first()
    assert (row.run_id, row.names) == ("r1", '["x","y"]') and "a" in row.metrics


def test_a_run_validates_its_table_by_default(spark):
    df = _rows(spark, ["Yes", "No", "Perhaps"] * 20)
    with pytest.raises(ValidationError, match=r"target_column.*\['Perhaps'\]"):
        TP.train_run(df, _cfg(validation={"min_rows": 1, "min_features": 1}))
    with pytest.raises(ValidationError, match="minimum_rows"):
        TP.train_run(df.where("t <> 'Perhaps'"), _cfg(validation={}))


def test_scores_without_a_place_are_refused(spark):
    from tablegauge.operators.evaluate import roc_auc
    rows = [("Yes", "Yes", 0.9), ("No", "No", 0.2)]
    for bad in (("Yes", "Yes", float("nan")), ("No", "No", None), (None, "No", 0.5)):
        with pytest.raises(Exception, match="predictions: score"):
            roc_auc(spark.createDataFrame([*rows, bad], "y_true string, y_pred string, p_pos double")).collect()


def test_bounded_distinct_and_plans(spark):
    df = spark.range(0, 5000).select(*[((F.col("id") % n).cast(t) if n else F.lit(None).cast(t)).alias(f"c{i}") for i, (n, t) in enumerate(
        [(0, "string"), (1, "int"), (2, "boolean"), (20, "string"), (21, "double"), (4000, "bigint"), (5000, "string"), (3, "timestamp"), (7, "decimal(9,2)")])])
    df = df.withColumn("e", F.when(F.col("c3") == "0", "").when(F.col("c3") == "1", None).otherwise("x")) \
        .withColumn("z", F.when(F.col("c3") == "0", -0.0).when(F.col("c3") == "1", float("nan")).otherwise(0.0))
    wide = df.agg(*[A.bounded_distinct(f.name, f.dataType).alias(f.name) for f in df.schema]).first().asDict()
    assert {k: v for k, v in wide.items() if k != "c6"} == {"c0": 1, "c1": 1, "c2": 2, "c3": 20, "c4": 21, "c5": 4000, "c7": 3, "c8": 7, "e": 3, "z": 2}
    assert 4500 < wide["c6"] < 5500
    found = A.audit_candidates(df)
    assert {r.column_name for r in found.collect()} == {"c2", "c3", "c7", "c8", "e", "z"}
    rules = V.validate_dataset(df, target="c3", constant_columns=["c0", "c1", "c2", "z"], key_column="c6", min_rows=1, min_features=1)
    got = {(r.rule, r.column_name): (r.observed, r.passed) for r in rules.collect()}
    assert got["expected_constants", "c0"] == ("1", True) and got["expected_constants", "c1"] == ("1", True)
    assert got["expected_constants", "c2"] == ("2", False) and got["expected_constants", "z"] == ("2", False)
    assert got["key_unique", "c6"] == ("0", True)
    for plan in (found, rules):
        assert "Expand" not in plan._jdf.queryExecution().toString()


def test_duplicates_by_fingerprint(spark):
    rows = [(None, "a", 0.0), ("a", None, 0.0), ("a", None, -0.0), (None, "a", float("nan")), (None, "a", float("nan")), ("", "a", 1.0),
            ("a", "", 1.0), ("", "a", 1.0), (None, None, None), (None, None, None), (None, None, None), ("ab", "c", 2.0), ("a", "bc", 2.0)]
    df = spark.createDataFrame(rows, "a string, b string, print_one double")
    assert A.audit_duplicates(df).first()[0] == len(rows) - df.groupBy(*df.columns).count().count() == 5
    assert A.audit_duplicates(df.limit(0)).first()[0] == 0


def test_target_values_in_first_seen_order(spark, tmp_path):
    words = ["m", "z", None, "a", "m", "k", "a"] * 30
    spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i long, t string").repartitionByRange(4, "i") \
        .sortWithinPartitions("i").write.csv(f"{tmp_path}/t.csv", header=True)
    want = [(0, "m", "string"), (1, "z", "string"), (2, None, "string"), (3, "a", "string"), (4, "k", "string")]
    df = spark.read.csv(f"{tmp_path}/t.csv", header=True, schema="i long, t string")
    assert sorted(map(tuple, A.audit_target_values(df, "t").collect())) == want
    made = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i long, t string")
    assert sorted(map(tuple, A.audit_target_values(made, "t", order=["i"]).collect())) == want
