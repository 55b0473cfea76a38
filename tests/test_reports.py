"""Writers of the sweep and the comparison, failures as data, lineage, and
the value of a fit against plain solutions."""

import json
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from tablegauge.operators import rank as K
from tablegauge.operators import train as T
from tablegauge.plans import catalog as C
from tablegauge.plans import training as TP
from tablegauge.sources import files as S
from tablegauge.sources import runs_store as R

COLUMNS = ("run_id string, run_name string, quality_gate_status string, model_algorithm string, f1_pos string, "
           "params map<string,string>")


def lines(path):
    return [json.loads(x) for f in sorted(Path(path).glob("part-*")) for x in f.read_text().splitlines()]


def test_comparison_files(spark, tmp_path):
    rows = [("r1", "one", "passed", "logistic_regression", "0.5", {"split.test_size": "0.2"}), ("r2", "two", "passed", "random_forest", "0.7", {}),
            ("r3", "three", "failed", "random_forest", "0.9", {}), ("r4", "two", "passed", "random_forest", "0.7", None)]
    out = K.write_comparison(spark.createDataFrame(rows, COLUMNS), str(tmp_path / "c"))
    got = lines(out["json"])
    assert [(r["rank"], r["run_id"]) for r in got] == [(1, "r2"), (2, "r4"), (3, "r1")]
    assert got[2]["important_parameters"]["split.test_size"] == "0.2"
    (summary,) = lines(out["summary"])
    assert summary["runs"] == 3 and json.loads(summary["best_run"])["run_id"] == "r2"
    csv = spark.read.option("header", True).csv(out["csv"])
    assert [r.run_id for r in csv.collect()] == ["r2", "r4", "r1"] and "f1_pos" in csv.columns


def test_comparison_of_an_empty_history(spark, tmp_path):
    out = K.write_comparison(spark.createDataFrame([], COLUMNS), str(tmp_path / "c"))
    assert lines(out["json"]) == []
    (summary,) = lines(out["summary"])
    assert summary["runs"] == 0 and "best_run" not in summary
    text = "".join(f.read_text() for f in Path(out["csv"]).glob("part-*"))
    assert text.splitlines()[0].startswith("rank,run_id,") and len(text.splitlines()) == 1


def test_failed_reads_as_data(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    df, state = S.try_read_table(spark, str(tmp_path / "t"))
    assert df.count() == 3 and state.first().ok and state.first().error is None
    for source in (str(tmp_path / "none"), None):
        df, state = S.try_read_table(spark, source)
        assert df is None and not state.first().ok and state.first().error and state.first().source == source


def test_source_of_a_table(spark, tmp_path):
    parts = str(tmp_path / "p")
    spark.range(9).withColumn("k", F.col("id") % 3).write.partitionBy("k").parquet(parts)
    df = spark.read.parquet(parts)
    assert S.source_path(df.where("k = 1").select("id")) == f"file://{parts}"
    one = "/root/testdata/sf0.001/orders.parquet"
    assert S.source_path(spark.read.parquet(one)).endswith(one)
    assert S.source_path(df.join(spark.read.parquet(one), F.col("id") == F.col("o_orderkey"))).count(",") == 1
    assert S.source_path(spark.range(3)) is None


def test_parallel_sweep_equals_one_after_another(spark, tmp_path):
    df = C._labelled_docs(spark, "/root/testdata/sf0.01")
    cfgs = {n: C._train_cfg(C._SPECS["01_logreg_balanced"], n) for n in ("a", "b", "c", "d", "e")}
    for n, c in zip("abde", (0.2, 0.5, 2.0, 5.0)):
        cfgs[n].model = T.ModelSpec("logistic_regression", "balanced", 50, {"C": c})
    cfgs["c"].model = T.ModelSpec("random_forest", "no such weights", None, {})
    runs = str(tmp_path / "runs")

    def rows(parallel, **kw):
        out = TP.sweep(df, cfgs, parallel=parallel, **kw).collect()
        return [(r.config, r.status, r.quality_gate_status, r.primary_value, r.metrics) for r in out]
    want = rows(1)
    assert rows(4, runs_path=runs, report_path=str(tmp_path / "sweep.json")) == want
    assert [x[1] for x in want] == ["completed", "completed", "failed", "completed", "completed"]
    assert [r["config"] for r in lines(tmp_path / "sweep.json")] == list("abcde")
    kept = R.load_runs(spark, runs, "docs-quality").collect()
    assert len(kept) == 4 and all("documents" in r.tags["dataset.path"] for r in kept)


def _plain_data(spark, n=600):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 3)) * [1, 4, .3]
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ [1.0, -.3, 2.0] + .4)))).astype(float)
    w = np.where(y > 0, 1.5, .75)
    rows = [(float(b), float(c), [float(v) for v in a]) for a, b, c in zip(x, y, w)]
    from pyspark.ml.functions import array_to_vector
    df = spark.createDataFrame(rows, "label double, weight double, x array<double>").withColumn("features", array_to_vector("x"))
    return df, x, y, w


def test_logistic_fit_is_the_minimum_of_its_objective(spark):
    """Newton's method on sum(w log loss) + |beta|^2 / (2 C), the intercept outside the penalty."""
    df, x, y, w = _plain_data(spark)
    for c in (0.1, 1.0):
        est = T.build_estimator(T.ModelSpec("logistic_regression", "balanced", 200, {"C": c}), seed=1, n_train=len(y),
                                weight_sum=float(w.sum()), weight="weight")
        model = est.setTol(1e-10).fit(df)
        a, b = np.c_[x, np.ones(len(y))], np.zeros(4)
        penalty = np.diag([1 / c] * 3 + [0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-a @ b))
            b -= np.linalg.solve(a.T * (w * p * (1 - p)) @ a + penalty, a.T @ (w * (p - y)) + penalty @ b)
        assert np.allclose([*model.coefficients, model.intercept], b, atol=1e-5)


def test_boosting_loss_falls_and_trees_rescore(spark):
    df, x, y, _ = _plain_data(spark)
    est = T.build_estimator(T.ModelSpec("gradient_boosting", None, None, {"n_estimators": 12, "learning_rate": .1}), seed=1, n_train=len(y),
                            weight_sum=float(len(y)), weight=None)
    model = est.fit(df)
    loss = model.evaluateEachIteration(df)
    assert len(loss) == 12 and all(b < a for a, b in zip(loss, loss[1:]))
    margin = sum(wt * np.array([r.prediction for r in t.transform(df).select("prediction").collect()])
                 for wt, t in zip(model.treeWeights, model.trees))
    got = model.transform(df).select("probability").collect()
    assert np.allclose([r.probability[1] for r in got], 1 / (1 + np.exp(-2 * margin)))


def test_forest_averages_its_trees(spark):
    df, x, y, w = _plain_data(spark)
    est = T.build_estimator(T.ModelSpec("random_forest", "balanced", None, {"n_estimators": 7, "max_depth": 4}), seed=1, n_train=len(y),
                            weight_sum=float(w.sum()), weight="weight")
    model = est.fit(df)
    each = [np.array([r.probability.toArray() for r in t.transform(df).select("probability").collect()]) for t in model.trees]
    got = np.array([r.probability.toArray() for r in model.transform(df).select("probability").collect()])
    assert len(each) == 7 and np.allclose(got, sum(each) / 7)
