import pytest
from pyspark.sql import functions as F

from tablegauge.errors import TrainingError
from tablegauge.operators import rank as RK
from tablegauge.operators import train as TR
from tablegauge.plans import catalog as C
from tablegauge.plans import training as TP
from tablegauge.sources import runs_store as RS

SCHEMA = ("run_id string, run_name string, quality_gate_status string, model_algorithm string, "
          "f1_pos string, balanced_accuracy double, roc_auc double, precision_pos double, "
          "recall_pos double, accuracy double")


def test_ranking_nulls_last_and_ties(spark):
    rows = [("r1", "b", "passed", "lr", "0.5", 0.7, 0.8, 0.1, 0.1, 0.1),
            ("r2", "a", "passed", "lr", "0.5", 0.7, 0.8, 0.1, 0.1, 0.1),
            ("r3", "c", "passed", "rf", "bad", 0.9, 0.9, 0.9, 0.9, 0.9),
            ("r4", "d", "failed", "gb", "0.9", 0.9, 0.9, 0.9, 0.9, 0.9),
            ("r5", "e", None, "gb", "0.95", 0.9, 0.9, 0.9, 0.9, 0.9)]
    runs = spark.createDataFrame(rows, SCHEMA)
    ranked = [r["run_id"] for r in RK.rank_runs(runs).orderBy("rank").collect()]
    assert ranked == ["r2", "r1", "r3"]          # failed / null-status runs never win
    assert RK.best_run(runs).first()["run_id"] == "r2"


def test_ranking_fallback_when_none_passed(spark):
    rows = [("r4", "d", "failed", "gb", "0.9", 0.9, 0.9, 0.9, 0.9, 0.9),
            ("r5", "e", None, "gb", "0.95", 0.9, 0.9, 0.9, 0.9, 0.9)]
    runs = spark.createDataFrame(rows, SCHEMA)
    assert [r["run_id"] for r in RK.rank_runs(runs).orderBy("rank").collect()] == ["r5", "r4"]
    assert RK.best_run(runs.limit(0)).count() == 0


def test_runs_table_append_and_scan(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i, exp in enumerate(["a", "b", "b"]):
        rec = RS.run_record(spark, experiment=exp, run_name=f"run{i}", metrics={"f1_pos": 0.1 * i, "cm": [1]},
                            params=RS.flatten_params({"model": {"algorithm": "lr"}}),
                            tags={"quality_gate.status": "passed"})
        RS.append_runs(rec, path)
    got = RS.load_runs(spark, path, "b")
    assert got.count() == 2 and got.first()["f1_pos"] == pytest.approx(0.2)
    assert RS.load_runs(spark, path, "zzz").count() == 0
    assert RS.load_runs(spark, str(tmp_path / "none"), "b").count() == 0


def test_an_append_repeated_after_a_failure_leaves_one_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    gate = [{"metric": "f1_pos", "value": 0.5, "minimum_required": 0.45, "passed": True}]
    rec = RS.run_record(spark, experiment="a", run_name="r", run_id="r1", metrics={"f1_pos": 0.5}, params={}, tags={}, gate=gate,
                        confusion=[{"actual": "No", "predicted": "Yes", "n": 3}])
    commit = RS._commit
    monkeypatch.setattr(RS, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        RS.append_runs(rec, path)
    assert RS.load_runs(spark, path, "a").count() == 0        # rows are there, the commit is not
    monkeypatch.setattr(RS, "_commit", commit)
    for _ in range(3):
        RS.append_runs(rec, path)
    (row,) = RS.load_runs(spark, path, "a").collect()
    assert [tuple(g) for g in row.gate] == [("f1_pos", 0.5, 0.45, True)] and [tuple(c) for c in row.confusion] == [("No", "Yes", 3)]
    for i in range(4):
        RS.append_runs(RS.run_record(spark, experiment="ab"[i % 2], run_name="r", run_id=f"more{i}", metrics={"f1_pos": 0.1}, params={}, tags={}), path)
    before = sorted(r.run_id for e in "ab" for r in RS.load_runs(spark, path, e).collect())
    monkeypatch.setattr(RS, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        RS.compact_runs(spark, path)
    monkeypatch.setattr(RS, "_commit", commit)
    for _ in range(2):                                        # after a failed one, a whole one, then nothing to do
        assert sorted(r.run_id for e in "ab" for r in RS.load_runs(spark, path, e).collect()) == before
        RS.compact_runs(spark, path)
    assert RS._committed(spark, path).count() == 1


def test_estimator_checks():
    with pytest.raises(TrainingError):
        TR.build_estimator(TR.ModelSpec("svm"), seed=1, n_train=10)
    with pytest.raises(TrainingError):
        TR.build_estimator(TR.ModelSpec("logistic_regression", None, 100, {"solver": "x"}), seed=1, n_train=10)
    with pytest.raises(TrainingError):
        TR.build_estimator(TR.ModelSpec("gradient_boosting", "balanced"), seed=1, n_train=10)
    with pytest.raises(TrainingError):
        TR.build_estimator(TR.ModelSpec("logistic_regression", "balanced_subsample", 100), seed=1, n_train=10)


def test_training_run_repeatable_and_recorded(spark, tmp_path):
    df = C._labelled_docs(spark, "/root/testdata/sf0.01")
    cfg = C._train_cfg(C._SPECS["01_logreg_balanced"], "t")
    path = str(tmp_path / "runs")
    a = TP.train_run(df, cfg, runs_path=path, enforce=False)
    b = TP.train_run(df, cfg, enforce=False)
    assert a.test_rows == b.test_rows and a.train_rows + a.test_rows == df.count()
    pa = sorted(a.predictions.collect())
    pb = sorted(b.predictions.collect())
    assert [r["doc_id"] for r in pa] == [r["doc_id"] for r in pb]
    assert [round(r["p_pos"], 9) for r in pa] == [round(r["p_pos"], 9) for r in pb]
    assert {r["y_pred"] for r in pa} <= {"0", "1"}
    assert RS.load_runs(spark, path, "docs-quality").count() == 1
    strict = C._train_cfg(C._SPECS["01_logreg_balanced"], "strict")
    strict.thresholds = {"f1_pos": 1.01}
    from tablegauge.errors import GateError
    with pytest.raises(GateError):
        TP.train_run(df, strict, runs_path=path)
    # the failing run was recorded before the gate raised
    assert RS.load_runs(spark, path, "docs-quality").count() == 2


def test_sweep_prepares_once_and_keeps_models(spark, tmp_path, monkeypatch):
    df = C._labelled_docs(spark, "/root/testdata/sf0.01")
    spec = C._SPECS["01_logreg_balanced"]
    cfgs = {n: C._train_cfg(spec, n) for n in ("a", "b", "c", "d")}
    cfgs["b"].thresholds = {"f1_pos": 1.01}                 # the gate fails, the sweep doesn't
    cfgs["b"].model_path = str(tmp_path / "models")
    cfgs["c"].model = TR.ModelSpec("random_forest", "no such weights", None, {})
    cfgs["d"].positive = "7"                                # another preparation, which fails
    seen = []
    prepare = TP.prepare_parts
    monkeypatch.setattr(TP, "prepare_parts", lambda base, cfg, **kw: seen.append(cfg.run_name) or prepare(base, cfg, **kw))
    path = str(tmp_path / "runs")
    rows = TP.sweep(df, cfgs, runs_path=path).collect()
    assert seen == ["a", "d"]
    assert [(r.config, r.status, r.quality_gate_status) for r in rows] == [
        ("a", "completed", "passed"), ("b", "completed", "failed"), ("c", "failed", None), ("d", "failed", None)]
    assert rows[0].metrics == rows[1].metrics and rows[0].primary_value == rows[0].metrics["f1_pos"]
    assert "no such weights" in rows[2].error and rows[2].run_id is None
    kept = {r.run_id: r for r in RS.load_runs(spark, path, "docs-quality").collect()}
    assert kept.keys() == {rows[0].run_id, rows[1].run_id}
    assert kept[rows[0].run_id].params["features.numeric"] == "n_chars"
    model = TP.FittedModel.load(spark, f"{tmp_path}/models/{rows[1].run_id}")
    assert model.transform(df.withColumn("label", F.lit(0.0))).where("probability is null").count() == 0
