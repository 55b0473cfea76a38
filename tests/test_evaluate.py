import pytest

from tablegauge.errors import EvaluationError, GateError
from tablegauge.operators import evaluate as E
from tablegauge.operators import validate as V


def test_fixture_metrics(spark, x4):
    m = E.classification_metrics(x4).first().asDict()
    assert m["accuracy"] == 0.7
    assert abs(m["precision_pos"] - 3 / 4) < 1e-12 and abs(m["recall_pos"] - 3 / 5) < 1e-12
    assert abs(m["f1_pos"] - 2 / 3) < 1e-12
    assert abs(m["balanced_accuracy"] - (4 / 5 + 3 / 5) / 2) < 1e-12
    assert abs(m["roc_auc"] - 22 / 25) < 1e-12


def test_confusion_sums_to_n(spark, x4):
    cm = {(r["actual"], r["predicted"]): r["n"] for r in E.confusion_matrix(x4).collect()}
    assert cm == {("No", "No"): 4, ("No", "Yes"): 1, ("Yes", "No"): 2, ("Yes", "Yes"): 3}


def test_gate_strictness(spark, x4):
    m = E.classification_metrics(x4)
    ok = E.quality_gate(m, {"f1_pos": 0.30}, primary="f1_pos")
    E.enforce_gate(ok)
    assert E.gate_summary(ok).first()["passed"] is True
    exact = E.quality_gate(m, {"accuracy": 0.7}, primary="accuracy")   # equal passes
    E.enforce_gate(exact)
    bad = E.quality_gate(m, {"f1_pos": 0.95}, primary="f1_pos")
    with pytest.raises(GateError, match="f1_pos"):
        E.enforce_gate(bad)
    with pytest.raises(EvaluationError):
        E.quality_gate(m, {"f1_pos": 0.3}, primary="roc_auc")
    with pytest.raises(EvaluationError):
        E.quality_gate(m, {"nope": 0.3, "f1_pos": 0.1}, primary="f1_pos")


def test_prediction_checks(spark, x4):
    V.enforce_predictions(V.validate_predictions(x4))
    bad = x4.withColumn("p_pos", x4.p_pos * 2)
    with pytest.raises(EvaluationError):
        V.enforce_predictions(V.validate_predictions(bad))


def test_single_class_auc_raises(spark, x4):
    one = x4.where("y_true = 'No'")
    with pytest.raises(EvaluationError):
        E.enforce_auc(E.classification_metrics(one))
