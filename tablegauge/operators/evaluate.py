"""Evaluation and quality gate.

A prediction set is a DataFrame ``(…, y_true, y_pred, p_pos)``.  All
metrics come from one aggregate of confusion counts plus the exact ROC AUC
(per-score counts and range-partitioned prefix sums, see
:mod:`tablegauge.functions.prefix`); only one row reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.errors import EvaluationError, GateError, refuse
from tablegauge.functions.columns import is_numeric
from tablegauge.functions.prefix import roc_auc_counts

# Label domain (negative first) and metric names.
NEGATIVE = "No"
POSITIVE = "Yes"
METRICS = ("accuracy", "balanced_accuracy", "precision_pos", "recall_pos", "f1_pos", "roc_auc")


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def confusion_counts(preds: DataFrame, *, y_true: str = "y_true", y_pred: str = "y_pred",
                     positive: str = POSITIVE, negative: str = NEGATIVE) -> DataFrame:
    """One aggregate: ``(n, tp, fp, fn, tn)``."""
    t, p = F.col(y_true), F.col(y_pred)

    def cnt(c: Column) -> Column:
        return F.coalesce(F.sum(c.cast("long")), F.lit(0)).cast("long")
    return preds.agg(
        F.count(F.lit(1)).alias("n"),
        cnt((t == positive) & (p == positive)).alias("tp"),
        cnt((t == negative) & (p == positive)).alias("fp"),
        cnt((t == positive) & (p == negative)).alias("fn"),
        cnt((t == negative) & (p == negative)).alias("tn"))


def confusion_matrix(preds: DataFrame, *, y_true: str = "y_true", y_pred: str = "y_pred",
                     labels: Sequence[str] = (NEGATIVE, POSITIVE)) -> DataFrame:
    """M7: ``(actual, predicted, n)`` for every label pair, zero cells kept.
    One aggregate; the label grid is unpivoted from its single row."""
    lab = list(labels)
    aggs = [F.coalesce(F.sum(((F.col(y_true) == a) & (F.col(y_pred) == b)).cast("long")), F.lit(0))
            .cast("long").alias(f"c{i}_{j}") for i, a in enumerate(lab) for j, b in enumerate(lab)]
    wide = preds.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{i}_{j}").alias("n"))
        for i, a in enumerate(lab) for j, b in enumerate(lab)])))


def roc_auc(preds: DataFrame, *, y_true: str = "y_true", p_pos: str = "p_pos",
            positive: str = POSITIVE, num_partitions: int | None = None) -> DataFrame:
    """M6: exact ROC AUC with ties, one row ``(roc_auc, n_pos, n_neg)``.  A
    missing or NaN score and a missing truth are refused when the plan runs:
    they have no place among the scores."""
    p, t = F.col(p_pos).cast("double"), F.col(y_true)
    said = F.concat(F.lit("predictions: score "), F.coalesce(p.cast("string"), F.lit("missing")), F.lit(", truth "), F.coalesce(t.cast("string"), F.lit("missing")))
    score = F.when(p.isNull() | F.isnan(p) | t.isNull(), F.raise_error(said).cast("double")).otherwise(p)
    counts = preds.groupBy(score.alias("score")).agg(
        F.sum((F.col(y_true) == positive).cast("long")).alias("pos"),
        F.sum((F.col(y_true) != positive).cast("long")).alias("neg"))
    return roc_auc_counts(counts, "score", "pos", "neg", num_partitions).withColumnRenamed("auc", "roc_auc")


def classification_metrics(preds: DataFrame, *, y_true: str = "y_true", y_pred: str = "y_pred",
                           p_pos: str = "p_pos", positive: str = POSITIVE,
                           negative: str = NEGATIVE) -> DataFrame:
    """M1–M6 as one row of doubles.  Precision / recall / F1 of the
    positive class are 0 when undefined; balanced accuracy averages the
    recall of the classes present in the truth; ROC AUC is NULL when one
    class is absent (:func:`enforce_auc` raises for that)."""
    cc = confusion_counts(preds, y_true=y_true, y_pred=y_pred, positive=positive, negative=negative)
    auc = roc_auc(preds, y_true=y_true, p_pos=p_pos, positive=positive).select("roc_auc").scalar()
    tp, fp, fn, tn, n = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    rec_pos = _div(tp, tp + fn)
    rec_neg = _div(tn, tn + fp)
    present = (F.when(tp + fn > 0, 1).otherwise(0) + F.when(tn + fp > 0, 1).otherwise(0))
    bal = _div(F.coalesce(rec_pos, F.lit(0.0)) + F.coalesce(rec_neg, F.lit(0.0)), present)
    return cc.select(
        _div(tp + tn, n).alias("accuracy"),
        bal.alias("balanced_accuracy"),
        F.coalesce(_div(tp, tp + fp), F.lit(0.0)).alias("precision_pos"),
        F.coalesce(rec_pos, F.lit(0.0)).alias("recall_pos"),
        F.coalesce(_div(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1_pos"),
        auc.alias("roc_auc"))


def metrics_long(metrics: DataFrame) -> DataFrame:
    """One metric row -> ``(metric, value)`` rows."""
    cols = [c for c in metrics.columns]
    return metrics.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])))


def quality_gate(metrics: DataFrame, thresholds: Mapping[str, float], *, primary: str) -> DataFrame:
    """G1: ``(metric, value, minimum_required, passed, is_primary)``; a
    metric fails when ``value < minimum`` (strict).  Every thresholded
    metric and the primary metric must exist (checked on the schema)."""
    types = {f.name: f.dataType for f in metrics.schema.fields}
    needs = {primary: "the primary metric needs a threshold"} if primary not in thresholds else {}
    needs |= {m: "no numeric metric of this name" for m in (primary, *thresholds) if m not in types or not is_numeric(types[m])}
    refuse(EvaluationError, **{m: (True, text) for m, text in needs.items()})
    thr = F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(float(v)))])
    long = metrics_long(metrics.select(*thresholds.keys()))
    return long.select(
        "metric", "value", thr[F.col("metric")].alias("minimum_required"),
        F.coalesce(F.col("value") >= thr[F.col("metric")], F.lit(False)).alias("passed"),
        (F.col("metric") == primary).alias("is_primary"))


def gate_summary(gate: DataFrame) -> DataFrame:
    """One row ``(passed, primary_metric, primary_value, failed_metrics)``."""
    return gate.agg(
        F.bool_and("passed").alias("passed"),
        F.max_by("metric", F.col("is_primary").cast("int")).alias("primary_metric"),
        F.max_by("value", F.col("is_primary").cast("int")).alias("primary_value"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("metric")))))
        .alias("failed_metrics"))


def enforce_gate(gate: DataFrame) -> None:
    """Raise with every failed metric listed (a bounded set of rows)."""
    short = gate.where(~F.col("passed")).select("metric", "value", "minimum_required").orderBy("metric").collect()
    if short:
        raise GateError("below the gate: " + "; ".join(f"{m} is {v}, at least {least} is needed" for m, v, least in short))


def enforce_auc(metrics: DataFrame) -> None:
    r = metrics.select("roc_auc").first()
    if r is None or r[0] is None:
        raise EvaluationError("roc_auc: the true labels are all alike, so there is nothing to rank")
