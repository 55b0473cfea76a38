"""Training and scoring (T1–T7) on Spark ML.

Estimators are built from a small specification with the same reserved
parameter checks as the single-machine version; class weights become a
weight column computed from one class-count aggregate; scoring is a lazy
``transform`` producing ``(keys…, y_true, y_pred, p_pos)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.errors import TrainingError, refuse
from tablegauge.operators import fits

# Algorithm names.
ALGORITHMS = ("logistic_regression", "random_forest", "gradient_boosting")


@dataclass
class ModelSpec:
    """``algorithm`` plus estimator parameters.  Parameter names follow the
    common single-machine spelling (``C``, ``n_estimators``, ``max_depth``,
    ``min_samples_leaf``, ``learning_rate``, ``subsample``)."""
    algorithm: str
    class_weight: object = None
    max_iter: int | None = None
    params: dict = field(default_factory=dict)
    penalise_intercept: bool = True     # of logistic regression


# Parameters that the run sets itself.
_RESERVED = {
    "logistic_regression": {"random_state", "class_weight", "max_iter", "solver"},
    "random_forest": {"random_state", "class_weight"},
    "gradient_boosting": {"random_state"},
}


#: Parameters that each algorithm takes, without those the run sets itself.
_PARAMS = {k: v - _RESERVED[k] for k, v in {
    "logistic_regression": {"C", "tol"},
    "random_forest": {"n_estimators", "max_depth", "min_samples_leaf"},
    "gradient_boosting": {"n_estimators", "learning_rate", "subsample", "max_depth", "min_samples_leaf"},
}.items()}
MAX_DEPTH = 30      # the deepest tree that Spark ML grows


def _depth(value) -> int:
    """None means no limit, which is Spark ML's deepest tree."""
    return MAX_DEPTH if value is None else int(value)


def class_weight_map(df: DataFrame, label: str, class_weight,
                     counts: Mapping[float, int] | None = None,
                     classes: Mapping[str, float] | None = None) -> dict[float, float] | None:
    """T5: ``None`` -> no weights; ``'balanced'`` -> ``n / (k * n_class)``
    from one class-count aggregate; a mapping -> given weights.
    ``'balanced_subsample'`` has no weights of the whole table: each tree has
    its own (:func:`fits.draw_weights`)."""
    if class_weight in (None, "", {}) or class_weight == "balanced_subsample":
        return None
    if class_weight == "balanced":
        if counts is None:
            counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}   # one row per class
        n, k = sum(counts.values()), len(counts)
        return {float(c): n / (k * m) for c, m in counts.items()}
    if isinstance(class_weight, Mapping):
        # keys are class labels, or the label column's own numbers
        named = {str(k): v for k, v in (classes or {}).items()}
        try:
            return {named[str(k)] if str(k) in named else float(k): float(v) for k, v in class_weight.items()}
        except ValueError as e:
            raise TrainingError(f"class_weight: {e}; classes are {sorted(named)}") from e
    raise TrainingError(f"unsupported class_weight {class_weight!r}")


def with_weights(df: DataFrame, label: str, weights: Mapping[float, float] | None,
                 weight_col: str = "weight") -> DataFrame:
    if not weights:
        return df.withColumn(weight_col, F.lit(1.0))
    m = F.create_map(*[x for k, v in weights.items() for x in (F.lit(float(k)), F.lit(float(v)))])
    return df.withColumn(weight_col, F.coalesce(m[F.col(label)], F.lit(1.0)))


def build_estimator(spec: ModelSpec, *, seed: int, n_train: int, features: str = "features",
                    label: str = "label", weight: str | None = "weight", weight_sum: float | None = None):
    """A Spark ML classifier for the specification.  ``weight_sum``
    is the sum of the training weights (the row count without weights)."""
    refuse(TrainingError, algorithm=(spec.algorithm not in ALGORITHMS, f"{spec.algorithm!r} is none of {ALGORITHMS}"))
    params = dict(spec.params or {})
    known = _PARAMS[spec.algorithm]
    refuse(TrainingError,
           params=(not set(params) <= known, f"{sorted(set(params) - known)} can't be set here, only {sorted(known)}"),
           class_weight=(spec.algorithm == "gradient_boosting" and spec.class_weight not in (None, "", {}), "boosting takes no weights"),
           subsample=(spec.class_weight == "balanced_subsample" and spec.algorithm != "random_forest", "weights belong to a forest's draws"))
    common = dict(featuresCol=features, labelCol=label, probabilityCol="probability",
                  predictionCol="prediction", rawPredictionCol="rawPrediction")
    if spec.algorithm == "logistic_regression":
        rounds = spec.max_iter
        refuse(TrainingError, max_iter=(not isinstance(rounds, int) or rounds < 1, f"{rounds!r} is no count of iterations"))
        c = float(params.pop("C", 1.0))
        # penalty C * sum(w * loss) + |b|^2 / 2  ==  weighted mean loss + regParam * |b|^2 / 2
        reg = 1.0 / (c * max(1e-9, float(n_train if weight_sum is None else weight_sum)))
        return LogisticRegression(maxIter=spec.max_iter, regParam=reg, elasticNetParam=0.0, tol=float(params.pop("tol", 1e-6)),
                                  standardization=False, weightCol=weight, **common)
    if spec.algorithm == "random_forest":
        return RandomForestClassifier(
            numTrees=int(params.pop("n_estimators", 100)), maxDepth=_depth(params.pop("max_depth", None)),
            minInstancesPerNode=int(params.pop("min_samples_leaf", 1)), seed=seed,
            weightCol=weight, **common)
    return GBTClassifier(
        maxIter=int(params.pop("n_estimators", 100)), stepSize=float(params.pop("learning_rate", 0.1)),
        subsamplingRate=float(params.pop("subsample", 1.0)), maxDepth=_depth(params.pop("max_depth", 3)),
        minInstancesPerNode=int(params.pop("min_samples_leaf", 1)),
        seed=seed, featuresCol=features, labelCol=label, predictionCol="prediction")


def fit_classifier(spec: ModelSpec, df: DataFrame, *, keys: Sequence[str], seed: int, n_train: int, weight_sum: float | None = None):
    """The fitted Spark ML model of a specification on ``features``,
    ``label`` and ``weight`` columns.  Logistic regression penalises its
    intercept like its coefficients unless ``spec.penalise_intercept`` is
    off; a forest with ``balanced_subsample`` weighs each tree's own draw."""
    est = build_estimator(spec, seed=seed, n_train=n_train, weight_sum=weight_sum,
                          weight="weight" if spec.algorithm != "gradient_boosting" else None)
    params = spec.params or {}
    if spec.algorithm == "logistic_regression" and spec.penalise_intercept:
        return fits.fit_penalised_logistic(df, c=float(params.get("C", 1.0)), max_iter=spec.max_iter, tol=est.getTol(),
                                           weight_sum=float(n_train if weight_sum is None else weight_sum))
    if spec.class_weight == "balanced_subsample":
        return fits.fit_subsample_forest(df, keys=keys, seed=seed, trees=est.getNumTrees(), max_depth=est.getMaxDepth(),
                                         min_rows=est.getMinInstancesPerNode())
    return est.fit(df)


def score(model, df: DataFrame, *, keys: Sequence[str], target: str, positive: str,
          negative: str) -> DataFrame:
    """``(keys…, y_true, y_pred, p_pos)``; the positive class is
    label 1.0, so its probability is element 1 of the probability vector."""
    out = model.transform(df)
    return out.select(
        *keys, F.col(f"`{target}`").cast("string").alias("y_true"),
        F.when(F.col("prediction") == 1.0, F.lit(positive)).otherwise(F.lit(negative)).alias("y_pred"),
        vector_to_array("probability")[1].alias("p_pos"))
