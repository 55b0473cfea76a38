"""Fits that Spark ML's estimators don't offer by themselves.

* Logistic regression with the intercept inside the penalty: the model of a
  constant feature, and a certificate (the objective's gradient) of any fit.
* A forest whose trees each draw the rows anew and weigh the classes by
  their own draw (``class_weight='balanced_subsample'``).

Both return Spark ML's own model types, so they score, save and load like
any other fit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.common import _py2java
from pyspark.ml.feature import Interaction, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.errors import TrainingError, refuse
from tablegauge.functions.columns import fresh, key_text

DRAW_BITS = 48      # of a row's hash, taken as a uniform number


def poisson_cuts() -> list[int]:
    """Least uniform numbers of ``DRAW_BITS`` bits that mean 1, 2, ... draws
    of a row, by the Poisson distribution of mean 1."""
    cuts, term, below = [], math.exp(-1), 0.0
    while int((below := below + term) * 2 ** DRAW_BITS) < 2 ** DRAW_BITS - 1:
        cuts.append(int(below * 2 ** DRAW_BITS))
        term /= len(cuts)
    return cuts


def draw_count(seed: int, tree: Column, keys: Sequence[str]) -> Column:
    """How often a tree draws a row: a function of the seed, the tree and
    the row's keys alone, so it is the same on every attempt."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("draw"), tree.cast("string"), *key_text(keys)))
    u = F.conv(F.substring(h, 1, DRAW_BITS // 4), 16, 10).cast("long")
    return sum(((u >= c).cast("int") for c in poisson_cuts()), F.lit(0))


def draw_weights(df: DataFrame, label: str, keys: Sequence[str], seed: int, trees: int) -> DataFrame:
    """T5: ``(tree, label, n, weight)``: the rows that each tree draws of a
    class, and the class's weight there, ``drawn / (classes drawn * n)``.
    One aggregate with map-side counts for all trees."""
    tree, times, total, kinds = fresh(df, "tree", "times", "total", "kinds")
    each = df.select(F.col(f"`{label}`").alias(label), *[F.col(f"`{k}`") for k in keys if k != label],
                     F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias(tree))
    n = each.select(F.col(tree).alias("tree"), F.col(f"`{label}`").alias("label"), draw_count(seed, F.col(tree), keys).alias(times)) \
        .groupBy("tree", "label").agg(F.sum(times).cast("long").alias("n")).where("n > 0")
    per = n.groupBy(F.col("tree").alias("of")).agg(F.sum("n").alias(total), F.count("*").alias(kinds))
    return n.join(per, n.tree == per.of).select("tree", "label", "n", (F.col(total) / (F.col(kinds) * F.col("n"))).alias("weight"))


def fit_subsample_forest(df: DataFrame, *, keys: Sequence[str], seed: int, trees: int, max_depth: int, min_rows: int = 1,
                         features: str = "features", label: str = "label", parallel: int = 4) -> RandomForestClassificationModel:
    """T5 ``balanced_subsample``: every tree is fitted on its own draw of the
    rows, a row counting as often as it was drawn times its class's weight
    in that draw, with a random root-sized choice of features at each node.
    The trees' probabilities are averaged.

    Rows that a tree does not draw are left out of it, so ``min_rows`` counts
    drawn rows.  Null keys hash as nothing; rows with equal keys are drawn
    alike.  The counts of classes by tree are the only rows in the driver;
    an empty table is refused."""
    spark = df.sparkSession
    weights: dict[int, dict[float, float]] = {}
    classes = 2
    for r in draw_weights(df, label, keys, seed, trees).collect():          # trees x classes
        weights.setdefault(r.tree, {})[float(r.label)] = r.weight
        classes = max(classes, int(r.label) + 1)
    refuse(TrainingError, rows=(len(weights) < trees, "are too few: a tree draws none"))
    weight, times = fresh(df, "weight", "times")
    # a draw may lack a class: the label's metadata names them all
    known = {"ml_attr": {"type": "nominal", "name": label, "vals": [str(i) for i in range(classes)]}}
    named = df.withColumn(label, F.col(f"`{label}`").cast("double").alias(label, metadata=known))

    def one(t: int):
        by_class = F.create_map(*[F.lit(x) for kv in sorted(weights[t].items()) for x in kv])
        drawn = named.withColumn(times, draw_count(seed, F.lit(t), keys)).where(F.col(times) > 0) \
            .select(features, label, (F.col(times) * by_class[F.col(label)]).alias(weight))
        return RandomForestClassifier(numTrees=1, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="sqrt",
                                      maxDepth=max_depth, minInstancesPerNode=min_rows, seed=seed + t, weightCol=weight,
                                      featuresCol=features, labelCol=label).fit(drawn)

    with ThreadPoolExecutor(max(1, parallel)) as pool:
        models = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(one), t) for t in range(trees)]]
    sc = spark.sparkContext
    of = sc._jvm.org.apache.spark.ml.classification
    array = sc._gateway.new_array(of.DecisionTreeClassificationModel, trees)
    for i, m in enumerate(models):
        array[i] = m.trees[0]._java_obj
    forest = of.RandomForestClassificationModel(models[0].uid, array, models[0].numFeatures, classes)
    forest.set(forest.numTrees(), trees)
    return RandomForestClassificationModel._from_java(forest).setFeaturesCol(features)


def fit_penalised_logistic(df: DataFrame, *, c: float, max_iter: int, weight_sum: float, tol: float = 1e-6,
                           features: str = "features", label: str = "label", weight: str | None = "weight") -> LogisticRegressionModel:
    """The minimum of ``c * sum(w * log loss) + (|b|^2 + b0^2) / 2``.

    A constant feature carries the intercept ``b0`` through the penalty.  Spark ML
    gives constant features no coefficient, so rows of class 0 enter with
    features of the opposite sign as class 1, which leaves their loss as it
    is and no feature constant unless it is zero.  Both classes must occur."""
    ends = df.agg(F.min(label).alias("a"), F.max(label).alias("b")).first()
    refuse(TrainingError, rows=(ends.a == ends.b, "hold fewer than two classes"))
    one, wide, sign, flipped, yes = fresh(df, "one", "wide", "sign", "flipped", "yes")
    rows = df.withColumn(one, F.lit(1.0)).withColumn(yes, F.lit(1.0)) \
        .withColumn(sign, F.when(F.col(f"`{label}`") == 1.0, 1.0).otherwise(-1.0))
    rows = VectorAssembler(inputCols=[features, one], outputCol=wide).transform(rows)
    rows = Interaction(inputCols=[sign, wide], outputCol=flipped).transform(rows)
    fit = LogisticRegression(maxIter=max_iter, regParam=1.0 / (c * weight_sum), elasticNetParam=0.0, standardization=False,
                             fitIntercept=False, tol=tol, featuresCol=flipped, labelCol=yes,
                             **({"weightCol": weight} if weight else {})).fit(rows)
    b = fit.coefficients.toArray()
    sc = df.sparkSession.sparkContext
    model = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        fit.uid, _py2java(sc, DenseVector(b[:-1])), float(b[-1]))
    return LogisticRegressionModel._from_java(model).setFeaturesCol(features)


def logistic_gradient(df: DataFrame, model: LogisticRegressionModel, *, c: float, features: str = "features",
                      label: str = "label", weight: str = "weight") -> list[float]:
    """The gradient, one number a coefficient and the intercept's last, of
    the objective of :func:`fit_penalised_logistic` divided by ``c``, per
    unit of weight.  All near zero means that the fit is its minimum, which
    is unique.  One aggregate over the rows; both classes must occur."""
    p, up, down = fresh(df, "p", "up", "down")
    scored = model.setProbabilityCol(fresh(df, "probability")[0]).setRawPredictionCol(fresh(df, "raw")[0]) \
        .setPredictionCol(fresh(df, "predicted")[0]).transform(df)
    rows = scored.withColumn(p, vector_to_array(model.getProbabilityCol())[1])
    w, y = F.col(f"`{weight}`"), F.col(f"`{label}`")
    # weights of a summary can't be negative, so both classes are summed apart
    rows = rows.withColumn(up, F.when(y == 0, w * F.col(p)).otherwise(0.0)).withColumn(down, F.when(y == 1, w * (1 - F.col(p))).otherwise(0.0))
    add = Summarizer.metrics("sum")
    got = rows.agg(add.summary(F.col(features), F.col(up)).alias("u"), add.summary(F.col(features), F.col(down)).alias("d"),
                   F.sum(up).alias("su"), F.sum(down).alias("sd"), F.sum(w).alias("n")).first()
    slope = got.u["sum"].toArray() - got.d["sum"].toArray() + model.coefficients.toArray() / c
    return [float(v) / got.n for v in [*slope, got.su - got.sd + model.intercept / c]]
