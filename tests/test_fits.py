"""The penalised intercept with its certificate, forests of weighted draws."""
import hashlib
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tablegauge.errors import TrainingError
from tablegauge.operators import fits
from tablegauge.operators import train as T


@pytest.fixture(scope="module")
def plain(spark):
    rng = np.random.default_rng(8)
    n = 500
    x = rng.normal(size=(n, 4)) * [1, 3, .5, 1]
    x[rng.random((n, 4)) < .3] = 0
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ [1.2, -.4, 2.0, 0] - 1.5)))).astype(float)
    w = np.where(y > 0, 1.5, .75)
    rows = [(i, float(b), float(c), [float(v) for v in a]) for i, (a, b, c) in enumerate(zip(x, y, w))]
    df = spark.createDataFrame(rows, "id long, label double, weight double, x array<double>") \
        .withColumn("features", array_to_vector("x")).drop("x").cache()
    return df, x, y, w


def newton(x, y, w, c):
    """The minimum of c * sum(w * log loss) + |b|^2 / 2 over coefficients and intercept."""
    a, b = np.c_[x, np.ones(len(y))], np.zeros(x.shape[1] + 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ b))
        b -= np.linalg.solve(c * a.T * (w * p * (1 - p)) @ a + np.eye(len(b)), c * a.T @ (w * (p - y)) + b)
    return b


@pytest.mark.parametrize("c", [0.02, 1.0, 20.0])
def test_penalised_intercept_is_newtons(spark, plain, tmp_path, c):
    df, x, y, w = plain
    spec = T.ModelSpec("logistic_regression", "balanced", 500, {"C": c, "tol": 1e-12})
    model = T.fit_classifier(spec, df, keys=["id"], seed=1, n_train=len(y), weight_sum=float(w.sum()))
    want = newton(x, y, w, c)
    assert np.allclose([*model.coefficients, model.intercept], want, atol=1e-5)
    got = fits.logistic_gradient(df, model.copy(), c=c)
    assert len(got) == 5 and max(map(abs, got)) < 1e-6
    p = [r.probability[1] for r in model.transform(df).orderBy("id").collect()]
    assert np.allclose(p, 1 / (1 + np.exp(-(x @ want[:-1] + want[-1]))), atol=1e-5)
    PipelineModel(stages=[model]).write().overwrite().save(str(tmp_path / "m"))
    (again,) = PipelineModel.load(str(tmp_path / "m")).stages
    assert [*again.coefficients, again.intercept] == [*model.coefficients, model.intercept]


def test_certificate_tells_another_objective(plain):
    df, x, y, w = plain
    spec = T.ModelSpec("logistic_regression", "balanced", 500, {"C": .02, "tol": 1e-12}, penalise_intercept=False)
    free = T.fit_classifier(spec, df, keys=["id"], seed=1, n_train=len(y), weight_sum=float(w.sum()))
    assert type(free).__name__ == "LogisticRegressionModel"
    got = fits.logistic_gradient(df, free.copy(), c=.02)
    a = np.c_[x, np.ones(len(y))]
    b = np.array([*free.coefficients, free.intercept])
    plain_gradient = (a.T @ (w * (1 / (1 + np.exp(-a @ b)) - y)) + b / .02) / w.sum()
    assert np.allclose(got, plain_gradient, atol=1e-9) and abs(got[-1]) > 1e-3 and max(map(abs, got[:-1])) < 1e-5


def draws(seed, tree, key):
    """Poisson draws by the inverse distribution function, term by term."""
    u = int(hashlib.md5(f"{seed}|draw|{tree}|{key}".encode()).hexdigest()[:12], 16) / 2 ** 48
    k, below = 0, math.exp(-1)
    while u >= below:
        k += 1
        below += math.exp(-1) / math.factorial(k)
    return k


def test_draw_weights_equal_the_counted_formula(spark, plain):
    df, _, y, _ = plain
    got = {(r.tree, r.label): (r.n, r.weight) for r in fits.draw_weights(df, "label", ["id"], 5, 6).collect()}
    for t in range(6):
        n = {c: sum(draws(5, t, i) for i in range(len(y)) if y[i] == c) for c in (0.0, 1.0)}
        for c in n:
            assert got[t, c][0] == n[c] and math.isclose(got[t, c][1], sum(n.values()) / (2 * n[c]))
    assert len(got) == 12 and len({v[0] for v in got.values()}) > 2
    cuts = fits.poisson_cuts()
    assert cuts == sorted(set(cuts)) and cuts[-1] < 2 ** 48 and len(cuts) > 12


def test_subsample_forest_averages_trees_of_their_own_draws(spark, plain, tmp_path):
    df, _, y, _ = plain
    spec = T.ModelSpec("random_forest", "balanced_subsample", None, {"n_estimators": 4, "max_depth": 3, "min_samples_leaf": 5})
    fit = lambda seed: T.fit_classifier(spec, df, keys=["id"], seed=seed, n_train=len(y))
    a, b, other = fit(5), fit(5), fit(6)
    assert a.toDebugString.split("\n")[1:] == b.toDebugString.split("\n")[1:] != other.toDebugString.split("\n")[1:]
    assert a.getNumTrees == 4 and a.numClasses == 2
    scores = lambda m: np.array([r.probability.toArray() for r in m.transform(df).orderBy("id").select("probability").collect()])
    assert np.allclose(scores(a), sum(scores(t) for t in a.trees) / 4)
    assert ((scores(a)[:, 1] > .5) == (y == 1)).mean() > .7
    # each tree's root holds the weights of its draw: both classes weigh the same
    for t, tree in enumerate(a.trees):
        root = tree._java_obj.rootNode().impurityStats().stats()
        half = sum(draws(5, t, i) for i in range(len(y))) / 2
        assert np.allclose(list(root), [half, half])
    PipelineModel(stages=[a]).write().overwrite().save(str(tmp_path / "f"))
    (again,) = PipelineModel.load(str(tmp_path / "f")).stages
    assert np.array_equal(scores(again), scores(a))


def test_draws_of_odd_tables(spark, plain):
    df, _, _, _ = plain
    with pytest.raises(TrainingError):
        fits.fit_subsample_forest(df.limit(0), keys=["id"], seed=1, trees=2, max_depth=2)
    one = df.where("label = 0").select("id", "label", "features", F.lit("x").alias("tree"), F.lit(1).alias("times"), F.lit(2).alias("total"))
    m = fits.fit_subsample_forest(one, keys=["id", "tree"], seed=1, trees=2, max_depth=2)
    assert m.numClasses == 2 and m.transform(one).where("prediction <> 0").count() == 0
    by_tree = fits.draw_weights(one, "label", ["id", "times"], 1, 2).collect()
    assert [r.weight for r in by_tree] == [1.0, 1.0]
