import numpy as np
import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from tablegauge.llm import catalog, quality


def test_passages_cover_whole_texts():
    for t in ODD:
        data = (t or "").encode()
        n = len(data.split())
        x = quality.encode(data)
        assert x.shape == (max(1, -(-n // quality.PASSAGE_WORDS)), quality.N_FEATURES)
        assert np.isfinite(x).all()
        if n:
            assert np.isclose(np.expm1(x[:, -2]).sum(), n, rtol=1e-3)


def test_gradient_matches_differences():
    rng = np.random.default_rng(3)
    w = {"W": rng.normal(0, .3, (5, 4)), "b": rng.normal(0, .3, 4), "V": rng.normal(0, .5, (4, 3)), "U": rng.normal(0, .5, (4, 3)),
         "w": rng.normal(0, .5, 3), "c": rng.normal(0, .5, 4), "d": np.array(.1)}
    x, first, y = rng.normal(0, 1, (9, 5)), np.array([0, 1, 4, 9]), np.array([1., 0., 1.])

    def loss(w):
        p = quality._forward(w, x, first)[0]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    grad = quality._gradient(w, x, first, y, 0.0)
    for k in w:
        for i in np.ndindex(w[k].shape):
            up, down = ({**w, k: w[k].copy()} for _ in range(2))
            up[k][i] += 1e-6
            down[k][i] -= 1e-6
            assert np.isclose((loss(up) - loss(down)) / 2e-6, grad[k][i], atol=1e-6)


def test_attention_finds_the_bad_passage():
    rng = np.random.default_rng(1)
    bags, labels = [], []
    for i in range(300):
        b = rng.normal(0, .1, (6, quality.N_FEATURES)).astype(np.float32)
        if i % 2:
            b[i % 6, :8] += 1
        bags.append(b)
        labels.append(1 - i % 2)
    m = quality.train(bags[:200], np.array(labels[:200]), epochs=30)
    p, a = m.score(bags[200:])
    assert ((p > .5) == np.array(labels[200:])).mean() > .95
    assert np.mean([np.argmax(x) == i % 6 for i, x in enumerate(a, 200) if i % 2]) > .8


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = catalog.op2_quality_classifier(spark, sf)
    rows = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert out.count() == 10_000 and len(rows) > 400
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    good = [r.predicted for r in rows if r.quality == 1]
    bad = [r.predicted for r in rows if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1


def test_odd_rows_and_empty_tables(spark, docs):
    df = docs(ODD).withColumn("id", F.lit(1)).withColumn("score", F.lit("x"))
    model = quality.fit(spark.createDataFrame([("good text here", 1), ("BAD!! BAD!!", 0), (None, 1), ("", 0)], "text string, label int"))
    got = quality.score(df, model).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(ODD))) and all(0 <= r.score <= 1 for r in got)
    assert quality.score(df.limit(0), model).collect() == []
    assert quality.keep(df, model, 0.0).count() == len(ODD) and quality.keep(df, model, 1.1).count() == 0
    none = spark.createDataFrame([], "text string, label int")
    assert {r.score for r in quality.score(df, quality.fit(none)).collect()} == {0.5}
    one = spark.createDataFrame([("a", 1)], "text string, label int")
    assert {r.score for r in quality.score(df, quality.fit(one)).collect()} == {1.0}


@pytest.mark.parametrize("bound", [5, 10_000])
def test_training_sample_is_bounded(spark, bound):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    assert quality.labelled(docs, labels, "quality", bound).count() == min(bound, labels.count())
