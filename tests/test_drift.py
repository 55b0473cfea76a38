import pytest
from pyspark.sql import functions as F

from tablegauge.errors import ValidationError
from tablegauge.operators import drift as D

SETTINGS = {
    "o_totalprice": {"kind": "numeric", "transform": "scale", "magnitude": 0.75, "clip_min": 1000,
                     "clip_max": 300000},
    "o_custkey": {"kind": "numeric", "transform": "add", "magnitude": 50.5, "clip_min": 0, "clip_max": 1499},
    "o_orderpriority": {"kind": "categorical", "transform": "set_constant", "value": "1-URGENT"},
}
FEATURES = ["o_custkey", "o_totalprice", "o_orderpriority", "o_shippriority_like"]


def _orders(spark):
    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    # an unchanged categorical feature
    return o.withColumn("o_shippriority_like", (F.col("o_orderkey") % 4).cast("string"))


@pytest.fixture(scope="module")
def batches(spark):
    return D.monitoring_batches(_orders(spark), keys=["o_orderkey"], size=300, seed=42,
                                settings=SETTINGS, target="o_orderstatus")


def test_stable_batch_has_no_drift(batches):
    feats, summary = D.compare_batches(batches.reference, batches.stable, features=FEATURES,
                                       feature_threshold=0.5, share_threshold=0.15)
    s = summary.first()
    assert s["drifted_feature_count"] == 0 and s["gate_status"] == "passed"


def test_drifted_batch_flags_exactly_the_mutated(batches):
    feats, summary = D.compare_batches(batches.reference, batches.drifted, features=FEATURES,
                                       feature_threshold=0.5, share_threshold=0.15)
    drifted = [r["feature"] for r in feats.where("drifted").orderBy("position").collect()]
    assert drifted == ["o_custkey", "o_totalprice", "o_orderpriority"]
    s = summary.first()
    assert s["gate_status"] == "failed" and s["dataset_drift"] is True
    assert s["drifted_feature_names"] == "o_custkey,o_totalprice,o_orderpriority"


def test_target_unchanged_and_integer_rounding(spark, batches):
    assert D.target_mismatches(batches.stable, batches.drifted, ["o_orderkey"], "o_orderstatus") \
        .first()[0] == 0
    assert dict(batches.drifted.dtypes)["o_custkey"] == "bigint"
    df = spark.createDataFrame([(1, 2), (2, 3), (3, None)], "k long, x long")
    out = D.apply_drift(df, {"x": {"kind": "numeric", "transform": "add", "magnitude": 0.5}})
    assert [r["x"] for r in out.orderBy("k").collect()] == [2, 4, None]   # half to even, NULL kept


def test_deterministic(spark, batches):
    again = D.monitoring_batches(_orders(spark), keys=["o_orderkey"], size=300, seed=42,
                                 settings=SETTINGS, target="o_orderstatus")
    assert sorted(map(repr, again.drifted.collect())) == sorted(map(repr, batches.drifted.collect()))


def test_bad_settings(spark, batches):
    with pytest.raises(ValidationError):
        D.apply_drift(batches.stable, {"nope": {"kind": "numeric", "transform": "add", "magnitude": 1}})
    with pytest.raises(ValidationError):
        D.apply_drift(batches.stable, {"o_custkey": {"kind": "numeric", "transform": "pow", "magnitude": 1}})
    with pytest.raises(ValidationError):
        D.apply_drift(batches.stable, {"o_orderpriority": {"kind": "categorical", "transform": "shift"}})
    with pytest.raises(ValidationError):
        D.choose_batch(batches, "production")
    with pytest.raises(ValidationError):
        D.compare_batches(batches.reference, batches.stable.withColumnRenamed("o_custkey", "cust"),
                          features=["o_totalprice"], feature_threshold=0.5, share_threshold=0.15,
                          column_order=batches.reference.columns)


def test_unscored_feature_counts_as_one(spark):
    scores = spark.createDataFrame([("a", 0.01)], "feature string, score double")
    f = D.drifted_features(scores, ["a", "b"], 0.5).orderBy("position").collect()
    assert [(r["feature"], r["score"], r["drifted"]) for r in f] == [("a", 0.01, True), ("b", 1.0, False)]
    g = D.drift_gate(D.drifted_features(scores, ["a", "b"], 0.5), 0.5).first()
    assert g["drifted_feature_share"] == 0.5 and g["gate_status"] == "failed"   # >= fails


def test_monitoring_run_with_persisted_batches(spark, tmp_path):
    from tablegauge.plans.monitoring import run_monitoring
    res = run_monitoring(_orders(spark), keys=["o_orderkey"], target="o_orderstatus", size=300, seed=42,
                         settings=SETTINGS, current="drifted", excluded=["o_orderkey"],
                         allowed_target_values=["F", "O", "P"], persist_dir=str(tmp_path / "batches"))
    assert set(res.paths) == {"reference", "stable", "drifted"}
    assert res.context.feature_columns == ["o_custkey", "o_totalprice", "o_orderpriority",
                                           "o_shippriority_like"]
    s = res.summary.first()
    assert s["drifted_feature_count"] == 3 and s["gate_status"] == "failed"
    with pytest.raises(ValidationError):
        run_monitoring(_orders(spark), keys=["o_orderkey"], target="o_orderstatus", size=300, seed=42,
                       settings=SETTINGS, current="production")


def test_streaming_monitor_one_row_per_batch_file(spark, batches, tmp_path):
    from tablegauge.streaming import run_drift_monitor_once
    folder = str(tmp_path / "incoming")
    batches.stable.coalesce(1).write.mode("append").parquet(folder)
    batches.drifted.coalesce(1).write.mode("append").parquet(folder)
    out = run_drift_monitor_once(spark, batches.reference, folder, schema=batches.reference.schema,
                                 features=FEATURES[:3], feature_threshold=0.5, share_threshold=0.15,
                                 sink_path=str(tmp_path / "out"), checkpoint=str(tmp_path / "ckpt"))
    got = [(r["batch_id"], r["drifted_feature_count"], r["gate_status"]) for r in out.orderBy("batch_id").collect()]
    assert got == [(0, 0, "passed"), (1, 3, "failed")]
