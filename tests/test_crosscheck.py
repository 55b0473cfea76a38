"""Cross-checks against Spark ML's own statistics."""
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from tablegauge.operators import drift as D
from tablegauge.operators.evaluate import roc_auc

SF = "/root/testdata/sf0.01"


def test_chi2_pvalue_matches_spark_ml(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("ts", "event_type")
    cut = F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    ref, cur = ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)
    ours = D.chi2_scores(ref, cur, ["event_type"]).first()
    both = ref.withColumn("label", F.lit(0.0)).unionByName(cur.withColumn("label", F.lit(1.0)))
    idx = StringIndexer(inputCol="event_type", outputCol="i").fit(both).transform(both)
    vec = VectorAssembler(inputCols=["i"], outputCol="features").transform(idx)
    r = ChiSquareTest.test(vec, "features", "label").first()
    assert abs(ours["statistic"] - r["statistics"][0]) < 1e-9
    assert ours["dof"] == r["degreesOfFreedom"][0]
    assert abs(ours["p_value"] - r["pValues"][0]) < 1e-9


def test_auc_matches_binary_evaluator(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    preds = li.select(F.when(F.col("l_returnflag") == "R", "Yes").otherwise("No").alias("y_true"),
                      (F.col("l_discount") * 10.0).alias("p_pos"))
    ours = roc_auc(preds).first()["roc_auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="p_pos", labelCol="label", numBins=0)
    theirs = ev.evaluate(preds.withColumn("label", (F.col("y_true") == "Yes").cast("double")))
    assert abs(ours - theirs) < 1e-12
