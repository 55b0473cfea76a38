import hashlib

import pytest
from pyspark.sql import functions as F

from tablegauge.errors import ValidationError
from tablegauge.operators import split as S


def _orders(spark):
    return spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey", "o_orderstatus")


def test_stratified_counts_exact(spark):
    df = _orders(spark)
    sizes = df.groupBy(F.col("o_orderstatus").alias("s")).agg(F.count("*").alias("n"))
    alloc = {r.s: r.k for r in S.test_allocation(sizes, 0.2, True).collect()}
    out = S.split_train_test(df, keys=["o_orderkey"], test_size=0.2, seed=42, target="o_orderstatus")
    got = {r["class_value"]: r["n"] for r in S.split_distribution(out, "o_orderstatus")
           .where("part = 'test'").collect()}
    assert got == alloc and sum(got.values()) == 3000


def test_same_seed_same_rows_other_seed_other_rows(spark):
    df = _orders(spark)
    a = S.split_train_test(df, keys=["o_orderkey"], test_size=0.2, seed=42, target="o_orderstatus")
    b = S.split_train_test(df, keys=["o_orderkey"], test_size=0.2, seed=42, target="o_orderstatus")
    c = S.split_train_test(df, keys=["o_orderkey"], test_size=0.2, seed=43, target="o_orderstatus")
    ta = {r[0] for r in a.where("part = 'test'").select("o_orderkey").collect()}
    tb = {r[0] for r in b.where("part = 'test'").select("o_orderkey").collect()}
    tc = {r[0] for r in c.where("part = 'test'").select("o_orderkey").collect()}
    assert ta == tb and ta != tc


def test_sample_and_permutation(spark):
    df = _orders(spark)
    s = S.sample_rows(df, keys=["o_orderkey"], n=300, seed=42)
    assert s.count() == 300
    p = S.permute(s, keys=["o_orderkey"], seed=43)
    assert sorted(p.drop("position").collect()) == sorted(s.collect())
    placed = [r.o_orderkey for r in p.orderBy("position").collect()]
    want = sorted(placed, key=lambda k: hashlib.md5(f"43|permute|{k}".encode()).hexdigest())
    assert placed == want != sorted(placed)
    assert sorted(r.position for r in p.collect()) == list(range(300))
    with pytest.raises(ValidationError):
        S.sample_rows(df.limit(10), keys=["o_orderkey"], n=11, seed=1)


def test_split_arguments(spark):
    df = _orders(spark)
    with pytest.raises(ValidationError):
        S.split_train_test(df, keys=["o_orderkey"], test_size=1.5, seed=1, target="o_orderstatus")
    tiny = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k long, t string")
    with pytest.raises(ValidationError):
        S.split_train_test(tiny, keys=["k"], test_size=0.5, seed=1, target="t")
