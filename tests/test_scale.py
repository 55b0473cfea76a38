"""State that grows with the data stays out of the driver; names of users' columns survive."""
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from tablegauge.errors import ValidationError
from tablegauge.functions import hashrank, prefix
from tablegauge.operators import drift as D
from tablegauge.operators import prepare as P
from tablegauge.operators import split as S
from tablegauge.sources.files import read_table, write_in_order

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def in_small_driver(code: str, memory: str = "1g") -> str:
    """Run code in a session of its own, with ``spark`` and a driver of ``memory``."""
    start = f"""
        import sys, tempfile
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import functions as F
        from tablegauge.session import get_session
        spark = get_session("local[4]", shuffle_partitions=16, extra={{"spark.driver.memory": "{memory}",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tg-test-ckpt-")}})
        limit = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
        assert limit <= 1100 << 20, limit
    """
    env = {k: v for k, v in os.environ.items() if k not in ("PYSPARK_SUBMIT_ARGS", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(start) + textwrap.dedent(code)], capture_output=True, text=True, timeout=600, env=env)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


def test_two_million_strata_in_a_small_driver():
    out = in_small_driver("""
        from tablegauge.operators import split as S
        df = spark.range(0, 4_000_000).withColumn("c", F.col("id") % 2_000_000)
        part = S.split_train_test(df, keys=["id"], test_size=0.5, seed=1, target="c")
        per = part.where("part = 'test'").groupBy("c").count().agg(F.count("*"), F.min("count"), F.max("count")).first()
        print(tuple(per))
    """)
    assert out.strip().splitlines()[-1] == "(2000000, 1, 1)"


def test_source_files_hold_no_collect_of_strata():
    text = open(hashrank.__file__).read()
    assert ".collect()" not in text and "toPandas" not in text


#: Every column name that the core uses inside, all at once.
INNER = ["s", "h", "t", "n", "b", "p", "r", "k", "rn", "same", "at", "asked", "stratum", "limit_of", "limit", "pick", "range_part",
         "position", "part", "place", "place0", "place1", "place2", "place3", "_stratum", "_limit", "__test", "__pick", "_pid", "value",
         "feature", "side", "label"]


@pytest.mark.parametrize("classes", [4, 400])
def test_inner_names_are_users_names_too(spark, tmp_path, classes):
    df = spark.range(0, 2400).select(F.col("id"), (F.col("id") % classes).cast("string").alias("_stratum"),
                                     *[F.concat(F.lit(c), F.col("id") % 11).alias(c) for c in INNER if c != "_stratum"])
    want = sorted(map(tuple, df.collect()))

    def same(out):
        return sorted(map(tuple, out.select(*df.columns).collect())) == want
    with pytest.raises(ValidationError, match="part_col"):
        S.split_train_test(df, keys=["id"], test_size=0.25, seed=1, target="_stratum")
    out = S.split_train_test(df, keys=["id"], test_size=0.25, seed=1, target="_stratum", part_col="half")
    assert same(out) and out.where("half = 'test'").groupBy("_stratum").count().agg(F.min("count"), F.max("count")).first() == \
        (600 // classes, -(-600 // classes))
    assert same(S.sample_rows(df, keys=["id"], n=2400, seed=1))
    with pytest.raises(ValidationError, match="position_col"):
        S.permute(df, keys=["id"], seed=1)
    placed = S.permute(df, keys=["id"], seed=1, position_col="at_place")
    assert same(placed) and placed.agg(F.count_distinct("at_place"), F.min("at_place"), F.max("at_place")).first() == (2400, 0, 2399)
    batches = D.monitoring_batches(df.withColumn("x", F.col("id") * 1.5), keys=["id"], size=2400, seed=1, target="_stratum",
                                   settings={"x": {"kind": "numeric", "transform": "add", "magnitude": 1}})
    assert batches.position == "position_" and same(batches.reference) and same(batches.stable) and same(batches.drifted)
    holes, _ = P.inject_missing(df.withColumn("x", F.col("id") * 1.5), keys=["id"], fraction=0.1, seed=1, protected=["_stratum"],
                                strategy="selected_columns", columns=["x", "s"])
    assert holes.where("x is null").count() == holes.where("s is null").count() == 240 and same(holes.withColumn("s", F.concat(F.lit("s"), F.col("id") % 11)))
    write_in_order(placed, f"{tmp_path}/p.csv", position_col="at_place", fmt="csv")
    back = read_table(spark, f"{tmp_path}/p.csv", fmt="csv", schema=df.schema, position_col="at_place")
    assert same(back) and sorted(map(tuple, back.select("id", "at_place").collect())) == sorted(map(tuple, placed.select("id", "at_place").collect()))


def test_written_order_over_many_files(spark, tmp_path):
    df = prefix.in_order(spark.range(0, 5000).withColumn("x", F.col("id") * 2), [F.desc("id")])
    for fmt in ("parquet", "csv"):
        write_in_order(df.repartition(7), f"{tmp_path}/t.{fmt}", fmt=fmt)
        back = read_table(spark, f"{tmp_path}/t.{fmt}", fmt=fmt, schema="id long, x long", position_col="at")
        assert [r.id for r in back.orderBy("at").collect()] == list(range(4999, -1, -1))


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b\n1,"two\nlines"\n2,one\n')
    got = read_table(spark, str(tmp_path / "q.csv"), multi_line=True).collect()
    assert [tuple(r) for r in got] == [(1, "two\nlines"), (2, "one")]


def test_two_million_categories_in_a_small_driver():
    out = in_small_driver("""
        from tablegauge.operators import prepare as P
        df = spark.range(0, 4_000_000).select("id", (F.col("id") * 0.5).alias("x"), F.concat(F.lit("v"), F.col("id") % 2_000_000).alias("c"))
        spec = P.fit_features(df, ["x"], ["c"], keep=["id"])
        one = spec.transform(df.where("id % 1000000 = 7")).orderBy("id").collect()
        names = {r.position: r.feature_name for r in spec.names(spark).where(F.col("position").isin([int(i) for r in one for i in r.features.indices])).collect()}
        print(spec.categories.width, [(r.id, r.features.size, [names[int(i)] for i in r.features.indices]) for r in one])
    """)
    want = [(i, 2_000_001, ["numeric__x", f"categorical__c_v{i % 2_000_000}"]) for i in range(7, 4_000_000, 1_000_000)]
    assert out.strip().splitlines()[-1] == f"[2000000] {want}"
