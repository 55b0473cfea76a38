"""Run history as Parquet, partitioned by experiment, each append once.

Each recorded run is one row: identity, timing, status, numeric metrics
(``MAP<STRING,DOUBLE>``), flattened parameters and tags
(``MAP<STRING,STRING>``), the gate's rows and the confusion matrix.

An append writes its rows below ``data/append=<id>`` and, when they are
there, one row below ``commits/append=<id>``; both are overwritten if the
same append is made again, so a retry after a failure leaves one copy.
Readers take committed appends only.  :func:`compact_runs` rewrites them as
one append whose commit names those that it replaces.  Reading one
experiment prunes the other partitions.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.session import read_if_there

RUNS_SCHEMA = ("run_id string, run_name string, start_time timestamp, status string, "
               "metrics map<string,double>, params map<string,string>, tags map<string,string>, "
               "gate array<struct<metric:string,value:double,minimum_required:double,passed:boolean>>, "
               "confusion array<struct<actual:string,predicted:string,n:bigint>>, experiment string")
_COMMIT_SCHEMA = "replaces array<string>, append string"


def flatten_params(settings: Mapping, prefix: str = "") -> dict[str, str]:
    """Nested settings -> dotted names with text values (None kept)."""
    out: dict[str, str] = {}
    for k, v in settings.items():
        name = f"{prefix}{k}"
        if isinstance(v, Mapping):
            out.update(flatten_params(v, name + "."))
        elif isinstance(v, (list, tuple)):
            out[name] = ",".join(str(x) for x in v)
        else:
            out[name] = None if v is None else str(v)
    return out


def numeric_metrics(metrics: Mapping) -> dict[str, float]:
    """Only numeric metric values are recorded."""
    return {k: float(v) for k, v in metrics.items()
            if isinstance(v, (int, float)) and not isinstance(v, bool)}


def run_record(spark: SparkSession, *, experiment: str, run_name: str, metrics: Mapping,
               params: Mapping, tags: Mapping, status: str = "FINISHED",
               run_id: str | None = None, start_time: dt.datetime | None = None,
               gate: Sequence[Mapping] = (), confusion: Sequence[Mapping] = ()) -> DataFrame:
    """One run as a one-row DataFrame in the runs schema.  ``gate`` and
    ``confusion`` take the rows of the quality gate and of the matrix."""
    row = (run_id or uuid.uuid4().hex, run_name, start_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
           status, numeric_metrics(metrics), {k: (None if v is None else str(v)) for k, v in params.items()},
           {k: str(v) for k, v in tags.items()},
           [(g["metric"], g["value"], g["minimum_required"], g["passed"]) for g in gate],
           [(c["actual"], c["predicted"], c["n"]) for c in confusion], experiment)
    return spark.createDataFrame([row], RUNS_SCHEMA)


def _committed(spark: SparkSession, path: str) -> DataFrame | None:
    """The appends that count: committed and not replaced by another."""
    commits = read_if_there(lambda: spark.read.schema(_COMMIT_SCHEMA).parquet(f"{path.rstrip('/')}/commits"))
    if commits is None:
        return None
    gone = commits.select(F.explode("replaces").alias("append"))
    return commits.select("append").join(gone, "append", "left_anti")


def _commit(commit: DataFrame, path: str, append_id: str) -> None:
    commit.select("replaces").coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/commits/append={append_id}")


def append_runs(runs: DataFrame, path: str, *, append_id: str | None = None) -> str:
    """Add runs to the history at ``path``, once however often it is
    tried.  ``append_id`` names the append; by default it follows from the
    run ids, so the same runs are the same append."""
    spark = runs.sparkSession
    if append_id is None:
        mark = runs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("run_id").cast("decimal(20,0)")).alias("h")).first()
        append_id = f"runs-{mark.n}-{int(mark.h or 0) % (1 << 64):016x}"
    names = spark.createDataFrame([], RUNS_SCHEMA).schema
    rows = runs.select(*[F.col(f.name) if f.name in runs.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in names])
    rows.write.mode("overwrite").partitionBy("experiment").parquet(f"{path.rstrip('/')}/data/append={append_id}")
    _commit(spark.createDataFrame([([],)], "replaces array<string>"), path, append_id)
    return path


def compact_runs(spark: SparkSession, path: str) -> str:
    """Rewrite the history, one row a file after many single appends, as one
    append.  Readers see either the old appends or the new one.  One
    compaction at a time."""
    live = _committed(spark, path)
    if live is None:
        return path
    mark = live.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("append").cast("decimal(20,0)")).alias("h")).first()
    if mark.n < 2:
        return path
    append_id = f"compact-{mark.n}-{int(mark.h) % (1 << 64):016x}"
    _history(spark, path).repartition("experiment").write.mode("overwrite").partitionBy("experiment") \
        .parquet(f"{path.rstrip('/')}/data/append={append_id}")
    _commit(live.agg(F.collect_list("append").alias("replaces")), path, append_id)
    return path


def _history(spark: SparkSession, path: str) -> DataFrame:
    live = _committed(spark, path)
    if live is None:
        return spark.createDataFrame([], RUNS_SCHEMA)
    runs = spark.read.schema(f"{RUNS_SCHEMA}, append string").parquet(f"{path.rstrip('/')}/data")
    return runs.join(live, "append", "left_semi").drop("append")


def load_runs(spark: SparkSession, path: str, experiment: str) -> DataFrame:
    """The runs of one experiment as ranking input columns, newest
    best-F1 first (fetch order).  An unknown experiment gives no rows."""
    runs = _history(spark, path)
    runs = runs.where(F.col("experiment") == experiment)
    flat = runs.select(
        "run_id", F.coalesce(F.col("tags")["run_name"], F.col("run_name")).alias("run_name"),
        "start_time", "status", "experiment",
        F.col("tags")["quality_gate.status"].alias("quality_gate_status"),
        F.col("params")["model.algorithm"].alias("model_algorithm"),
        *[F.col("metrics")[m].alias(m) for m in
          ("f1_pos", "balanced_accuracy", "roc_auc", "precision_pos", "recall_pos", "accuracy")],
        "params", "tags", "gate", "confusion")
    return flat.orderBy(F.desc_nulls_last("f1_pos"), F.desc("start_time"))
