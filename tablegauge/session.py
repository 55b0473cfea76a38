"""Session helpers: a tuned local/cluster session and shared scratch paths.

On a cluster the session is created by the platform; these helpers only
fill in settings that are unset, so they are safe to call on any session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # broadcast only what a plan proves small; keep the default threshold explicit
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_session(master: str | None = None, app: str = "tablegauge",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session or build one with sensible defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder configured for this session, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder (``spark.checkpoint.dir``, a
    folder shared by the cluster).  Only a local-mode session (tests,
    single-machine runs) gets a temporary folder when none is set; on a
    cluster an unset folder is an error, never a machine-local path."""
    d = checkpoint_dir(spark)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="tablegauge-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tablegauge-scratch/{uuid.uuid4().hex}/{name}"


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover
        return os.cpu_count() or 8


def read_if_there(load):
    """What ``load`` reads, or None where Spark finds no such path; any
    other failure is raised.  Spark resolves the path, with or without a
    scheme, never the driver's own disk."""
    from pyspark.errors import AnalysisException
    try:
        return load()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
