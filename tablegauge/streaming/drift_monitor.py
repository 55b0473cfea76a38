"""Drift monitoring of arriving batch files with Structured Streaming.

The batch operator (:func:`tablegauge.operators.drift.compare_batches`)
compares one current batch with a reference batch.  Here every micro-batch
of a file stream — each new batch file dropped into a folder — is compared
with the same reference, and one summary row per micro-batch is appended to
a Parquet table partitioned by ``batch_id``.  Each batch overwrites its own
partition, so a replayed batch (after a failure, with the stream's
checkpoint in the shared checkpoint folder) leaves exactly one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.operators.drift import compare_batches
from tablegauge.session import ensure_checkpoint_dir, scratch_path


def start_drift_monitor(spark: SparkSession, reference: DataFrame, source_dir: str, *,
                        schema: T.StructType, features: Sequence[str], feature_threshold: float,
                        share_threshold: float, sink_path: str, fmt: str = "parquet",
                        checkpoint: str | None = None, available_now: bool = False,
                        max_files_per_trigger: int = 1):
    """Start the monitor; returns the ``StreamingQuery``.

    Each micro-batch (``max_files_per_trigger`` files) is one current batch.
    The summary rows carry ``batch_id`` and the number of rows compared."""
    feats = list(features)
    # the reference is compared with every micro-batch: write it once to the
    # shared checkpoint folder instead of recomputing it from its source
    ensure_checkpoint_dir(spark)
    reference = reference.checkpoint(eager=True)
    stream = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .option("header", True)
              .load(source_dir))

    def compare(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        _, summary = compare_batches(reference, batch, features=feats,
                                     feature_threshold=feature_threshold,
                                     share_threshold=share_threshold)
        # one folder per batch id, overwritten on retry: replays are idempotent
        (summary.withColumn("current_rows", F.lit(batch.count()).cast("long"))
         .write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}"))

    writer = (stream.writeStream.foreachBatch(compare)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "drift-monitor-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def run_drift_monitor_once(spark: SparkSession, reference: DataFrame, source_dir: str, **kw) -> DataFrame:
    """Process every file present now (``availableNow``) and return the
    summary table."""
    sink = kw.pop("sink_path", None) or scratch_path(spark, "drift-monitor-out")
    q = start_drift_monitor(spark, reference, source_dir, sink_path=sink, available_now=True, **kw)
    q.awaitTermination()
    return spark.read.parquet(sink)
