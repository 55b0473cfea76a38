"""H2 — running sums over sorted values without a one-task window.

A cumulative window over a whole table (``sum(...) OVER (ORDER BY v)``)
runs in a single task.  Here the data is first collapsed to one row per
distinct ``(group, value)`` — heavy ties cost nothing — then range
partitioned on ``(group, value)``.  Inside each range partition a window
computes *local* running sums; each partition also emits a few partial
aggregates.  A tiny table of per-partition partials (at most partitions x
groups rows) gives every partition its offset, and the global statistic is
combined from the partials.  The whole computation is one lazy plan: the
range exchange is evaluated once, so partition ids are consistent.

Products of counts are exact 38-digit integers, so that the final statistic
is one exact ratio (identical to an ordinary cumulative-window query in SQL)
for up to 10^18 rows a side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablegauge.errors import ValidationError, refuse
from tablegauge.functions.columns import fresh
from tablegauge.session import default_parallelism, ensure_checkpoint_dir


def _parts(spark: SparkSession, num: int | None) -> int:
    return max(1, int(num or default_parallelism(spark)))


def _wide(c: Column) -> Column:
    """A count as a decimal: the product of two is exact."""
    return c.cast("decimal(19,0)")


def ks_distance(counts: DataFrame, group: str, value: str, n_ref: str, n_cur: str,
                num_partitions: int | None = None) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov distance per group.

    ``counts`` holds one row per distinct ``(group, value)`` with the number
    of reference and current observations at that value.  Returns
    ``(group, statistic, n_ref, n_cur)`` where ``statistic`` is
    ``max_v |F_ref(v) - F_cur(v)|`` as the exact ratio
    ``max |cum_ref*N_cur - cum_cur*N_ref| / (N_ref*N_cur)``.
    """
    spark = counts.sparkSession
    p = _parts(spark, num_partitions)
    totals = counts.groupBy(group).agg(F.sum(n_ref).alias("_N_ref"), F.sum(n_cur).alias("_N_cur"))
    ranged = (counts.repartitionByRange(p, F.col(group), F.col(value))
              .withColumn("_pid", F.spark_partition_id()))
    w = (Window.partitionBy("_pid", group).orderBy(value)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = (ranged
             .join(F.broadcast(totals), group)  # one row per group
             .withColumn("_lr", F.sum(n_ref).over(w))
             .withColumn("_lc", F.sum(n_cur).over(w))
             .withColumn("_d", _wide(F.col("_lr")) * _wide(F.col("_N_cur")) - _wide(F.col("_lc")) * _wide(F.col("_N_ref"))))
    partials = local.groupBy("_pid", group).agg(
        F.sum(n_ref).alias("_tr"), F.sum(n_cur).alias("_tc"),
        F.max("_d").alias("_dmax"), F.min("_d").alias("_dmin"),
        F.first("_N_ref").alias("_N_ref"), F.first("_N_cur").alias("_N_cur"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = (partials
            .withColumn("_or", F.coalesce(F.sum("_tr").over(before), F.lit(0)))
            .withColumn("_oc", F.coalesce(F.sum("_tc").over(before), F.lit(0)))
            .withColumn("_c", _wide(F.col("_or")) * _wide(F.col("_N_cur")) - _wide(F.col("_oc")) * _wide(F.col("_N_ref"))))
    return (offs.groupBy(group)
            .agg(F.max(F.greatest(F.abs(F.col("_c") + F.col("_dmax")),
                                  F.abs(F.col("_c") + F.col("_dmin")))).alias("_num"),
                 F.first("_N_ref").alias("n_ref"), F.first("_N_cur").alias("n_cur"))
            .select(group,
                    (F.col("_num").cast("double") / (_wide(F.col("n_ref")) * _wide(F.col("n_cur"))).cast("double")).alias("statistic"),
                    "n_ref", "n_cur"))


def roc_auc_counts(counts: DataFrame, score: str, pos: str, neg: str,
                   num_partitions: int | None = None) -> DataFrame:
    """Exact ROC AUC with ties from per-score counts.

    ``counts`` has one row per distinct score with its positive and negative
    counts.  AUC = sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N), returned
    as one row ``(auc, n_pos, n_neg)``; ``auc`` is NULL when a class is absent.
    """
    spark = counts.sparkSession
    p = _parts(spark, num_partitions)
    ranged = counts.repartitionByRange(p, F.col(score)).withColumn("_pid", F.spark_partition_id())
    w = (Window.partitionBy("_pid").orderBy(score)
         .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumn("_nb", F.coalesce(F.sum(neg).over(w), F.lit(0)))
    partials = local.groupBy("_pid").agg(
        F.sum(pos).alias("_tp"), F.sum(neg).alias("_tn"),
        # twice the within-partition numerator, integer valued
        F.sum(_wide(F.col(pos)) * (2 * _wide(F.col("_nb")) + _wide(F.col(neg))).cast("decimal(20,0)")).alias("_in2"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # `partials` has one row per range partition: a bounded table
    offs = partials.withColumn("_on", F.coalesce(F.sum("_tn").over(before), F.lit(0)))
    agg = offs.agg(F.sum(F.col("_in2") + (2 * _wide(F.col("_on"))).cast("decimal(20,0)") * _wide(F.col("_tp"))).alias("_num2"),
                   F.sum("_tp").alias("n_pos"), F.sum("_tn").alias("n_neg"))
    return agg.select(
        F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
               F.col("_num2").cast("double") / (2.0 * (_wide(F.col("n_pos")) * _wide(F.col("n_neg"))).cast("double"))).alias("auc"),
        F.coalesce("n_pos", F.lit(0)).alias("n_pos"),
        F.coalesce("n_neg", F.lit(0)).alias("n_neg"))


def global_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """1-based position of every row in a total order, computed per range
    partition plus per-partition offsets.  The range-partitioned table is
    checkpointed to the session's shared checkpoint folder first so that the
    partition assignment used for the offsets and for the local ranks is the
    same even if tasks are retried."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    p = _parts(spark, num_partitions)
    (pid,) = fresh(df, "range_part")
    ranged = df.repartitionByRange(p, *order).withColumn(pid, F.spark_partition_id()).checkpoint(eager=True)
    # one row for each range partition
    sizes = {r[0]: r[1] for r in ranged.groupBy(pid).agg(F.count(F.lit(1)).alias("n")).collect()}
    off, acc = {}, 0
    for i in sorted(sizes):
        off[i] = acc
        acc += sizes[i]
    offset = (F.create_map(*[x for k, v in off.items() for x in (F.lit(k), F.lit(v))])
              if off else F.create_map(F.lit(0), F.lit(0)))
    w = Window.partitionBy(pid).orderBy(*order)
    return ranged.withColumn(rank_col, (offset[F.col(pid)] + F.row_number().over(w)).cast("long")).drop(pid)


def in_order(df: DataFrame, order: Sequence[Column | str], position_col: str = "position") -> DataFrame:
    """The rows with their 0-based place in a total order, from a
    range-partitioned sort and the partitions' offsets.  A column called
    like ``position_col`` is refused, not replaced."""
    refuse(ValidationError, position_col=(position_col in df.columns, f"the table has a column {position_col!r} of its own"))
    cols = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order]
    return global_rank(df, cols, position_col).withColumn(position_col, F.col(f"`{position_col}`") - 1)
