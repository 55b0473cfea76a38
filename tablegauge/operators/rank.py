"""Run ranking.

A run table holds one row per training run: ``run_id``, ``run_name``,
``quality_gate_status``, ``model_algorithm``, the metric columns (numbers
or text) and optionally a ``params`` map.  Ranking coerces metrics to
doubles (bad text -> NULL), keeps the runs that passed their gate — or all
runs when none passed — and orders them by six metrics descending, then
name and id ascending, NULLs last everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.functions.prefix import global_rank
from tablegauge.sources.files import write_report

# Ranking keys (metric column, ranked column), in order.
RANK_METRICS = (
    ("f1_pos", "metric_f1"),
    ("balanced_accuracy", "metric_balanced_accuracy"),
    ("roc_auc", "metric_roc_auc"),
    ("precision_pos", "metric_precision"),
    ("recall_pos", "metric_recall"),
    ("accuracy", "metric_accuracy"),
)
IMPORTANT_PARAMS = ("model.class_weight", "model.max_iter", "split.test_size", "split.stratify")


def prepare_runs(runs: DataFrame) -> DataFrame:
    """Eligibility (NULL status counts as failed), numeric metrics by
    ``try_cast`` (text that is not a number becomes NULL) and sort keys."""
    out = runs.withColumn("eligible", F.coalesce(F.col("quality_gate_status"), F.lit("failed")) == "passed")
    for src, dst in RANK_METRICS:
        c = F.col(f"`{src}`") if src in runs.columns else F.lit(None)
        out = out.withColumn(dst, F.expr(f"try_cast(`{src}` AS DOUBLE)") if src in runs.columns
                             else c.cast("double"))
    return (out.withColumn("_sort_name", F.coalesce(F.col("run_name").cast("string"), F.lit("")))
            .withColumn("_sort_id", F.coalesce(F.col("run_id").cast("string"), F.lit(""))))


def rank_order() -> list[Column]:
    return ([F.desc_nulls_last(dst) for _, dst in RANK_METRICS]
            + [F.asc_nulls_last("_sort_name"), F.asc_nulls_last("_sort_id")])


def eligible_runs(runs: DataFrame) -> DataFrame:
    """The runs that passed; all runs when none passed (the test is a
    scalar subquery, not a window over the whole table)."""
    p = prepare_runs(runs)
    any_ok = p.select(F.coalesce(F.max(F.col("eligible").cast("int")), F.lit(0))).scalar()
    return p.where(F.col("eligible") | (any_ok == 0))


def rank_runs(runs: DataFrame, *, rank_col: str = "rank") -> DataFrame:
    """Eligible runs with a 1-based ``rank`` in ranking order (computed
    per range partition with offsets, no single-task window)."""
    ranked = global_rank(eligible_runs(runs), rank_order(), rank_col)
    return ranked.drop("_sort_name", "_sort_id")


def best_run(runs: DataFrame) -> DataFrame:
    """R2: the first run in ranking order (top-1, ``TakeOrderedAndProject``);
    empty when there is no run."""
    return eligible_runs(runs).orderBy(*rank_order()).limit(1).drop("_sort_name", "_sort_id")


def comparison_rows(ranked: DataFrame) -> DataFrame:
    """The comparison projection of ranked runs, with the important
    parameters as a struct."""
    params = F.col("params") if "params" in ranked.columns else F.create_map().cast("map<string,string>")
    imp = F.struct(*[params[F.lit(k)].alias(k) for k in IMPORTANT_PARAMS])
    return ranked.select(
        *([F.col("rank")] if "rank" in ranked.columns else []),
        "run_id", "run_name", "model_algorithm", "quality_gate_status",
        *[F.col(dst).alias(src) for src, dst in RANK_METRICS],
        imp.alias("important_parameters"), "eligible")


def flatten_parameters(cmp: DataFrame, names: Sequence[str] = IMPORTANT_PARAMS) -> DataFrame:
    """The struct of important parameters as plain columns (``param_…``)."""
    cols = [c for c in cmp.columns if c != "important_parameters"]
    return cmp.select(*cols, *[F.col("important_parameters").getField(k)
                               .alias("param_" + k.replace(".", "_")) for k in names])


def write_comparison(runs: DataFrame, folder: str) -> dict[str, str]:
    """The ranked comparison as JSON and as CSV, and one summary row with
    the number of runs and the best one (null for an empty history, which
    leaves a CSV of the header alone).  Returns the three paths."""
    rows = comparison_rows(rank_runs(runs)).orderBy("rank")
    kept = runs.sparkSession.read.schema(rows.schema).json(write_report(rows, f"{folder.rstrip('/')}/comparison.json"))
    best = F.min_by(F.struct(*kept.columns), F.col("rank"))
    summary = kept.agg(F.count(F.lit(1)).alias("runs"), best.alias("best_run"))
    # as text, so that an absent best run is written as such
    summary = summary.select("runs", F.to_json("best_run").alias("best_run"))
    base = folder.rstrip("/")
    return {"json": f"{base}/comparison.json", "csv": write_report(kept.orderBy("rank"), f"{base}/comparison.csv", fmt="csv"),
            "summary": write_report(summary, f"{base}/summary.json")}
