"""Drift monitoring run.

context (validate the table, list features) -> reference / stable / drifted
batches -> optionally write them as CSV and read them back -> compare the
chosen current batch with the reference -> per-feature rows and summary.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tablegauge.operators import drift as D
from tablegauge.operators import prepare as P
from tablegauge.operators import validate as V
from tablegauge.sources.files import read_table, write_in_order, write_report


@dataclass(frozen=True)
class MonitoringContext:
    """What the run knows of the table, all of it from its schema."""
    schema: StructType
    target: str
    kinds: dict[str, str]          # feature -> 'numeric' or 'categorical', in the table's order

    @property
    def feature_columns(self) -> list[str]:
        return list(self.kinds)

    def of_kind(self, kind: str) -> list[str]:
        return [c for c, k in self.kinds.items() if k == kind]


def monitoring_context(df: DataFrame, *, target: str, excluded: Sequence[str] = (),
                       validation: Mapping | None = None) -> MonitoringContext:
    """Validate the table (when ``validation`` rule arguments are given) and
    tell its features' kinds."""
    if validation is not None:
        V.enforce(V.validate_dataset(df, target=target, excluded_columns=list(excluded), **validation))
    feats = P.feature_columns(df, target, list(excluded))
    numeric = set(P.feature_types(df, feats)[0])
    return MonitoringContext(df.schema, target, {c: "numeric" if c in numeric else "categorical" for c in feats})


@dataclass
class MonitoringResult:
    context: MonitoringContext
    batches: D.MonitoringBatches
    features: DataFrame
    summary: DataFrame
    paths: dict[str, str] | None = None


def run_monitoring(df: DataFrame, *, keys: Sequence[str], target: str, size: int, seed: int,
                   settings: Mapping, current: str = "stable", excluded: Sequence[str] = (),
                   feature_threshold: float = 0.5, share_threshold: float = 0.15,
                   allowed_target_values: Sequence[str] | None = None,
                   validation: Mapping | None = None, persist_dir: str | None = None,
                   order: Sequence | None = None) -> MonitoringResult:
    """Build the batches, optionally persist them (CSV with header, rows
    in the batch's order, read back with the original schema) with a JSON summary, and compare ``current`` ('stable' or
    'drifted') with the reference batch."""
    if current not in D.BATCH_NAMES:
        raise V.ValidationError(f"current batch must be one of {D.BATCH_NAMES}, got '{current}'")
    ctx = monitoring_context(df, target=target, excluded=excluded, validation=validation)
    batches = D.monitoring_batches(df, keys=keys, size=size, seed=seed, settings=settings, target=target, order=order)
    ref, cur = batches.reference, D.choose_batch(batches, current)
    paths = None
    if persist_dir:
        base = persist_dir.rstrip("/")
        paths = {}
        for name, frame in batches.placed.items():
            paths[name] = write_in_order(frame, f"{base}/{name}_batch.csv", position_col=batches.position, fmt="csv")
        ref = read_table(df.sparkSession, paths["reference"], fmt="csv", schema=batches.reference.schema)
        cur = read_table(df.sparkSession, paths[current], fmt="csv", schema=batches.reference.schema)
    feats, summary = D.compare_batches(
        ref, cur, features=ctx.feature_columns, numeric=ctx.of_kind("numeric"),
        feature_threshold=feature_threshold, share_threshold=share_threshold,
        column_order=ctx.schema.names, target=target, allowed_target_values=allowed_target_values)
    if persist_dir:
        write_report(D.drift_report(feats, summary, {k: paths[k] for k in ("reference", current)}), f"{base}/drift_summary.json")
    return MonitoringResult(ctx, batches, feats, summary, paths)
