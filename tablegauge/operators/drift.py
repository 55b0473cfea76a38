"""Drift monitoring (D1–D15): monitoring batches, drift transforms,
per-feature two-sample tests, drifted features, share and gate.

Scores behave like p-values (lower = more drifted):

* numeric features — two-sample Kolmogorov–Smirnov; the distance comes
  from one plan over ``(feature, value)`` counts with range-partitioned
  prefix sums (:func:`tablegauge.functions.prefix.ks_distance`), the
  p-value from the asymptotic series (a column expression);
* categorical features — chi-square test of the category x batch table;
  statistic and degrees of freedom from one grouped aggregate, p-value
  from the chi-square survival function, a column expression too.

NULLs are dropped per feature.  A feature without a score counts as 1.0,
i.e. not drifted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tablegauge.errors import ValidationError, refuse
from tablegauge.functions.columns import fresh, is_integral, is_numeric, present
from tablegauge.functions.prefix import in_order, ks_distance
from tablegauge.functions.stats import KS_EXACT_ROWS, chi2_sf, ks_exact, ks_pvalue
from tablegauge.operators.split import permute, sample_rows
from tablegauge.session import ensure_checkpoint_dir


# ---------------------------------------------------------------- transforms
@dataclass(frozen=True)
class FeatureDrift:
    """One simulated drift: numeric ``add`` / ``scale`` by ``magnitude`` with
    optional clipping, or categorical ``set_constant`` to ``value``."""
    kind: str
    transform: str
    magnitude: float | None = None
    value: object = None
    clip_min: float | None = None
    clip_max: float | None = None

    @staticmethod
    def of(spec: Mapping | "FeatureDrift") -> "FeatureDrift":
        if isinstance(spec, FeatureDrift):
            return spec
        return FeatureDrift(spec.get("kind"), spec.get("transform"), spec.get("magnitude"),
                            spec.get("value"), spec.get("clip_min"), spec.get("clip_max"))


def _clip(x: Column, lo, hi) -> Column:
    y = x
    if lo is not None:
        y = F.greatest(F.lit(float(lo)), y)
    if hi is not None:
        y = F.least(F.lit(float(hi)), y)
    # greatest/least skip NULLs: keep missing values missing
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(y)


def _shifted(moved):
    """A numeric transform: move in double, clip, back to whole numbers where the column holds them."""
    def build(name: str, spec: FeatureDrift, dt) -> Column:
        refuse(ValidationError, **{name: (spec.magnitude is None, "a numeric drift needs a magnitude")})
        x = moved(F.col(f"`{name}`").cast("double"), F.lit(float(spec.magnitude)))  # no number in a text raises under ANSI
        x = _clip(x, spec.clip_min, spec.clip_max)
        return F.bround(x, 0).cast(dt) if is_integral(dt) else x
    return build


#: What a drift of a kind does to a column.
_TRANSFORMS = {
    ("numeric", "add"): _shifted(lambda x, m: x + m),
    ("numeric", "scale"): _shifted(lambda x, m: x * m),
    ("categorical", "set_constant"): lambda name, spec, dt: F.lit(spec.value).cast(dt),
}


def apply_drift(batch: DataFrame, settings: Mapping[str, Mapping | FeatureDrift],
                target: str | None = None) -> DataFrame:
    """Apply per-feature drift as one projection.  Integer columns are
    rounded half-to-even and cast back; the target is never touched."""
    specs = {f: FeatureDrift.of(s) for f, s in settings.items()}
    types = {f.name: f.dataType for f in batch.schema.fields}
    refuse(ValidationError, **{f: (f not in types or f == target or (s.kind, s.transform) not in _TRANSFORMS,
                                   f"no such column, the target, or no transform {s.kind}/{s.transform}") for f, s in specs.items()})
    moved = {f: _TRANSFORMS[s.kind, s.transform](f, s, types[f]) for f, s in specs.items()}
    return batch.select(*[moved[c].alias(c) if c in moved else F.col(f"`{c}`") for c in batch.columns])


@dataclass
class MonitoringBatches:
    """Three batches of the same rows.  ``placed`` holds each with its rows'
    places (``position``, under another name if the table has one)."""
    placed: dict[str, DataFrame]
    position: str

    @property
    def reference(self) -> DataFrame:
        return self.placed["reference"].drop(self.position)

    @property
    def stable(self) -> DataFrame:
        return self.placed["stable"].drop(self.position)

    @property
    def drifted(self) -> DataFrame:
        return self.placed["drifted"].drop(self.position)

    def union(self, batch_col: str = "batch") -> DataFrame:
        out = None
        for name, frame in self.placed.items():
            named = frame.withColumn(batch_col, F.lit(name))
            out = named if out is None else out.unionByName(named)
        return out


def monitoring_batches(df: DataFrame, *, keys: Sequence[str], size: int, seed: int,
                       settings: Mapping[str, Mapping | FeatureDrift], target: str | None = None,
                       production_size: int | None = None, order: Sequence[Column | str] | None = None) -> MonitoringBatches:
    """reference = seeded sample of ``size`` rows, in the table's order
    (``order``, by default the keys); stable = the same rows permuted by
    ``seed + 1``; drifted = stable with the drift applied, in its order.
    Sizes must match and fit the table."""
    if production_size is not None and production_size != size:
        raise ValidationError("reference and production batch sizes must match")
    refuse(ValidationError, settings=(target in settings, f"the target {target!r} does not drift"))
    # kept once: everything else reads these rows and not the table
    ensure_checkpoint_dir(df.sparkSession)
    (place,) = fresh(df, "position")
    rows = sample_rows(df, keys=keys, n=size, seed=seed)
    ref = in_order(rows, list(order or keys), place).checkpoint(eager=True)
    stable = permute(ref.drop(place), keys=keys, seed=seed + 1, position_col=place)
    return MonitoringBatches({"reference": ref, "stable": stable, "drifted": apply_drift(stable, settings, target)}, place)


def target_mismatches(before: DataFrame, after: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """D8 check: rows of ``(keys, target)`` that differ between two batches
    (``exceptAll`` both ways, a shuffle on the key columns)."""
    a = before.select(*keys, target)
    b = after.select(*keys, target)
    diff = a.exceptAll(b).unionByName(b.exceptAll(a))
    return diff.agg(F.count(F.lit(1)).alias("mismatched_rows"))


# ---------------------------------------------------------------- scores
def _long(df: DataFrame, features: Sequence[str], side: int, as_type: str) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), present(c, types[c]).cast(as_type).alias("value")) for c in features
    ])).alias("x")).select("x.feature", "x.value", F.lit(side).alias("side")) \
        .where(F.col("value").isNotNull())


def _side_counts(ref: DataFrame, cur: DataFrame, features: Sequence[str], as_type: str) -> DataFrame:
    both = _long(ref, features, 0, as_type).unionByName(_long(cur, features, 1, as_type))
    return both.groupBy("feature", "value").agg(
        F.sum((F.col("side") == 0).cast("long")).alias("n_ref"),
        F.sum((F.col("side") == 1).cast("long")).alias("n_cur"))


def ks_scores(ref: DataFrame, cur: DataFrame, features: Sequence[str],
              num_partitions: int | None = None, exact_small: bool = True) -> DataFrame:
    """``(feature, statistic, p_value, n_ref, n_cur)`` per numeric
    feature; the p-value is exact for samples of up to ``KS_EXACT_ROWS``
    rows.  Where samples are known to be larger, ``exact_small=False``
    spares the Python worker; the values are the same."""
    if not features:
        return ref.sparkSession.createDataFrame(
            [], "feature string, statistic double, p_value double, n_ref long, n_cur long")
    counts = _side_counts(ref, cur, features, "double")
    d = ks_distance(counts, "feature", "value", "n_ref", "n_cur", num_partitions)
    p = ks_pvalue(F.col("statistic"), F.col("n_ref"), F.col("n_cur"))
    if exact_small:
        small = F.greatest("n_ref", "n_cur") <= KS_EXACT_ROWS
        # sizes that the series serves go to the path count as NULL
        p = F.coalesce(_ks_exact(*[F.when(small, F.col(c)) for c in ("statistic", "n_ref", "n_cur")]), p)
    return d.select("feature", "statistic", p.alias("p_value"), "n_ref", "n_cur")


@F.pandas_udf(DoubleType())
def _ks_exact(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(x) else ks_exact(x, int(a), int(b)) for x, a, b in zip(d, n, m)], dtype="float64")


def chi2_statistics(ref: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """D10 statistic: ``(feature, statistic, dof, categories)`` per
    categorical feature, from the category x batch count table."""
    counts = _side_counts(ref, cur, features, "string")
    tot = counts.groupBy("feature").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"),
                                        F.count(F.lit(1)).alias("categories"))
    j = counts.join(F.broadcast(tot), "feature")   # one row per feature
    # products of counts as exact 38-digit integers
    n = (F.col("tot_ref") + F.col("tot_cur")).cast("double")
    both = (F.col("n_ref") + F.col("n_cur")).cast("decimal(19,0)")
    e_ref = (F.col("tot_ref").cast("decimal(19,0)") * both).cast("double") / n
    e_cur = (F.col("tot_cur").cast("decimal(19,0)") * both).cast("double") / n
    term = (F.pow(F.col("n_ref") - e_ref, 2) / e_ref) + (F.pow(F.col("n_cur") - e_cur, 2) / e_cur)
    stat = j.groupBy("feature").agg(
        F.sum(term).alias("statistic"), F.first("categories").alias("categories"),
        F.first("tot_ref").alias("n_ref"), F.first("tot_cur").alias("n_cur"))
    valid = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    return stat.select(
        "feature",
        F.when(valid, F.col("statistic")).alias("statistic"),
        F.when(valid, F.col("categories") - 1).cast("long").alias("dof"),
        "categories", "n_ref", "n_cur")


def chi2_scores(ref: DataFrame, cur: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, statistic, p_value, dof)``, one lazy plan."""
    if not features:
        return ref.sparkSession.createDataFrame([], "feature string, statistic double, p_value double, dof long")
    return chi2_statistics(ref, cur, features).select(
        "feature", "statistic", chi2_sf(F.col("statistic"), F.col("dof")).alias("p_value"), "dof")


def drift_scores(ref: DataFrame, cur: DataFrame, features: Sequence[str],
                 numeric: Sequence[str] | None = None) -> DataFrame:
    """Scores of every feature ``(feature, position, kind, statistic,
    score)``; ``numeric`` defaults to the numeric columns among
    ``features`` (booleans included)."""
    types = {f.name: f.dataType for f in ref.schema.fields}
    num = list(numeric) if numeric is not None else [
        c for c in features if is_numeric(types[c], include_bool=True)]
    cat = [c for c in features if c not in num]
    ks = ks_scores(ref, cur, num).select("feature", F.lit("numeric").alias("kind"),
                                         "statistic", F.col("p_value").alias("score"))
    ch = chi2_scores(ref, cur, cat).select("feature", F.lit("categorical").alias("kind"),
                                           "statistic", F.col("p_value").alias("score"))
    return ks.unionByName(ch)


# ---------------------------------------------------------------- decision
def _feature_frame(spark, features: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(c, i) for i, c in enumerate(features)],
                                 "feature string, position long")


def drifted_features(scores: DataFrame, features: Sequence[str], threshold: float) -> DataFrame:
    """``(feature, position, score, drifted)`` for every feature in
    order; a feature without a score counts as 1.0; drifted when
    ``score < threshold`` (strict)."""
    feats = _feature_frame(scores.sparkSession, features)
    j = feats.join(scores.select("feature", "score"), "feature", "left")
    s = F.coalesce(F.col("score"), F.lit(1.0))
    return j.select("feature", "position", s.alias("score"), (s < F.lit(float(threshold))).alias("drifted"))


def drift_gate(features: DataFrame, share_threshold: float) -> DataFrame:
    """One row ``(evaluated_feature_count, drifted_feature_count,
    drifted_feature_share, dataset_drift, gate_status)``; the dataset
    drifts when the share is at least the threshold."""
    agg = features.agg(F.count(F.lit(1)).alias("evaluated_feature_count"),
                       F.coalesce(F.sum(F.col("drifted").cast("long")), F.lit(0)).alias("drifted_feature_count"))
    share = F.coalesce(F.try_divide(F.col("drifted_feature_count").cast("double"),
                                    F.col("evaluated_feature_count").cast("double")), F.lit(0.0))
    return agg.select("evaluated_feature_count", "drifted_feature_count",
                      share.alias("drifted_feature_share"),
                      (share >= F.lit(float(share_threshold))).alias("dataset_drift"),
                      F.when(share >= F.lit(float(share_threshold)), "failed").otherwise("passed")
                      .alias("gate_status"))


_SUMMARY_SCHEMA = ("evaluated_feature_count long, drifted_feature_count long, drifted_feature_share double, "
                   "dataset_drift boolean, gate_status string, drifted_feature_names string, "
                   "configured_threshold double, feature_threshold double")


def drift_summary(features: DataFrame, *, feature_threshold: float, share_threshold: float) -> DataFrame:
    """The gate row plus thresholds and the drifted feature names in
    feature order (comma separated).  The feature table has one row per
    feature, so it is evaluated once and the summary built from it."""
    rows = sorted(features.select("feature", "position", "drifted").collect(), key=lambda r: r["position"])
    evaluated = len(rows)
    names = [r["feature"] for r in rows if r["drifted"]]
    share = len(names) / evaluated if evaluated else 0.0
    drift = share >= float(share_threshold)
    return features.sparkSession.createDataFrame(
        [(evaluated, len(names), share, drift, "failed" if drift else "passed", ",".join(names),
          float(share_threshold), float(feature_threshold))], _SUMMARY_SCHEMA)


def drift_report(features: DataFrame, summary: DataFrame, paths: Mapping[str, str] | None = None) -> DataFrame:
    """The summary row with every feature's score and the paths of the
    batches compared, ready to be written as JSON."""
    scores = features.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "score")))).alias("s"))
    where = F.create_map(*[F.lit(x) for kv in (paths or {}).items() for x in kv]) if paths else F.lit(None).cast("map<string,string>")
    return summary.withColumn("feature_drift_scores", scores.select("s").scalar()).withColumn("batch_paths", where)


def compare_batches(ref: DataFrame, cur: DataFrame, *, features: Sequence[str],
                    feature_threshold: float, share_threshold: float,
                    column_order: Sequence[str] | None = None, target: str | None = None,
                    allowed_target_values: Sequence[str] | None = None,
                    numeric: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Schema and target checks, per-feature scores and the summary.
    Returns ``(feature rows, summary row)``."""
    from tablegauge.operators.validate import enforce_batch_schema
    if column_order is not None:
        enforce_batch_schema(ref, column_order, "reference batch")
        enforce_batch_schema(cur, column_order, "current batch")
    if target is not None and allowed_target_values is not None:
        for label, b in (("reference", ref), ("current", cur)):
            bad = b.where(F.col(target).isNull() | ~F.col(target).isin(list(allowed_target_values))).limit(1)
            if bad.count():
                raise ValidationError(f"{label} batch: target '{target}' has missing or invalid values")
    scores = drift_scores(ref.select(*features), cur.select(*features), features, numeric)
    feats = drifted_features(scores, features, feature_threshold)
    # one row per feature: evaluate the scoring plan once
    feats = ref.sparkSession.createDataFrame(feats.collect(), feats.schema)
    summary = drift_summary(feats, feature_threshold=feature_threshold, share_threshold=share_threshold)
    return feats, summary


BATCH_NAMES = ("stable", "drifted")


def choose_batch(batches: MonitoringBatches, name: str) -> DataFrame:
    """The current batch by name."""
    if name not in BATCH_NAMES:
        raise ValidationError(f"current batch must be one of {BATCH_NAMES}, got '{name}'")
    return batches.stable if name == "stable" else batches.drifted

