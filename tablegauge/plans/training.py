"""Training run (T8) and experiment sweep.

validate -> split -> missingness per part -> fit preparation and model on
the train part only -> score the test part -> metrics -> gate -> record the
run -> enforce the gate (after recording, so failed runs are recorded too).
"""

from __future__ import annotations

import traceback
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.errors import TrainingError, refuse
from tablegauge.functions.columns import fresh
from tablegauge.operators import evaluate as E
from tablegauge.operators import prepare as P
from tablegauge.operators import split as S
from tablegauge.operators import train as T
from tablegauge.operators import validate as V
from tablegauge.sources import runs_store as R
from tablegauge.sources.files import source_path, write_report


@dataclass
class TrainingConfig:
    target: str
    keys: list[str]
    positive: str
    negative: str
    model: T.ModelSpec
    excluded: list[str] = field(default_factory=list)
    test_size: float = 0.2
    split_seed: int = 42
    stratify: bool = True
    seed: int = 42
    missing_enabled: bool = False
    missing_fraction: float = 0.05
    missing_seed: int = 42
    missing_strategy: str = "all_eligible"
    missing_columns: list[str] | None = None
    thresholds: dict = field(default_factory=lambda: {"f1_pos": 0.45})
    primary: str = "f1_pos"
    experiment: str = "default"
    run_name: str | None = None
    # rule arguments of validate_dataset beside target, classes and key; None skips validation
    validation: dict | None = field(default_factory=dict)
    dataset_path: str | None = None     # lineage: recorded as tags; None takes it from the table's files
    model_path: str | None = None       # folder that keeps the fitted preparation and model, one subfolder per run


@dataclass
class FittedModel:
    """T1–T4 with the preparation in front, kept and found again as one folder."""
    features: P.FeatureSpec
    classifier: object

    def transform(self, df: DataFrame) -> DataFrame:
        return self.classifier.transform(self.features.transform(df))

    def save(self, spark: SparkSession, path: str) -> str:
        self.features.save(spark, f"{path}/features")
        PipelineModel(stages=[self.classifier]).write().overwrite().save(f"{path}/classifier")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FittedModel":
        return FittedModel(P.FeatureSpec.load(spark, f"{path}/features"), PipelineModel.load(f"{path}/classifier").stages[0])


@dataclass
class TrainingResult:
    model: FittedModel
    features: P.FeatureSpec
    predictions: DataFrame
    metrics: dict
    gate: list[dict]
    passed: bool
    train_rows: int
    test_rows: int
    distribution: dict
    run: DataFrame | None = None
    confusion: dict | None = None
    run_id: str | None = None


@dataclass
class Prepared:
    """Both parts of one split as written vectors, with the preparation fitted on the train part."""
    train: DataFrame
    test: DataFrame
    features: P.FeatureSpec
    feature_columns: dict[str, list[str]]
    train_counts: dict[float, int]
    distribution: dict
    train_rows: int
    test_rows: int
    dataset_path: str | None = None


def _preparation_key(cfg: TrainingConfig) -> str:
    """Equal for configurations that differ in nothing before the fit."""
    after = {"model", "seed", "thresholds", "primary", "experiment", "run_name", "dataset_path", "model_path"}
    return repr(sorted((k, repr(v)) for k, v in asdict(cfg).items() if k not in after))


def _params(cfg: TrainingConfig) -> dict[str, str]:
    """The whole configuration, flattened, so that a run can be repeated from its record."""
    record = {("target_column" if k == "target" else k): v for k, v in asdict(cfg).items() if k != "validation"}
    return R.flatten_params(record)


def train_run(df: DataFrame, cfg: TrainingConfig, *, runs_path: str | None = None,
              enforce: bool = True, cache_input: bool = True) -> TrainingResult:
    """T8.  The projected input (keys, target, features) is read by the
    split, missingness and scoring; with ``cache_input`` it is
    persisted once (memory and disk) instead of being recomputed — worth it
    whenever the input is a join or another derived table."""
    return fit_run(prepare_parts(df, cfg, cache_input=cache_input), cfg, runs_path=runs_path, enforce=enforce)


def prepare_parts(df: DataFrame, cfg: TrainingConfig, *, cache_input: bool = True, dataset: str | None = None) -> Prepared:
    """Everything before the fit: rules, split, missingness, preparation.
    ``dataset`` names the source of a table whose plan no longer tells it."""
    if cfg.validation is not None:
        # rules see the whole table (excluded columns included)
        rules = {"allowed_target_values": (cfg.negative, cfg.positive), **({"key_column": cfg.keys[0]} if len(cfg.keys) == 1 else {}),
                 **cfg.validation}
        V.enforce(V.validate_dataset(df, target=cfg.target, excluded_columns=cfg.excluded, **rules),
                  data=df, target=cfg.target, allowed=rules["allowed_target_values"])
    dataset = cfg.dataset_path or dataset or source_path(df)
    # row keys identify rows; they are never features
    feats = P.feature_columns(df, cfg.target, list(cfg.excluded) + list(cfg.keys))
    base = df.select(*dict.fromkeys(list(cfg.keys) + [cfg.target] + feats))
    if cache_input:
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return replace(_prepare_parts(base, cfg, feats), dataset_path=dataset)
    finally:
        if cache_input:
            base.unpersist()


def _prepare_parts(base: DataFrame, cfg: TrainingConfig, feats: list[str]) -> Prepared:
    srep: dict = {}
    (part,) = fresh(base, "part")
    split = S.split_train_test(base, keys=cfg.keys, test_size=cfg.test_size, seed=cfg.split_seed,
                               target=cfg.target, stratify=cfg.stratify, part_col=part, report=srep)
    train = split.where(F.col(part) == "train").drop(part)
    test = split.where(F.col(part) == "test").drop(part)
    if cfg.missing_enabled:
        kw = dict(keys=cfg.keys, fraction=cfg.missing_fraction, strategy=cfg.missing_strategy,
                  columns=cfg.missing_columns, protected=[cfg.target])
        train, _ = P.inject_missing(train, seed=cfg.missing_seed, **kw)
        test, _ = P.inject_missing(test, seed=cfg.missing_seed + 1, **kw)
    label = F.when(F.col(f"`{cfg.target}`").cast("string") == cfg.positive, 1.0).otherwise(0.0)
    train = train.withColumn("label", label).persist(StorageLevel.MEMORY_AND_DISK)
    test = test.withColumn("label", label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if cfg.stratify:                     # from the split's own bucket counts
            sizes = srep["classes"].select("class_value", F.inline(F.array(
                F.struct(F.lit("test").alias("part"), F.col("n_test").alias("n")),
                F.struct(F.lit("train").alias("part"), (F.col("n") - F.col("n_test")).alias("n")))))
        else:
            sizes = S.split_distribution(split, cfg.target, part)
        distribution = _two_classes(sizes, cfg)
        n_train = sum(v for (p, _), v in distribution.items() if p == "train")
        n_test = sum(v for (p, _), v in distribution.items() if p == "test")
        train_counts = {1.0: distribution["train", cfg.positive], 0.0: distribution["train", cfg.negative]}
        num, cat = P.feature_types(train, feats)
        fspec = P.fit_features(train, num, cat, keep=list(cfg.keys) + [cfg.target, "label"])
        # both parts are written before the input that they come from is let go
        return Prepared(fspec.transform(train), fspec.transform(test), fspec, {"numeric": list(num), "categorical": list(cat)}, train_counts, distribution,
                        n_train, n_test)
    finally:
        train.unpersist()
        test.unpersist()


def _two_classes(sizes: DataFrame, cfg: TrainingConfig) -> dict:
    """Rows by (part, class) from ``(class_value, part, n)``, in one row
    whatever the number of classes; both parts need both classes and no
    other (V3)."""
    cells = [(p, c) for p in ("train", "test") for c in (cfg.positive, cfg.negative)]
    known = F.coalesce(F.col("class_value").isin(cfg.positive, cfg.negative), F.lit(False))
    other = F.when(~known & (F.col("n") > 0), F.coalesce("class_value", F.lit("a missing value")))
    row = sizes.agg(F.min(other).alias("other"), *[
        F.coalesce(F.sum(F.when((F.col("part") == p) & (F.col("class_value") == c), F.col("n"))), F.lit(0)).alias(f"n{i}")
        for i, (p, c) in enumerate(cells)]).first()
    out = {cell: row[f"n{i}"] for i, cell in enumerate(cells)}
    refuse(TrainingError, target=(row.other is not None, f"holds {row.other!r} beside {cfg.positive!r} and {cfg.negative!r}"),
           **{p: (not out[p, cfg.positive] or not out[p, cfg.negative], "lacks one of the two classes") for p in ("train", "test")})
    return out


def fit_run(ready: Prepared, cfg: TrainingConfig, *, runs_path: str | None = None, enforce: bool = True) -> TrainingResult:
    """Fit, score, measure, gate and record one model on prepared parts."""
    spark = ready.train.sparkSession
    fspec, counts = ready.features, ready.train_counts
    weights = T.class_weight_map(ready.train, "label", cfg.model.class_weight, counts=counts,
                                 classes={cfg.positive: 1.0, cfg.negative: 0.0})
    prepared = T.with_weights(ready.train, "label", weights)
    total = sum(n * (weights or {}).get(c, 1.0) for c, n in counts.items())
    clf = T.fit_classifier(cfg.model, prepared, keys=cfg.keys, seed=cfg.seed, n_train=ready.train_rows, weight_sum=total)
    model = FittedModel(fspec, clf)
    preds = T.score(clf, ready.test, keys=cfg.keys, target=cfg.target,
                    positive=cfg.positive, negative=cfg.negative).persist(StorageLevel.MEMORY_AND_DISK)
    V.enforce_predictions(V.validate_predictions(preds, labels=(cfg.negative, cfg.positive)))
    mets_df = E.classification_metrics(preds, positive=cfg.positive, negative=cfg.negative)
    metrics = mets_df.first().asDict()
    kept = spark.createDataFrame([tuple(metrics.values())], mets_df.schema)
    E.enforce_auc(kept)
    matrix = [r.asDict() for r in E.confusion_matrix(preds, labels=(cfg.negative, cfg.positive)).collect()]     # four cells
    confusion = {f"{r['actual']}/{r['predicted']}": r["n"] for r in matrix}
    gate_df = E.quality_gate(kept, cfg.thresholds, primary=cfg.primary)
    gate = [r.asDict() for r in gate_df.collect()]
    passed = all(r["passed"] for r in gate)
    run_id = uuid.uuid4().hex
    dataset = cfg.dataset_path or ready.dataset_path
    if cfg.model_path:
        model.save(spark, f"{cfg.model_path.rstrip('/')}/{run_id}")
    run = R.run_record(spark, experiment=cfg.experiment, run_id=run_id, gate=gate, confusion=matrix,
                       run_name=cfg.run_name or f"{cfg.model.algorithm}", metrics=metrics,
                       params=_params(cfg) | {f"confusion.{k}": str(v) for k, v in confusion.items()}
                       | R.flatten_params(ready.feature_columns, "features."),
                       tags={"quality_gate.status": "passed" if passed else "failed",
                             "target.column": cfg.target, "run_name": cfg.run_name or cfg.model.algorithm,
                             **({"dataset.path": dataset, "dataset.name": dataset.rstrip("/").rsplit("/", 1)[-1]}
                                if dataset else {})})
    if runs_path:
        R.append_runs(run, runs_path)
    result = TrainingResult(model, fspec, preds, metrics, gate, passed, ready.train_rows, ready.test_rows,
                            ready.distribution, run, confusion, run_id)
    if enforce and not passed:
        E.enforce_gate(gate_df)
    return result


SWEEP_SCHEMA = ("config string, algorithm string, status string, error string, quality_gate_status string, "
                "primary_value double, run_id string, metrics map<string,double>")


def sweep(df: DataFrame, configs: Mapping[str, TrainingConfig], *, runs_path: str | None = None,
          parallel: int = 4, report_path: str | None = None) -> DataFrame:
    """Train every configuration without enforcing the gate; a failing
    training is recorded as ``failed`` with its error and the sweep goes on.
    Configurations that share their preparation share the prepared parts, and
    up to ``parallel`` of them are fitted at a time, each in a scheduler pool
    and a job group of its own, so that what a failing fit leaves running is cancelled
    alone.  Returns one row per configuration in name order, written as JSON to ``report_path``
    if given (S6)."""
    sc = df.sparkSession.sparkContext
    rows: dict[str, tuple] = {}
    groups: dict[str, list[str]] = {}
    for name in sorted(configs):
        groups.setdefault(_preparation_key(configs[name]), []).append(name)

    def failed(name: str, exc: Exception) -> None:
        rows[name] = (name, configs[name].model.algorithm, "failed", f"{type(exc).__name__}: {exc}", None, None, None, None)
        traceback.clear_frames(exc.__traceback__)

    def fit(ready: Prepared, name: str) -> None:
        cfg, group = configs[name], f"sweep-{uuid.uuid4().hex}"
        sc.setJobGroup(group, f"sweep {name}")
        sc.setLocalProperty("spark.scheduler.pool", group)
        try:
            res = fit_run(ready, cfg, runs_path=runs_path, enforce=False)
            rows[name] = (name, cfg.model.algorithm, "completed", None, "passed" if res.passed else "failed",
                          res.metrics.get(cfg.primary), res.run_id, R.numeric_metrics(res.metrics))
            res.predictions.unpersist()
        except Exception as exc:  # noqa: BLE001 - recorded, the sweep goes on
            sc.cancelJobGroup(group)
            failed(name, exc)

    dataset = source_path(df)                # before the rows are kept, which hides their files
    base = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for names in groups.values():
            try:
                ready = prepare_parts(base, configs[names[0]], cache_input=False, dataset=dataset)
            except Exception as exc:  # noqa: BLE001 - recorded, the sweep goes on
                for name in names:
                    failed(name, exc)
                continue
            # each fit in a thread of its own, which starts with the caller's local properties
            with ThreadPoolExecutor(max(1, parallel)) as pool:
                for done in [pool.submit(inheritable_thread_target(fit), ready, name) for name in names]:
                    done.result()
    finally:
        base.unpersist()
    out = df.sparkSession.createDataFrame([rows[name] for name in sorted(rows)], SWEEP_SCHEMA)
    if report_path:
        write_report(out, report_path)
    return out
