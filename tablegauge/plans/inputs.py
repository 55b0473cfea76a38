"""Inputs derived from the driver's tables, each as a Spark DataFrame and
as the equivalent DuckDB SQL (for the oracle).  Every input reads whole
tables, so the work grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.operators.prepare import inject_missing


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- SQL helpers
def missing_sql(src: str, cols: list[str], keys: list[str], holes: dict[str, str],
                seed: int, fraction: float) -> str:
    """SQL of :func:`inject_missing`: per column, NULL for the rows whose
    ``md5(seed|column|keys)`` ranks within ``max(1, floor(rows*fraction))``."""
    m = f"(SELECT greatest(1, CAST(floor(count(*) * {fraction!r}) AS BIGINT)) FROM {src})"
    kt = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    parts = []
    for c in cols:
        if c in holes:
            h = f"md5(concat_ws('|', '{seed}', '{c}', {kt}))"
            parts.append(f"CASE WHEN row_number() OVER (ORDER BY {h}) <= {m} "
                         f"THEN NULL ELSE {c} END AS {c}")
        else:
            parts.append(c)
    return f"SELECT {', '.join(parts)} FROM {src}"


# ---------------------------------------------------------------- events with holes
EVENTS_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
EVENTS_HOLES = {"value": "double", "event_type": "string"}
EVENTS_SEED = 7
EVENTS_FRACTION = 0.1


def events_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with 10 % of ``value`` and of ``event_type`` set missing
    (seeded, key ``event_id``) — the driver's tables have no NULLs."""
    ev = table(spark, sf_dir, "events")
    out, _ = inject_missing(ev, keys=["event_id"], fraction=EVENTS_FRACTION, seed=EVENTS_SEED,
                            strategy="selected_columns", columns=list(EVENTS_HOLES))
    return out


def events_holes_sql() -> str:
    return missing_sql("events", EVENTS_COLS, ["event_id"], EVENTS_HOLES, EVENTS_SEED, EVENTS_FRACTION)


# ---------------------------------------------------------------- orders features
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def orders_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*ORDERS_COLS)


def orders_features_sql() -> str:
    return f"SELECT {', '.join(ORDERS_COLS)} FROM orders"


# ---------------------------------------------------------------- predictions
def lineitem_predictions(spark: SparkSession, sf_dir: str, score: str = "discount") -> DataFrame:
    """A prediction set over all of ``lineitem``: truth = returned ('R'),
    score = ``l_discount * 10`` (11 distinct values: heavy ties) or a
    many-valued score from ``l_extendedprice``; predicted 'Yes' when the
    score is at least 0.5."""
    li = table(spark, sf_dir, "lineitem")
    p = _score_col(score)
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        F.when(F.col("l_returnflag") == "R", "Yes").otherwise("No").alias("y_true"),
        F.when(p >= 0.5, "Yes").otherwise("No").alias("y_pred"),
        p.alias("p_pos"))


def _score_col(score: str):
    if score == "discount":
        return F.col("l_discount") * 10.0
    # many distinct values in [0, 1)
    return (F.col("l_extendedprice") % 1000.0) / 1000.0


def lineitem_predictions_sql(score: str = "discount") -> str:
    p = "(l_discount * 10.0)" if score == "discount" else "(fmod(l_extendedprice, 1000.0) / 1000.0)"
    return (f"SELECT l_orderkey, l_linenumber, "
            f"CASE WHEN l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS y_true, "
            f"CASE WHEN {p} >= 0.5 THEN 'Yes' ELSE 'No' END AS y_pred, {p} AS p_pos FROM lineitem")
