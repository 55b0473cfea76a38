"""Feature preparation (P1–P3, F1–F9): target/feature split, excluded
columns, feature typing, seeded missingness injection, median / most
frequent imputation, one-hot encoding and the assembled feature vector.

Learned state comes from the data it is fit on and is applied to any other
part: medians and modes as literals, categories (as many as there may be) as
a table that is joined.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.errors import PreparationError, refuse
from tablegauge.functions.columns import fresh, is_numeric, row_hash
from tablegauge.functions.hashrank import hash_thresholds, threshold_map
from tablegauge.functions.prefix import global_rank
from tablegauge.functions.quantile import exact_medians
from tablegauge.session import scratch_path

MAX_MISSING_FRACTION = 0.2


# ---------------------------------------------------------------- P1–P3
def feature_columns(df: DataFrame, target: str, excluded: Sequence[str] = ()) -> list[str]:
    """Columns other than the target and the excluded ones (absent
    excluded names are ignored); a missing target is an error."""
    refuse(PreparationError, target=(target not in df.columns, f"no column {target!r}"))
    return [c for c in drop_excluded(df, excluded).columns if c != target]


def drop_excluded(df: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    names = not isinstance(excluded, str) and all(isinstance(c, str) for c in excluded)
    refuse(PreparationError, excluded=(not names, "give a sequence of column names"))
    return df.drop(*excluded)


def feature_types(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """(numeric, categorical) — numbers and booleans are numeric,
    everything else categorical; either list empty is an error."""
    cols = list(columns) if columns is not None else list(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    kinds: dict[bool, list[str]] = {True: [], False: []}
    for c in cols:
        kinds[is_numeric(types[c], include_bool=True)].append(c)
    _both_kinds(kinds[True], kinds[False])
    return kinds[True], kinds[False]


def _both_kinds(numeric: Sequence[str], categorical: Sequence[str]) -> None:
    refuse(PreparationError, numeric=(not numeric, "at least one such column is needed"),
           categorical=(not categorical, "at least one such column is needed"))


def feature_types_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """P3 as rows ``(position, column_name, feature_type)``."""
    num, cat = feature_types(df, columns)
    cols = list(columns) if columns is not None else list(df.columns)
    rows = [(i, c, "numeric" if c in num else "categorical") for i, c in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "position long, column_name string, feature_type string")


# ---------------------------------------------------------------- F1/F2
@dataclass
class MissingnessReport:
    enabled: bool
    fraction: float
    seed: int
    strategy: str
    applied_columns: list[str] = field(default_factory=list)
    cells_per_column: int = 0
    missing_cells_introduced: int = 0


def missing_cells_per_column(rows: int, fraction: float) -> int:
    return max(1, int(math.floor(rows * float(fraction))))


def inject_missing(df: DataFrame, *, keys: Sequence[str], fraction: float, seed: int,
                   strategy: str = "all_eligible", columns: Sequence[str] | None = None,
                   protected: Sequence[str] = (), enabled: bool = True,
                   rows: int | None = None) -> tuple[DataFrame, MissingnessReport]:
    """in every selected column, independently, exactly
    ``max(1, floor(rows * fraction))`` cells become NULL — the cells of the
    rows with the smallest ``md5(seed|column|keys)``.

    ``keys`` identify rows (unique) and, like ``protected`` (the target),
    are never touched.  ``all_eligible`` selects every other column,
    ``selected_columns`` the given ``columns``.  The selection must hold at
    least one numeric and one categorical column.

    Plan: one aggregate of (column, hash-prefix) counts over all selected
    columns (which also yields the row count) (see :mod:`tablegauge.functions.hashrank`), then a
    pure projection ``when(hash <= T_column, NULL)`` — the table itself is
    never shuffled.
    """
    report = MissingnessReport(enabled, float(fraction), seed, strategy)
    if not enabled:
        return df, report
    eligible = [c for c in df.columns if c not in {*keys, *protected}]
    picks = {"all_eligible": eligible, "selected_columns": list(columns or [])}
    selected = picks.get(strategy, [])
    in_range = isinstance(fraction, (int, float)) and 0 < float(fraction) <= MAX_MISSING_FRACTION
    refuse(PreparationError,
           fraction=(not in_range, f"{fraction!r} is outside (0, {MAX_MISSING_FRACTION}]"),
           seed=(not isinstance(seed, int), f"{seed!r} is no whole number"),
           strategy=(strategy not in picks, f"{strategy!r} is none of {sorted(picks)}"),
           columns=(not set(selected) <= set(eligible), f"{sorted(set(selected) - set(eligible))} can't lose values"))
    feature_types(df, eligible)         # the table itself must have both kinds
    feature_types(df, selected)         # and so must the selection

    hashed = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("s"), row_hash(seed, c, keys).alias("h")) for c in selected])))
    got: dict[str, int] = {}

    def cells(sizes: DataFrame) -> DataFrame:
        # every selected column has one hash per row: its total is the row count
        n = int(rows) if rows is not None else sizes.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        refuse(PreparationError, rows=(n == 0, "an empty table has no values to lose"))
        got["m"] = missing_cells_per_column(n, fraction)
        return sizes.select("s", F.lit(got["m"]).cast("long").alias("k"))
    limits = threshold_map(hash_thresholds(hashed, cells))      # one for each selected column
    m = got["m"]
    out = df.select(*[
        F.when(row_hash(seed, c, keys) <= limits[c], F.lit(None))
        .otherwise(F.col(f"`{c}`")).cast(df.schema[c].dataType).alias(c)
        if c in selected else F.col(f"`{c}`")
        for c in df.columns])
    report.applied_columns = list(selected)
    report.cells_per_column = m
    report.missing_cells_introduced = m * len(selected)
    return out, report


# ---------------------------------------------------------------- F4/F5
def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median per numeric column (mean of the middle pair for an even
    count), NULLs ignored; bracketed by approximate quantiles so no task
    holds a whole column (see :mod:`tablegauge.functions.quantile`)."""
    return exact_medians(df, list(columns))


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(i, v, n)``: how often each non-NULL value of column number ``i``
    occurs, from ONE aggregate with map-side partial counts.  A table: it
    may be as long as the data."""
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v")) for i, c in enumerate(columns)])))
    return pairs.where(F.col("v").isNotNull()).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))


def column_modes(df: DataFrame, columns: Sequence[str], counts: DataFrame | None = None) -> dict[str, object]:
    """Most frequent non-NULL value per column, ties to the smallest value:
    ``min_by(value, (-count, value))`` over :func:`category_counts`, so
    buffers have constant size and one row per column is read."""
    if not columns:
        return {}
    types = {f.name: f.dataType for f in df.schema.fields}
    counts = category_counts(df, columns) if counts is None else counts
    best = counts.groupBy("i").agg(F.min_by("v", F.struct((-F.col("n")).alias("k"), F.col("v"))).alias("mode"))
    found = {r["i"]: r["mode"] for r in best.collect()}   # one row per column
    return {c: None if found.get(i) is None else _typed(found[i], types[c]) for i, c in enumerate(columns)}


def _typed(v: str, dt):
    if isinstance(dt, T.StringType):
        return v
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return int(v)
    if isinstance(dt, T.BooleanType):
        return v.lower() == "true"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return float(v)
    return v


def impute(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Apply learned fill values as literals: ``coalesce(c, value)``.
    Numeric columns filled with a (median) float become double, as the
    imputed feature matrix is; other columns keep their type."""
    def filled(c):
        v = fills[c]
        dt = df.schema[c].dataType
        if isinstance(v, float) and is_numeric(dt, include_bool=True):
            return F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")), F.lit(v)).alias(c)
        return F.coalesce(F.col(f"`{c}`"), F.lit(v).cast(dt)).alias(c)
    return df.select(*[
        filled(c) if c in fills and fills[c] is not None else F.col(f"`{c}`")
        for c in df.columns])


# ---------------------------------------------------------------- F6–F9
@dataclass
class Categories:
    """The encoder's dictionary: a written table ``(i, v, position)`` of the
    values of each column, sorted ascending, with their places in the
    vector.  Its length is not bounded by anything, so it is joined to the
    rows and never collected; ``first`` and ``width`` have a number per column."""
    columns: list[str]
    path: str
    first: list[int]
    width: list[int]

    @property
    def size(self) -> int:
        return self.first[-1] + self.width[-1] if self.columns else 0

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("v string, position int, i int").parquet(self.path)

    def names(self, spark: SparkSession) -> DataFrame:
        """``(position, feature_name)`` of the encoded features."""
        column = F.element_at(F.array(*[F.lit(c) for c in self.columns]), F.col("i") + 1)
        return self.table(spark).select(F.col("position").cast("long").alias("position"),
                                        F.concat(F.lit("categorical__"), column, F.lit("_"), F.col("v")).alias("feature_name"))

    def join(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        """``df`` with each column's place in the vector under ``names``
        (NULL for a value that the dictionary lacks).  Spark broadcasts a
        column's part of the dictionary if it is small, else shuffles on the value."""
        out = df
        for i, (c, name) in enumerate(zip(self.columns, names)):
            (value,) = fresh(out, "dictionary_value")
            part = self.table(df.sparkSession).where(F.col("i") == i).select(F.col("v").alias(value), F.col("position").alias(name))
            out = out.join(part, F.col(f"`{c}`").cast("string") == F.col(value), "left").drop(value)
        return out


def fit_categories(df: DataFrame, columns: Sequence[str], *, first: int = 0, counts: DataFrame | None = None) -> Categories:
    """F6 fit: the distinct values of every column get consecutive places
    from ``first`` on, by a distributed rank of (column, value)."""
    columns = list(columns)
    counts = category_counts(df, columns) if counts is None else counts
    ranked = global_rank(counts.select("i", "v"), [F.col("i"), F.col("v")], "place")
    path = scratch_path(df.sparkSession, "categories")
    ranked.select("v", (F.col("place") - 1 + first).cast("int").alias("position"), "i").write.partitionBy("i").parquet(path)
    out = Categories(columns, path, [], [])
    held = {r["i"]: r["n"] for r in out.table(df.sparkSession).groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
    out.width = [held.get(i, 0) for i in range(len(columns))]
    out.first = [first + sum(out.width[:i]) for i in range(len(columns))]
    return out


def sparse_vectors(df: DataFrame, places: Sequence[tuple[Column, Column]], size: int, keep: Sequence[str], output: str) -> DataFrame:
    """``keep`` and the sparse vector of the (place, value) pairs, ascending
    by place; NULL places and zeros are left out.  The vector is written in
    the fields of Spark ML's vector type and read back as that type, which
    needs no Python and no list of names: a written table, ready for the
    many passes of a fit."""
    held = F.filter(F.array(*[F.struct(p.cast("int").alias("p"), v.alias("v")) for p, v in places]),
                    lambda e: e["p"].isNotNull() & (e["v"] != 0))
    fields = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.transform(held, lambda e: e["p"]).alias("indices"), F.transform(held, lambda e: e["v"]).alias("values"))
    rows = df.select(*[F.col(f"`{c}`") for c in keep], fields.alias(output))
    path = scratch_path(df.sparkSession, "vectors")
    rows.write.parquet(path)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(output, VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)


def onehot_long(df: DataFrame, categories: Categories, keep: Sequence[str]) -> DataFrame:
    """F6 as rows ``(keep…, feature_name, value)``, 0 or 1 for every
    category (an unseen or NULL value has zeros only)."""
    return features_long(onehot(df, categories, keep), categories.names(df.sparkSession), keep)


def onehot(df: DataFrame, categories: Categories, keep: Sequence[str], output: str = "features") -> DataFrame:
    """``keep`` and the sparse one-hot vector."""
    at = fresh(df, *[f"place_{i}" for i in range(len(categories.columns))])
    return sparse_vectors(categories.join(df, at), [(F.col(p), F.lit(1.0)) for p in at], categories.size, keep, output)


def features_long(vectors: DataFrame, names: DataFrame, keep: Sequence[str], output: str = "features") -> DataFrame:
    """A vector column as ``(keep…, feature_name, value)``."""
    long = vectors.select(*[F.col(f"`{c}`") for c in keep], F.posexplode(vector_to_array(output)).alias("position", "value"))
    return long.join(names, "position").select(*[F.col(f"`{c}`") for c in keep], "feature_name", "value")


@dataclass
class FeatureSpec:
    """Fitted preparation state: fill values and the category dictionary."""
    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float | None]
    modes: dict[str, object]
    categories: Categories
    keep: list[str]
    output: str = "features"

    def names(self, spark: SparkSession) -> DataFrame:
        """``(position, feature_name)``, numeric features first."""
        numeric = spark.createDataFrame([(i, f"numeric__{c}") for i, c in enumerate(self.numeric)], "position long, feature_name string")
        return numeric.unionByName(self.categories.names(spark))

    def transform(self, df: DataFrame) -> DataFrame:
        """``keep``, the imputed features and the vector."""
        def number(c: str) -> Column:
            value = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
            fill = self.medians.get(c)
            return F.coalesce(value, F.lit(float(fill)) if fill is not None else
                              F.raise_error(F.lit(f"column {c} has missing values and had no value to learn a median from")).cast("double"))

        def text(c: str) -> Column:
            value, fill = F.col(f"`{c}`").cast("string"), self.modes.get(c)
            return value if fill is None else F.coalesce(value, F.lit(str(fill)))
        rows = df.select(*[F.col(f"`{c}`") for c in self.keep], *[number(c).alias(c) for c in self.numeric],
                         *[text(c).alias(c) for c in self.categorical])
        at = fresh(rows, *[f"place_{i}" for i in range(len(self.categorical))])
        places = [(F.lit(i), F.col(f"`{c}`")) for i, c in enumerate(self.numeric)] + [(F.col(p), F.lit(1.0)) for p in at]
        return sparse_vectors(self.categories.join(rows, at), places, len(self.numeric) + sum(self.categories.width),
                              [*self.keep, *self.numeric, *self.categorical], self.output)

    def save(self, spark: SparkSession, path: str) -> str:
        """The state as one JSON line, the dictionary as a table."""
        state = {k: getattr(self, k) for k in ("numeric", "categorical", "medians", "modes", "keep", "output")}
        state |= {"first": self.categories.first, "width": self.categories.width}
        spark.createDataFrame([(json.dumps(state, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")
        self.categories.table(spark).write.mode("overwrite").partitionBy("i").parquet(f"{path}/categories")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureSpec":
        state = json.loads(spark.read.text(f"{path}/state").first()["value"])
        state["categories"] = Categories(state["categorical"], f"{path}/categories", state.pop("first"), state.pop("width"))
        return FeatureSpec(**state)


def fit_features(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 keep: Sequence[str] = (), output: str = "features") -> FeatureSpec:
    """F7/F8 fit: medians and modes from ``df``, categories from the
    imputed ``df`` (the mode is among the values already).  One written
    count of (column, value) gives modes and dictionary."""
    _both_kinds(numeric, categorical)
    numeric, categorical = list(numeric), list(categorical)
    medians = column_medians(df, numeric)
    path = scratch_path(df.sparkSession, "category_counts")
    category_counts(df, categorical).write.parquet(path)
    counts = df.sparkSession.read.parquet(path)
    modes = column_modes(df, categorical, counts)
    return FeatureSpec(numeric, categorical, medians, modes,
                       fit_categories(df, categorical, first=len(numeric), counts=counts), list(keep), output)
