"""Readers and writers for tables, batches and reports.

Reading normalises missing markers at the edge: NaN in floating columns
becomes NULL, and in CSV input the usual text markers become NULL too, so
that every operator downstream has exactly one notion of "missing".
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegauge.errors import ValidationError
from tablegauge.functions.columns import fresh, nan_to_null
from tablegauge.functions.prefix import in_order
from tablegauge.session import read_if_there

# The default missing-value markers of pandas' CSV reader
# (public pandas behaviour), so CSV files read the same way they would there.
CSV_MISSING_MARKERS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

_FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".orc": "orc"}


def _format_of(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    base = path.rstrip("/")
    for suffix, name in _FORMATS.items():
        if base.lower().endswith(suffix):
            return name
    return "parquet"


def normalise_missing(df: DataFrame, markers: Sequence[str] | None = CSV_MISSING_MARKERS) -> DataFrame:
    """NaN -> NULL in floating columns; marker strings -> NULL in string columns."""
    df = nan_to_null(df)
    if not markers:
        return df
    marks = list(markers)
    return df.select(*[
        F.when(F.col(f.name).isin(marks), F.lit(None).cast("string"))
        .otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def source_order() -> list[Column]:
    """The order of rows in the files that a table is scanned from: number
    of the part file, folder and name, offset of the block, row.  To be
    taken right above the scan."""
    meta = F.col("_metadata")
    part = F.regexp_extract(meta["file_name"], r"^part-(\d+)", 1).try_cast("long")
    return [F.coalesce(part, F.lit(-1)), meta["file_path"], meta["file_block_start"], F.monotonically_increasing_id()]


def read_table(spark: SparkSession, source, *, fmt: str | None = None,
               schema: T.StructType | str | None = None, position_col: str | None = None,
               multi_line: bool = False, markers: Sequence[str] | None = CSV_MISSING_MARKERS) -> DataFrame:
    """Load a table.

    * a DataFrame is passed through (NaN still normalised);
    * a path is read by format (from ``fmt`` or the suffix).  CSV has a
      header; without an explicit ``schema`` its types are inferred, which
      costs one extra pass — give a schema for large inputs.
      ``multi_line`` reads quoted line breaks inside a value; a file is then
      one task, whatever its size.
    ``position_col`` adds the row's 0-based place in the files' order, by a
    range-partitioned sort of the table.
    A missing path raises :class:`ValidationError`.
    """
    if isinstance(source, DataFrame):
        return nan_to_null(source)
    if source is None:
        raise ValidationError("no table given")
    path = os.fspath(source)
    kind = _format_of(path, fmt)
    if kind == "csv":
        # as text first: markers go before types are told or cast
        names = None if schema is None else (schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema))
        reader = spark.read.option("header", True).option("mode", "FAILFAST").option("multiLine", multi_line)
        if names is not None:
            reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in names.fields]))
        df = read_if_there(lambda: reader.csv(path))
    else:
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = read_if_there(lambda: reader.format(kind).load(path))
    if df is None:
        raise ValidationError(f"table not found: {path}")
    columns = df.columns
    places = fresh(df, *(f"place{i}" for i in range(4))) if position_col else []
    df = df.select("*", *[c.alias(n) for c, n in zip(source_order(), places)])
    if kind != "csv":
        out = nan_to_null(df)
    else:
        text = normalise_missing(df.select(*columns), markers)
        types = _told_types(text) if names is None else {f.name: f.dataType for f in names.fields}
        text = normalise_missing(df, markers) if places else text
        out = text.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()], *places)
        out = out if names is None else nan_to_null(out)
    return in_order(out, places, position_col).drop(*places) if places else out


def try_read_table(spark: SparkSession, source, **options) -> tuple[DataFrame | None, DataFrame]:
    """A read whose failure is data.  Returns the table, or None, and one
    row ``(source, ok, error)``.  What only reading the rows can tell, as a
    broken file, is not looked for."""
    name = None if source is None else "DataFrame" if isinstance(source, DataFrame) else os.fspath(source)
    df, error = None, None
    try:
        df = read_table(spark, source, **options)
    except (ValidationError, PySparkException) as exc:
        error = f"{type(exc).__name__}: {exc}"
    return df, spark.createDataFrame([(name, df is not None, error)], "source string, ok boolean, error string")


def source_path(df: DataFrame) -> str | None:
    """Where a table comes from: the files that its plan reads, part
    files as their table's folder, above any partition folders; several are joined by
    commas.  None where no file is read.  Nothing runs; the plan's own list of files is asked."""
    found = set()
    for path in df.inputFiles():
        folder, _, name = path.rpartition("/")
        while name.startswith("part-") and "=" in folder.rpartition("/")[2]:
            folder = folder.rpartition("/")[0]
        found.add(folder if name.startswith("part-") else path)
    return ",".join(sorted(found)) or None


def _told_types(text: DataFrame) -> dict[str, str]:
    """The narrowest of bigint, double, boolean and timestamp that takes every
    value of a text column, else string; one aggregate for all columns."""
    kinds = ("bigint", "double", "boolean", "timestamp")
    row = text.agg(*[a for i, c in enumerate(text.columns) for a in (
        F.count(F.col(f"`{c}`")).alias(f"n{i}"),
        *(F.count(F.col(f"`{c}`").try_cast(k)).alias(f"{k}{i}") for k in kinds))]).first()
    return {c: next((k for k in kinds if row[f"n{i}"] and row[f"{k}{i}"] == row[f"n{i}"]), "string")
            for i, c in enumerate(text.columns)}


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> str:
    """Write a table (CSV with a header); returns the path."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_in_order(df: DataFrame, path: str, *, position_col: str = "position", fmt: str = "parquet") -> str:
    """Write a table sorted by a column of positions, which is left out: the
    numbered files and the rows in them keep the order, and
    ``read_table(..., position_col=...)`` gives the positions back."""
    return write_table(df.orderBy(F.col(f"`{position_col}`")).drop(position_col), path, fmt=fmt)


def write_report(df: DataFrame, path: str, *, fmt: str = "json") -> str:
    """Write a small report table (a summary row, rule rows, ranked runs) as
    one JSON or CSV file.  Only for bounded report tables: coalescing to one
    file is the point."""
    if fmt == "csv":        # a CSV cell holds a struct, map or array as JSON
        nested = (T.StructType, T.MapType, T.ArrayType)
        df = df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
                         for f in df.schema.fields])
    one = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        one.option("header", True).csv(path)
    else:
        one.json(path)
    return path
