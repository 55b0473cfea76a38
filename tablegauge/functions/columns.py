"""Column-level helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_numeric(dt: T.DataType, *, include_bool: bool = False) -> bool:
    """Numeric test on a Spark type. Booleans count only when asked: the
    preparation step treats them as numeric, the audit does not."""
    if isinstance(dt, T.NumericType):
        return True
    return include_bool and isinstance(dt, T.BooleanType)


def is_integral(dt: T.DataType) -> bool:
    return isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def is_fractional(dt: T.DataType) -> bool:
    return isinstance(dt, (T.FloatType, T.DoubleType))


def missing(c: str, dt: T.DataType) -> Column:
    """Missing marker test: NULL, and NaN for floating columns."""
    col = F.col(f"`{c}`")
    if is_fractional(dt):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in floating columns so that every later
    comparison, median and count treats it as missing."""
    fields = df.schema.fields
    if not any(is_fractional(f.dataType) for f in fields):
        return df
    return df.select(*[
        F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name)
        if is_fractional(f.dataType) else F.col(f.name)
        for f in fields
    ])


def present(c: str, dt: T.DataType) -> Column:
    """The column with NaN as NULL, so that both count as one missing value."""
    col = F.col(f"`{c}`")
    return F.nanvl(col, F.lit(None).cast(dt)) if is_fractional(dt) else col


def key_text(keys: Sequence[str]) -> list[Column]:
    """Keys rendered as text for hashing (integers and strings render the
    same way in Spark and DuckDB)."""
    return [F.col(f"`{k}`").cast("string") for k in keys]


def row_hash(seed: int | str, salt: str, keys: Sequence[str]) -> Column:
    """Seeded 128-bit row hash as 32 lowercase hex digits:
    md5('seed|salt|key1|key2...')."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(str(salt)), *key_text(keys)))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
