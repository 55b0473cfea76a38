"""Seeded splits and samples.

Row selection is by seeded hash rank (:mod:`tablegauge.functions.hashrank`):
exact counts, the same rows for the same seed on any cluster layout, and no
global window.  A positional index does not exist in Spark, so every
operator takes explicit, unique ``keys``; an order of rows is a column of
positions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.errors import ValidationError, refuse
from tablegauge.functions.columns import fresh, row_hash
from tablegauge.functions.hashrank import largest_remainder, select_smallest
from tablegauge.functions.prefix import in_order
from tablegauge.session import scratch_path


def _fraction(test_size: float) -> None:
    refuse(ValidationError, test_size=(not isinstance(test_size, (int, float)) or not 0 < float(test_size) < 1,
                                       f"{test_size!r} is no share of the rows"))


def test_allocation(sizes: DataFrame, test_size: float, stratify: bool) -> DataFrame:
    """Test rows per stratum ``(s, k)`` from stratum sizes ``(s, n)``:
    ``ceil(n * test_size)`` in total, shared by largest remainder when
    stratified."""
    _fraction(test_size)
    held = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("classes"),
                     F.min("n").alias("least"), F.count_if(F.col("s").isNull()).alias("unknown")).first()
    n_test = int(math.ceil(float(test_size) * held.n))
    n_train = held.n - n_test
    parts = {"test": n_test, "train": n_train}
    refuse(ValidationError, **{p: (n < 1, f"no row left, of {held.n} at {test_size}") for p, n in parts.items()})
    if not stratify:
        return sizes.select("s", F.lit(n_test).cast("long").alias("k"))
    refuse(ValidationError, target=(held.unknown > 0, "missing values can't be stratified"),
           classes=(held.least < 2, "one has a single row, which can't be in both parts"),
           **{p: (n < held.classes, f"{n} rows for {held.classes} classes") for p, n in parts.items()})
    return largest_remainder(sizes, n_test)


def split_train_test(df: DataFrame, *, keys: Sequence[str], test_size: float, seed: int,
                     target: str | None = None, stratify: bool = True,
                     part_col: str = "part", report: dict | None = None) -> DataFrame:
    """add ``part_col`` = 'test' for the rows with the smallest
    ``md5(seed|split|keys)`` within each class (allocation above), 'train'
    otherwise.  A column called like it is refused, not replaced.
    ``report`` (optional) receives ``classes``, a table of ``class_value``,
    its rows ``n`` and its test rows ``n_test``, from the counts that the
    selection needs anyway."""
    refuse(ValidationError, target=(stratify and target is None, "a stratified split needs one"),
           part_col=(part_col in df.columns, f"the table has a column {part_col!r} of its own"))
    _fraction(test_size)
    strat = F.col(f"`{target}`").cast("string") if stratify else None

    def alloc(sizes: DataFrame) -> DataFrame:
        shares = test_allocation(sizes, test_size, stratify)
        if report is not None and stratify:
            both = sizes.join(shares.withColumnRenamed("s", "c"), F.col("s") == F.col("c"))
            report["classes"] = _kept(both.select(F.col("s").alias("class_value"), "n", F.col("k").alias("n_test")), "classes")
        return shares
    out = select_smallest(df, row_hash(seed, "split", keys), alloc, strat, flag=part_col)
    return out.withColumn(part_col, F.when(F.col(f"`{part_col}`"), F.lit("test")).otherwise(F.lit("train")))


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def split_distribution(split_df: DataFrame, target: str, part_col: str = "part") -> DataFrame:
    """``(part, class_value, n)``."""
    return split_df.groupBy(F.col(part_col).alias("part"),
                            F.col(f"`{target}`").cast("string").alias("class_value")) \
        .agg(F.count(F.lit(1)).alias("n"))


def sample_rows(df: DataFrame, *, keys: Sequence[str], n: int, seed: int) -> DataFrame:
    """exactly ``n`` rows without replacement (the smallest
    ``md5(seed|sample|keys)``); more than the table holds is an error.  The
    rows are the table's, in no order;
    :func:`tablegauge.functions.prefix.in_order` gives them one."""
    refuse(ValidationError, n=(n < 0, f"cannot draw {n} rows"))

    def size(sizes: DataFrame) -> DataFrame:
        held = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        refuse(ValidationError, n=(n > held, f"{n} rows asked for, the table holds {held}"))
        return sizes.select("s", F.lit(int(n)).cast("long").alias("k"))
    (pick,) = fresh(df, "pick")
    out = select_smallest(df, row_hash(seed, "sample", keys), size, None, flag=pick)
    return out.where(F.col(pick)).drop(pick)


def permute(df: DataFrame, *, keys: Sequence[str], seed: int, position_col: str = "position") -> DataFrame:
    """the same rows in another, seeded order: ``position_col`` is the
    row's place when sorted by ``md5(seed|permute|keys)``."""
    return in_order(df, [row_hash(seed, "permute", keys), *keys], position_col)
