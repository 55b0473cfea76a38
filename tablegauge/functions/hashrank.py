"""H1 — exact seeded selection of the k smallest row hashes per stratum.

Semantics: inside each stratum, the ``k`` rows whose hash (32 hex digits,
see :func:`tablegauge.functions.columns.row_hash`) is smallest are selected.
Keys are unique, so hashes are unique and the result equals
``row_number() OVER (PARTITION BY stratum ORDER BY hash) <= k``.

Execution never ranks a whole stratum in one task, and nothing with a row
per stratum reaches the driver.  Hashes are uniform, so the hash *prefix* is
a balanced range bucket:

1. count rows per ``(stratum, prefix)`` (map-side partial aggregation; this
   also gives every stratum's size, so k may depend on it without another
   pass over the rows);
2. a running sum over the counts (65,536 buckets a stratum at most) finds
   the boundary bucket of each stratum and how many rows it still lacks;
3. while a boundary bucket is still large, refine it with the next four
   hex digits (only rows inside the boundary are counted again);
4. rank only the rows of the final boundary bucket (bounded size) to get
   the k-th smallest hash, the stratum's threshold.

Thresholds are a written table.  One stratum's is a scalar, so its
selection is a projection; several are joined on the stratum, which Spark
broadcasts by the table's size on disk or shuffles, splitting hot strata.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablegauge.functions.columns import fresh
from tablegauge.functions.prefix import global_rank
from tablegauge.session import scratch_path

_ALL = "g"          # sorts after every hex digit: selects the whole stratum
_NONE = ""          # sorts before every hash: selects nothing
_DIGITS = 4         # hex digits added per refinement level
_FINAL_ROWS = 1 << 20  # a boundary bucket this small is ranked directly
_RANK_ROWS = 1 << 17   # strata ranked in one task by their remainders

#: Rows per stratum: an int for all, a map, or a function of the sizes
#: (``s, n``) that returns the rows wanted (``s, k``).
Wanted = int | Mapping[str, int] | Callable[[DataFrame], DataFrame]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _wanted(sizes: DataFrame, k: Wanted) -> DataFrame:
    if callable(k):
        return k(sizes)
    if isinstance(k, int):
        return sizes.select("s", F.lit(k).cast("long").alias("k"))
    return sizes.sparkSession.createDataFrame([(str(s), int(n)) for s, n in k.items()], "s string, k long")


def hash_thresholds(rows: DataFrame, k: Wanted) -> DataFrame:
    """``(s, t)``: ``h <= t`` selects exactly the ``k`` smallest hashes of
    stratum ``s`` (all rows when ``k`` is at least its size).

    :param rows: ``s`` (string, may be null) and the hex hash ``h``
    """
    level1 = rows.groupBy("s", F.substring("h", 1, _DIGITS).alias("b")).agg(F.count(F.lit(1)).alias("n")) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = level1.groupBy("s").agg(F.sum("n").alias("n"))
        asked = _wanted(sizes, k).select(F.col("s").alias("asked"), "k")
        sized = sizes.join(asked, F.col("s").eqNullSafe(F.col("asked"))).select("s", "n", F.coalesce("k", F.lit(0)).alias("k"))
        found = [sized.filter("k <= 0 or k >= n").select("s", F.when(F.col("k") <= 0, _NONE).otherwise(_ALL).alias("t"),
                                                         F.lit(1).cast("long").alias("same"))]
        need = sized.filter("k > 0 and k < n").select(F.col("s").alias("at"), F.lit("").alias("p"), F.col("k").alias("r"))
        counts, digits = level1, _DIGITS
        while True:
            w = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
            bounds = counts.withColumn("cum", F.sum("n").over(w)).join(need.select("at", "r"), F.col("s").eqNullSafe(F.col("at"))) \
                .filter("cum - n < r and cum >= r").select("at", F.col("b").alias("p"), "n", F.expr("r - (cum - n)").alias("r"))
            bounds = _written(bounds, "bounds")
            large = (F.col("n") > _FINAL_ROWS) & F.lit(digits < 32)
            inside = _inside(rows, bounds.filter(~large), digits)
            found.append(inside.withColumn("rn", F.row_number().over(Window.partitionBy("s").orderBy("h")))
                         .withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("s", "h")))
                         .filter("rn = r").select("s", F.col("h").alias("t"), "same"))
            need = bounds.filter(large)
            if need.isEmpty():
                break
            digits += _DIGITS
            counts = _inside(rows, need, digits - _DIGITS) \
                .groupBy("s", F.substring("h", 1, digits).alias("b")).agg(F.count(F.lit(1)).alias("n"))
        out = found[0]
        for part in found[1:]:
            out = out.union(part)
        out = _written(out, "thresholds")
    finally:
        level1.unpersist()
    if not out.filter("same > 1").isEmpty():
        raise ValueError("the keys name several rows alike; an exact selection needs unique keys")
    return out.select("s", "t")


def _inside(rows: DataFrame, need: DataFrame, digits: int) -> DataFrame:
    """The rows in their stratum's boundary bucket, by an equi-join."""
    return rows.join(need.select("at", "p", "r"), F.col("s").eqNullSafe(F.col("at")) & (F.substring("h", 1, digits) == F.col("p"))) \
        .select("s", "h", "r")


def threshold_map(thresholds: DataFrame) -> Column:
    """All thresholds as one map: for strata that a schema bounds (columns)."""
    return thresholds.agg(F.map_from_entries(F.collect_list(F.struct("s", "t")))).scalar()


def select_smallest(df: DataFrame, hash_expr: Column, k: Wanted, stratum: Column | None = None,
                    flag: str = "selected") -> DataFrame:
    """Add boolean ``flag``: the row is among the ``k`` smallest hashes of its stratum."""
    strat = (stratum if stratum is not None else F.lit("*")).cast("string")
    limits = hash_thresholds(df.select(strat.alias("s"), hash_expr.alias("h")), k)
    if stratum is None:
        return df.withColumn(flag, F.coalesce(hash_expr <= limits.select("t").scalar(), F.lit(False)))
    at, of, limit = fresh(df, "stratum", "limit_of", "limit")
    limits = limits.select(F.col("s").alias(of), F.col("t").alias(limit))
    joined = df.withColumn(at, strat).join(limits, F.col(at).eqNullSafe(F.col(of)), "left")
    return joined.withColumn(flag, F.coalesce(hash_expr <= F.col(limit), F.lit(False))).drop(at, of, limit)


def largest_remainder(sizes: DataFrame, total: int) -> DataFrame:
    """``(s, k)``: ``total`` draws shared over the strata in proportion to
    their sizes: floor of the exact share, the leftover to the largest
    remainders, ties to the smaller stratum.  Exact decimals; remainders
    are ranked over range partitions."""
    held = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("strata")).first()
    if not held.n:
        return sizes.select("s", F.lit(0).cast("long").alias("k"))
    share = F.col("n").cast("decimal(19,0)") * F.lit(int(total)).cast("decimal(19,0)")
    parts = sizes.select("s", share.alias("share"), F.lit(held.n).cast("decimal(19,0)").alias("all")) \
        .select("s", F.expr("share div all").alias("floor"), F.expr("share % all").alias("rest"))
    ranked = global_rank(parts, [F.desc("rest"), F.asc("s")], "place", -(-held.strata // _RANK_ROWS))
    left = int(total) - ranked.agg(F.sum("floor")).first()[0]
    return ranked.select("s", (F.col("floor") + (F.col("place") <= left).cast("long")).alias("k"))
