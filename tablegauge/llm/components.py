"""Connected components of an edge table by alternating star contractions.

Every round replaces edges by edges to the smallest known neighbour (large
star: from larger neighbours; small star: from smaller ones), so depth
shrinks geometrically and nothing but the edge table is kept.  All of it
stays distributed; a round ends in a checkpoint.  A node with a third of
all edges only takes part in ``min`` aggregates, which combine before the
shuffle, and in joins against one row for each node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that has an edge; ``root`` is the
    component's smallest node.

    :param edges: columns ``a`` and ``b`` of one integer type, either way
        round, repeats allowed; edges from a node to itself and edges with
        a null end are ignored
    """
    cur = cut_lineage(edges.select("a", "b").filter("a <> b").distinct())
    before = None
    while True:
        # exact sums, so a fixed point is told from any other table
        mark = cur.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        cur = cut_lineage(_small_star(_large_star(cur)))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(cur.select("b", "b").distinct())
