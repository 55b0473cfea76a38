"""Exact order statistics (medians) without a per-column value map in one
task.

``percentile``/``median`` keep a map of every distinct value of a group and
merge it in one task — fine for a few distinct values, not for a column of
10^11 distinct doubles.  Here the exact middle values are found by
bracketing:

1. one aggregate: non-NULL count per column;
2. ``percentile_approx`` (rank error at most ``n / accuracy``) just below and
   just above the wanted ranks gives a bracket ``[lo, hi]`` guaranteed to
   contain them; one more aggregate counts the rows below and inside it;
3. while a bracket still holds many rows, repeat step 2 inside it;
4. the rows inside the final bracket are collapsed to ``(column, value,
   count)`` — heavy ties become one row — and a running count over those
   few distinct values picks the exact values at the wanted ranks.

All columns are handled together in every pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
FINAL_ROWS = 1 << 20
MAX_ACCURACY = 10_000_000


def _in(c: str, lo, hi):
    x = F.col(f"`{c}`")
    cond = x.isNotNull()
    if lo is not None:
        cond = cond & (x >= F.lit(lo))
    if hi is not None:
        cond = cond & (x <= F.lit(hi))
    return cond


def order_statistics(df: DataFrame, wanted: dict[str, tuple[int, ...]], *,
                     accuracy: int = ACCURACY, final_rows: int = FINAL_ROWS,
                     counts: dict[str, int] | None = None) -> dict[str, dict[int, float]]:
    """Exact values at 0-based ranks (ascending, NULLs ignored) per column.

    ``wanted`` maps a numeric column to the ranks needed; ranks must be
    below the column's non-NULL count."""
    cols = [c for c, r in wanted.items() if r]
    if not cols:
        return {}
    # NaN counts as missing
    src = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    # bracket state per column: lo, hi (None = unbounded), rows below lo, rows inside
    state = {c: [None, None, 0, (counts or {}).get(c)] for c in cols}
    while True:
        eps = 2.0 / accuracy
        if any(s[3] is None for s in state.values()):
            row = src.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols]).first()
            for c in cols:
                state[c][3] = int(row[c])
        active = [c for c in cols if state[c][3] > final_rows and
                  (state[c][0] is None or state[c][1] is None or state[c][0] < state[c][1])]
        if not active:
            break
        probs = {}
        for c in active:
            lo, hi, below, inside = state[c]
            rs = wanted[c]
            p_lo = max(0.0, (min(rs) - below) / inside - eps)
            p_hi = min(1.0, (max(rs) - below) / inside + eps)
            probs[c] = (p_lo, p_hi)
        row = src.agg(*[
            F.percentile_approx(F.when(_in(c, state[c][0], state[c][1]), F.col(f"`{c}`")),
                                list(probs[c]), accuracy).alias(c) for c in active]).first()
        cand = {c: (row[c][0], row[c][1]) for c in active}
        cnt = src.agg(*[
            agg for c in active for agg in (
                F.count_if(_in(c, state[c][0], state[c][1]) & (F.col(f"`{c}`") < F.lit(cand[c][0])))
                .alias(f"b_{c}"),
                F.count_if(_in(c, cand[c][0], cand[c][1])).alias(f"i_{c}"))]).first()
        narrowed = False
        for c in active:
            below = state[c][2] + int(cnt[f"b_{c}"])
            inside = int(cnt[f"i_{c}"])
            rs = wanted[c]
            if below <= min(rs) and below + inside > max(rs):   # bracket holds the ranks
                narrowed |= inside < state[c][3]
                state[c] = [cand[c][0], cand[c][1], below, inside]
        if not narrowed:            # a sharper quantile sketch for the next round
            if accuracy >= MAX_ACCURACY:
                break
            accuracy *= 10
    # final: distinct values inside each bracket with their counts, all columns from one scan
    below = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(state[c][2]))])
    vals = src.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.when(_in(c, *state[c][:2]), F.col(f"`{c}`")).alias("v")) for c in cols
    ])).alias("x")).select("x.c", "x.v").where(F.col("v").isNotNull()) \
        .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")).withColumn("below", below[F.col("c")])
    w = Window.partitionBy("c").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = vals.withColumn("hi_rank", F.col("below") + F.sum("n").over(w)) \
                 .withColumn("lo_rank", F.col("hi_rank") - F.col("n"))
    out: dict[str, dict[int, float]] = {c: {} for c in cols}
    wanted_rows = None
    for c in cols:
        for r in wanted[c]:
            cond = (F.col("c") == c) & (F.col("lo_rank") <= r) & (F.col("hi_rank") > r)
            wanted_rows = cond if wanted_rows is None else (wanted_rows | cond)
    for row in ranked.where(wanted_rows).collect():
        for r in wanted[row["c"]]:
            if row["lo_rank"] <= r < row["hi_rank"]:
                out[row["c"]][r] = row["v"]
    return out


def exact_medians(df: DataFrame, columns: Sequence[str], **kw) -> dict[str, float | None]:
    """Median per column (mean of the middle pair for an even count)."""
    if not columns:
        return {}
    n = df.agg(*[F.count(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))).alias(f"n{i}")
                 for i, c in enumerate(columns)]).first()
    wanted = {}
    for i, c in enumerate(columns):
        k = int(n[f"n{i}"])
        wanted[c] = ((k - 1) // 2, k // 2) if k else ()
    stats = order_statistics(df, wanted, counts={c: int(n[f"n{i}"]) for i, c in enumerate(columns)}, **kw)
    res: dict[str, float | None] = {}
    for c in columns:
        if not wanted[c]:
            res[c] = None
        else:
            a, b = wanted[c]
            lo, hi = stats[c][a], stats[c][b]
            res[c] = lo + (hi - lo) * 0.5
    return res
