"""Closed-form p-values.

* Kolmogorov–Smirnov (two-sample, asymptotic): with the effective size
  ``n_e = n*m/(n+m)`` and ``lam = (sqrt(n_e) + 0.12 + 0.11/sqrt(n_e)) * D``
  (Stephens 1970), ``Q(lam) = 2 * sum_{j=1..100} (-1)^(j-1) exp(-2 j^2 lam^2)``,
  clamped to [0, 1].  The truncated series is wrong for tiny ``lam``; there
  the p-value is 1.  Evaluated as a Spark column expression (one row per
  feature) and mirrored as DuckDB SQL for the oracle.
  Samples of up to ``KS_EXACT_ROWS`` rows each have the exact p-value, by
  counting lattice paths (a pandas function over one row per feature).
* Chi-square survival function for the contingency test: a column expression
  (a recurrence inside ``aggregate``), with its SQL twin.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed constants of the approximation (Stephens 1970).
KS_TERMS = 100
KS_SMALL_LAMBDA = 0.2


def ks_lambda(d: Column, n: Column, m: Column) -> Column:
    ne = (n * m).cast("double") / (n + m)
    return (F.sqrt(ne) + F.lit(0.12) + F.lit(0.11) / F.sqrt(ne)) * d


def ks_pvalue(d: Column, n: Column, m: Column) -> Column:
    lam = ks_lambda(d, n, m)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
        lambda acc, j: acc + F.pow(F.lit(-1.0), j - 1) * F.exp(-2.0 * j * j * lam * lam))
    q = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series))
    return F.when(lam < KS_SMALL_LAMBDA, F.lit(1.0)).otherwise(q)


def ks_pvalue_sql(d: str, n: str, m: str) -> str:
    """DuckDB expression equal to :func:`ks_pvalue`."""
    ne = f"(({n})*({m}))::DOUBLE/(({n})+({m}))"
    lam = f"((sqrt({ne}) + 0.12 + 0.11/sqrt({ne})) * ({d}))"
    series = (f"list_sum(list_transform(range(1, {KS_TERMS + 1}), "
              f"lambda j: pow(-1.0, j - 1) * exp(-2.0 * j * j * {lam} * {lam})))")
    return (f"CASE WHEN {lam} < {KS_SMALL_LAMBDA} THEN 1.0 "
            f"ELSE least(1.0, greatest(0.0, 2.0 * {series})) END")


# ---------------------------------------------------------------- chi-square
_TERMS = 120            # of the error function's series and continued fraction
_LGAMMA_3_2 = math.log(math.sqrt(math.pi) / 2)


def _poisson_sum(z: Column, half: Column, count: Column) -> Column:
    """``sum over k < count of z^(k + half) e^-z / gamma(k + 1 + half)``; each
    term follows from the one before as a logarithm, so nothing over- or underflows."""
    start = F.struct(F.lit(0.0).alias("total"), (half * F.log(z) - z - F.when(half > 0, _LGAMMA_3_2).otherwise(0.0)).alias("term"))
    return F.aggregate(
        F.when(count > 0, F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)).otherwise(F.array().cast("array<bigint>")), start,
        lambda acc, k: F.struct((acc["total"] + F.exp(acc["term"])).alias("total"),
                                (acc["term"] + F.log(z / (k + 1 + half))).alias("term")),
        lambda acc: acc["total"])


def _erfc_root(z: Column) -> Column:
    """The complementary error function of ``sqrt(z)``: one less the series
    below 3, the continued fraction from its far end above."""
    near = 1.0 - _poisson_sum(z, F.lit(0.5), F.lit(_TERMS))
    far = F.aggregate(F.sequence(F.lit(_TERMS), F.lit(1), F.lit(-1)), F.sqrt(z), lambda f, k: F.sqrt(z) + (k / 2.0) / f)
    return F.when(z < 3.0, near).otherwise(F.exp(-z) / (math.sqrt(math.pi) * far))


def chi2_sf(x: Column, dof: Column) -> Column:
    """P(X >= x) for a chi-square variable with ``dof`` degrees of freedom,
    odd or even: the regularised upper incomplete gamma ``Q(dof/2, x/2)`` by
    its recurrence in steps of one, from ``exp(-x/2)`` or the error function.
    No degrees of freedom (a constant feature) give 1, NULL gives NULL."""
    z = x.cast("double") / 2.0
    odd = F.pmod(dof, F.lit(2))
    tail = _poisson_sum(z, odd / 2.0, F.floor(dof / 2)) + F.when(odd == 1, _erfc_root(z)).otherwise(0.0)
    p = F.when((dof <= 0) | (x <= 0), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))
    return F.when(x.isNotNull() & dof.isNotNull(), p)


def chi2_sf_sql(x: str, dof: str) -> str:
    """DuckDB expression equal to :func:`chi2_sf`, term by term from the log-gamma function."""
    z, half = f"(({x}) / 2.0)", f"((({dof}) % 2) / 2.0)"

    def poisson(h, n):
        return (f"coalesce(list_sum(list_transform(range(0, CAST({n} AS BIGINT)), "
                f"lambda k: exp((k + {h}) * ln({z}) - {z} - lgamma(k + 1 + {h})))), 0.0)")
    far = (f"list_reduce(list_concat([sqrt({z})], CAST(range({_TERMS}, 0, -1) AS DOUBLE[])), lambda f, k: sqrt({z}) + (k / 2.0) / f)")
    erfc = f"(CASE WHEN {z} < 3.0 THEN 1.0 - {poisson('0.5', _TERMS)} ELSE exp(-{z}) / (sqrt(pi()) * {far}) END)"
    return (f"CASE WHEN ({x}) IS NULL OR ({dof}) IS NULL THEN NULL WHEN ({dof}) <= 0 OR ({x}) <= 0 THEN 1.0 ELSE greatest(0.0, least(1.0, "
            f"{poisson(half, f'floor(({dof}) / 2)')} + CASE WHEN ({dof}) % 2 = 1 THEN {erfc} ELSE 0.0 END)) END")


# ---------------------------------------------------------------- small samples
#: Rows of either sample up to which the Kolmogorov–Smirnov p-value is exact.
KS_EXACT_ROWS = 400


def ks_exact(d: float, n: int, m: int) -> float:
    """P(D >= d) for two samples of ``n`` and ``m`` without ties, by counting
    lattice paths: the share of paths from (0, 0) to (n, m) that stay where
    ``|i/n - j/m| < d``.  Row by row, the shares are running sums inside
    that band; one factor a row keeps them near one."""
    import numpy as np
    step = round(d * n * m)                      # the distance in units of 1 / (n m)
    j = np.arange(m + 1)
    share = (j * n < step).astype(float)
    for i in range(1, n + 1):
        share = np.where(np.abs(i * m - j * n) < step, share * (i / (i + m)), 0.0)
        inside = np.flatnonzero(np.abs(i * m - j * n) < step)
        if not len(inside):
            return 1.0
        share[inside] = np.cumsum(share[inside])
    return float(min(1.0, max(0.0, 1.0 - share[m])))
