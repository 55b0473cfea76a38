"""Column expressions and shared distributed primitives.

* ``columns``  – type tests, NaN normalisation, seeded row hashes.
* ``hashrank`` – exact seeded "k smallest hashes per stratum" selection
  without a global window (used by splits, samples, missingness).
* ``prefix``   – running sums over sorted distinct values computed per
  range partition plus a small offset table (used by ROC AUC, KS).
* ``stats``    – closed-form p-value expressions.
"""
