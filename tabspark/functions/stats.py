"""Aggregate expressions with pandas' conventions (sample skewness, guarded
correlation, null-safe counts)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def skew_unbiased(x) -> Column:
    """Bias-corrected sample skewness G1 (pandas/DuckDB); null when n < 3.

    Spark's ``skewness`` is the population g1: G1 = g1 * sqrt(n(n-1)) / (n-2).
    A constant column gives g1 = NaN/null in Spark; it is returned as null.
    """
    x = _c(x)
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return F.when((n >= 3) & ~F.isnan(g1), g1 * F.sqrt(n * (n - 1)) / (n - 2))


def safe_corr(x, y) -> Column:
    """Pearson correlation on pairwise-complete rows; null for a
    constant column instead of an ANSI divide-by-zero."""
    x, y = _c(x), _c(y)
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    # ``corr`` itself raises DIVIDE_BY_ZERO under ANSI for a constant column:
    # use the moment form with a null-on-zero division.
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def count_true(cond) -> Column:
    """Number of rows where ``cond`` is true (null counts as false)."""
    return F.sum(F.coalesce(_c(cond), F.lit(False)).cast("int")).cast("bigint")


def not_finite(x) -> Column:
    """A23 predicate: null, NaN or infinite."""
    x = _c(x)
    return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
