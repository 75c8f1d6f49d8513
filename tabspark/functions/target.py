"""Target transforms and prediction post-processing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def forward_target(y, mode: str = "raw", power: float | None = None) -> Column:
    """Identity, ``log1p``, or ``y ** p`` (p = 0 means ``log1p``)."""
    y = _c(y)
    if mode == "raw":
        return y.cast("double")
    if mode == "log":
        return F.log1p(y)
    if mode == "power":
        if not power:
            return F.log1p(y)
        return F.pow(y, F.lit(float(power)))
    raise ValueError(f"unknown target mode {mode!r}")


def inverse_target(v, mode: str = "raw", power: float | None = None) -> Column:
    """``expm1``, or ``max(v, 0) ** (1/p)``."""
    v = _c(v)
    if mode == "raw":
        return v.cast("double")
    if mode == "log" or (mode == "power" and not power):
        return F.expm1(v)
    if mode == "power":
        return F.pow(F.greatest(v, F.lit(0.0)), F.lit(1.0 / float(power)))
    raise ValueError(f"unknown target mode {mode!r}")


def floor_prediction(p) -> Column:
    """Predictions are never negative (inputs are never null here)."""
    return F.greatest(_c(p), F.lit(0.0))


def residual(y, p) -> Column:
    """P20."""
    return _c(y) - _c(p)


def abs_error(y, p) -> Column:
    return F.abs(_c(y) - _c(p))
