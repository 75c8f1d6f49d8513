"""Guarded joins and projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_one_to_one(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner equi-join asserted one-to-one: both sides must have unique
    keys (checked with a partial-aggregated group-by each, nothing collected
    but two counts)."""
    keys = [key] if isinstance(key, str) else list(key)
    for name, side in (("left", a), ("right", b)):
        dup = side.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
        if dup:
            raise ValueError(f"{name} side has duplicate keys on {keys}")
    return a.join(b, keys, "inner")


def project(df: DataFrame, columns: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """P3 + P4: the declared columns in the declared order, minus key/target."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns if c not in set(drop)])


def extreme_rows(df: DataFrame, column: str, threshold: float, show: Sequence[str]) -> DataFrame:
    """Rows above a threshold, listed with a few columns (pushed to the scan)."""
    return df.filter(F.col(column) > F.lit(threshold)).select(*show)
