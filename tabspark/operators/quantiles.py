"""Exact linear-interpolated quantiles of many columns from sketches and counts.

``percentile`` (exact) merges a value->count map of the whole column inside
one task; on a cluster-sized column that map is unbounded, and ranking all values
shuffles every cell.  Here a sketch of every column (``percentile_approx``, combined
map-side) gives a bracket around each requested order statistic; one pass then
counts the cells below, between and above the brackets' ends and groups those inside
by value.  Counts say whether a bracket holds its order statistics (if not it is
widened) and how many rows it holds (if too many it is sketched again, which narrows
it a hundredfold).  Counting is numpy work on Arrow batches: as nested SQL conditions over
copied cells it took microseconds a cell.  Then the few values inside give

    h = (n - 1) * p,   q = v[floor h] + (h - floor h) * (v[ceil h] - v[floor h])

which is pandas/numpy ``linear`` and DuckDB ``quantile_cont``.  Rows are scanned twice
and never shuffled or copied; rows that need a join or an aggregation are written once
before, the needed columns alone.  Optionally the statistics are computed per group
(``by``), e.g. per fold; above ``MAX_GROUPS`` groups the values are ranked instead
(``method="sort"``: unpivoted, range-partitioned row numbers).  ``method="memory"``
uses Spark's ``percentile`` for small inputs and ``method="approx"``
``percentile_approx`` alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..session import drop_stages, stage, written
from .rank import grouped_row_number

POINTS, ACCURACY = 400, 4000  # points of a sketch, and its rank error as 1 / ACCURACY
MAX_GROUPS = 64
MAX_INSIDE = 200_000  # distinct values inside brackets that are fetched, and
MIN_INSIDE = 100  # for each statistic at least: brackets get no narrower than a few rows
HELD = 200_000  # values that a task holds before it adds up equal ones


def unpivot_values(df: DataFrame, cols: Sequence[str], key: str,
                   by: Sequence[str] = ()) -> DataFrame:
    """Long (by..., key, column, value) table of the non-null numeric cells."""
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in cols]))
    return (df.select(*by, key, stacked.alias("_kv"))
            .select(*by, key, "_kv.column", "_kv.value")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     key: str, by: Sequence[str] = (), method: str = "sketch") -> DataFrame:
    """Small table (by..., column, p, value) of exact linear quantiles (null and NaN cells are passed over)."""
    by, cols = list(by), list(cols)
    if method == "sketch":
        wide = df.select(*by, *[F.col(f"`{c}`") for c in dict.fromkeys(cols) if c not in by])
        rows, staged = written(wide, "quantile-rows")
        groups = [tuple(r) for r in rows.select(*by).distinct().limit(MAX_GROUPS + 1).collect()] if by else [()]
        out = _from_brackets(rows, cols, [float(p) for p in probs], by, groups) if len(groups) <= MAX_GROUPS else None
        drop_stages(*staged)
        if out is not None:
            return out
    if method in ("memory", "approx"):
        fn = F.percentile if method == "memory" else F.percentile_approx
        aggs = [fn(F.col(c).cast("double"), list(probs)).alias(c) for c in cols]
        wide = df.groupBy(*by).agg(*aggs)
        rows = F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("p"),
                     F.col(c)[i].alias("value"))
            for c in cols for i, p in enumerate(probs)]))
        return wide.select(*by, rows.alias("_r")).select(*by, "_r.*")

    long = unpivot_values(df, cols, key, by)
    ranked = grouped_row_number(long, ["value", key], [*by, "column"], out="_rn",
                                size_col="_n")
    # positions needed per (group, column, p): a table of groups x cols x probs x 2
    sizes = ranked.select(*by, "column", "_n").distinct()
    need = (sizes.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
            .withColumn("_h", (F.col("_n") - 1) * F.col("p"))
            .withColumn("_lo", F.floor("_h").cast("bigint") + 1)
            .withColumn("_hi", F.ceil("_h").cast("bigint") + 1))
    picks = need.select(*by, "column", "p", "_h", F.explode(F.array("_lo", "_hi")).alias("_rn"))
    # picks has groups x columns x probs x 2 rows: bounded by the parameters
    keys = [*by, "column", "_rn"]
    picks = picks.select("p", "_h", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)])
    same = F.lit(True)
    for i, c in enumerate(keys):  # null-safe: a null group is a group
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}"))
    hit = ranked.join(F.broadcast(picks), same)
    return (hit.groupBy(*by, "column", "p", "_h")
            .agg(F.min("value").alias("_vlo"), F.max("value").alias("_vhi"))
            .select(*by, "column", "p",
                    (F.col("_vlo") + (F.col("_h") - F.floor("_h")) * (F.col("_vhi") - F.col("_vlo")))
                    .alias("value")))


def _cell(c: str) -> Column:
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v + F.lit(0.0))  # both zeros are one


def _added(values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal values made one, ascending."""
    values, at = np.unique(values, return_inverse=True)
    return values, np.bincount(at, weights=n, minlength=len(values)).astype(np.int64)


def _merged(brackets: list[tuple[float, float]]) -> list[list[float]]:
    """The brackets ascending, overlapping ones joined."""
    merged: list[list[float]] = []
    for lo, hi in sorted(brackets):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return merged


def _counts(df: DataFrame, cols: list[str], by: list[str], groups: list[tuple], ends: dict[str, list[float]],
            brackets: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """(g, c, code, value, n): cells of group and column by number; by code between or at the column's ``ends``
    (2 i for a value between the ends i - 1 and i, 2 i + 1 for the end i itself) and inside its brackets by value."""
    number = F.lit(0)
    for i, group in enumerate(groups):
        same = F.lit(True)
        for b, v in zip(by, group):
            same = same & F.col(b).eqNullSafe(F.lit(v))
        number = F.lit(i) if not by else F.when(same, i) if i == 0 else number.when(same, i)
    used = [(i, c) for i, c in enumerate(cols) if brackets[c]]
    at = [np.array(ends[c], np.float64) for _, c in used]
    spans = [np.array(_merged(brackets[c]), np.float64) for _, c in used]

    def run(batches):
        codes: dict[tuple[int, int], np.ndarray] = {}
        held: dict[tuple[int, int], list[tuple]] = {}
        sizes: dict[tuple[int, int], int] = {}
        for batch in batches:
            group = batch.column(0).to_numpy(zero_copy_only=False)
            for j in range(len(used)):
                x = batch.column(j + 1).to_numpy(zero_copy_only=False)
                has = ~np.isnan(x)
                x, own = x[has] + 0.0, group[has]
                code = np.searchsorted(at[j], x, side="left") + np.searchsorted(at[j], x, side="right")
                place = np.searchsorted(spans[j][:, 0], x, side="right") - 1
                within = (place >= 0) & (x <= spans[j][np.maximum(place, 0), 1])
                for g in np.unique(own).tolist():
                    mine = own == g
                    n = np.bincount(code[mine], minlength=2 * len(at[j]) + 1)
                    codes[g, j] = codes[g, j] + n if (g, j) in codes else n
                    values, n = np.unique(x[mine & within], return_counts=True)
                    parts = held.setdefault((g, j), [])
                    parts.append((values, n))
                    sizes[g, j] = sizes.get((g, j), 0) + len(values)
                    if sizes[g, j] > HELD:
                        parts[:] = [_added(*map(np.concatenate, zip(*parts)))]
                        sizes[g, j] = 0
        for (g, j), n in codes.items():
            values, many = _added(*map(np.concatenate, zip(*held[g, j])))
            some = np.flatnonzero(n)
            # codes without a value first, then values without a code
            rows = len(some) + len(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows, g), pa.int32()), pa.array(np.full(rows, used[j][0]), pa.int32()),
                 pa.array([*some.tolist(), *[None] * len(values)], pa.int32()), pa.concat_arrays([pa.nulls(len(some), pa.float64()), pa.array(values, pa.float64())]),
                 pa.array(np.r_[n[some], many], pa.int64())], names=["g", "c", "code", "value", "n"])

    rows = df.select(number.cast("int").alias("__g"), *[F.col(f"`{c}`").cast("double").alias(f"__{i}") for i, c in used])
    return rows.mapInArrow(run, "g int, c int, code int, value double, n long").groupBy("g", "c", "code", "value").agg(F.sum("n").alias("n"))


def _inside(x: Column, brackets: list[tuple[float, float]]) -> Column:
    """Whether a value lies in one of the brackets."""
    out = F.lit(False)
    for lo, hi in _merged(brackets):
        out = out | x.between(F.lit(lo), F.lit(hi))
    return out


def _sketches(df: DataFrame, by: list[str], cells: dict[str, Column]) -> dict[tuple, tuple[int, np.ndarray]]:
    """(group, column) -> cells and ``POINTS`` + 1 approximate order statistics."""
    probs = [i / POINTS for i in range(POINTS + 1)]
    aggs = []
    for i, x in enumerate(cells.values()):
        aggs += [F.count(x).alias(f"n{i}"), F.percentile_approx(x, probs, ACCURACY).alias(f"q{i}")]
    out = {}
    for r in df.groupBy(*by).agg(*aggs).collect():
        for i, c in enumerate(cells):
            if r[f"n{i}"]:
                out[tuple(r[b] for b in by), c] = (r[f"n{i}"], np.array(r[f"q{i}"]))
    return out


def _from_brackets(df: DataFrame, cols: list[str], probs: list[float], by: list[str], groups: list[tuple]) -> DataFrame:
    spark = df.sparkSession
    sketch = _sketches(df, by, {c: _cell(c) for c in cols})
    count = {k: n for k, (n, _) in sketch.items()}
    place = {(k, p): (count[k] - 1) * p for k in count for p in probs}
    inf = math.inf
    # of each statistic: bracket, cells of its sketch below the bracket, and rows of doubt around the sketch's ranks
    bracket = {t: (-inf, inf) for t in place}
    below = {t: 0 for t in place}
    doubt = dict.fromkeys(place, 3.0)
    value: dict[tuple, float] = {}
    open_, last = list(place), math.inf
    while open_:
        nearer = {}
        for t in open_:
            k, p = t
            lo, hi = bracket[t]
            n, points = sketch[k]
            step, h = n / POINTS, place[t]
            # points of the sketch inside the bracket, with the ranks they stand for
            own = points[(points >= lo) & (points <= hi)]
            ranks = below[t] + np.arange(len(own)) * step
            margin = doubt[t] * (step + n / ACCURACY) + 2
            left, right = own[ranks <= h - margin], own[ranks >= h + 1 + margin]
            nearer[t] = (float(left[-1]) if len(left) else lo, float(right[0]) if len(right) else hi)
        ends = {c: sorted({e for (k, _), b in nearer.items() if k[1] == c for e in b if math.isfinite(e)}) for c in cols}
        found = stage(_counts(df, cols, by, groups, ends, {c: [b for (k, _), b in nearer.items() if k[1] == c] for c in cols}), "quantile-cells")
        codes: dict[tuple, dict[int, int]] = {}
        for r in found.filter("code is not null").collect():
            codes.setdefault((groups[r.g], cols[r.c]), {})[r.code] = r.n
        distinct = found.filter("code is null").count()
        fits = distinct <= max(MAX_INSIDE, MIN_INSIDE * len(open_)) or distinct >= last
        last = distinct
        values: dict[tuple, list] = {}
        if fits:
            for r in found.filter("code is null").select("g", "c", "value", "n").collect():
                values.setdefault((groups[r.g], cols[r.c]), []).append((r.value, r.n))
        drop_stages(found)
        again, wide = [], []
        for t in open_:
            k, p = t
            (lo, hi), at, own = nearer[t], ends[k[1]], codes.get(k, {})
            h = place[t]
            under = 0 if lo == -inf else sum(n for code, n in own.items() if code < 2 * at.index(lo) + 1)
            upto = count[k] if hi == inf else sum(n for code, n in own.items() if code <= 2 * at.index(hi) + 1)
            if under > math.floor(h) or upto <= math.ceil(h):  # missed: from the bracket before, with more doubt
                doubt[t] *= 4
                again.append(t)
                last = math.inf
            elif fits:
                some = sorted((v, n) for v, n in values.get(k, []) if lo <= v <= hi)
                upper = under + np.cumsum([n for _, n in some])
                a, b = (some[int(np.searchsorted(upper, i, side="right"))][0] for i in (math.floor(h), math.ceil(h)))
                value[t] = a + (h - math.floor(h)) * (b - a)
            else:
                bracket[t], below[t], doubt[t] = (lo, hi), under, 3.0
                again.append(t)
                wide.append(t)
        open_ = again
        if wide:
            brackets = {c: [bracket[t] for t in open_ if t[0][1] == c] for c in cols}
            sketch |= _sketches(df, by, {c: F.when(_inside(_cell(c), b), _cell(c)) for c, b in brackets.items() if b})
    if not by:  # as Arrow: no Python worker makes the few rows again
        parts = list(zip(*[(k[1], p, v) for (k, p), v in value.items()])) or [(), (), ()]
        return spark.createDataFrame(pa.table({"column": pa.array(parts[0], pa.string()), "p": pa.array(parts[1], pa.float64()), "value": pa.array(parts[2], pa.float64())}))
    schema = StructType([*[df.schema[b] for b in by], StructField("column", StringType()), StructField("p", DoubleType()), StructField("value", DoubleType())])
    return spark.createDataFrame([(*k[0], k[1], p, v) for (k, p), v in value.items()], schema)


def quantile_wide(q: DataFrame, by: Sequence[str] = (), names: dict[float, str] | None = None) -> DataFrame:
    """(by, column, p, value) -> one row per (by, column) with a column per p."""
    names = names or {}
    ps = sorted({r.p for r in q.select("p").distinct().collect()})
    return q.groupBy(*by, "column").agg(*[
        F.max(F.when(F.col("p") == p, F.col("value"))).alias(names.get(p, f"p{int(round(p * 1000)):03d}"))
        for p in ps])
