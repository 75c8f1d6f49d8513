"""Candidate search and the analysis of its log.

Candidates are a table (``spark.range`` + deterministic low-discrepancy
uniforms), so sampling is repeatable and needs no driver RNG.  For moment
models every candidate x fold is scored from the fold moment table, so a
search costs one pass over the rows however many candidates it has.
The log is then an ordinary table: running means, pruning, de-duplication
and ranking are window functions over it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Golden-ratio and sqrt(2) fractional parts drive the sampler.
PHI = (math.sqrt(5.0) - 1.0) / 2.0
SQRT2 = math.sqrt(2.0)


def weyl(i: Column, step: float) -> Column:
    """Deterministic uniform in [0, 1): frac(i * step)."""
    x = i.cast("double") * F.lit(step)
    return x - F.floor(x)


def log_uniform(u: Column, lo: float, hi: float) -> Column:
    """exp(lerp(ln lo, ln hi, u))."""
    return F.exp(F.lit(math.log(lo)) + u * F.lit(math.log(hi) - math.log(lo)))


def int_uniform(u: Column, lo: int, hi: int) -> Column:
    return (F.lit(lo) + F.floor(u * F.lit(hi - lo + 1))).cast("int")


def choice(u: Column, options: Sequence[str]) -> Column:
    idx = F.least(F.floor(u * F.lit(len(options))).cast("int"), F.lit(len(options) - 1))
    return F.element_at(F.array(*[F.lit(o) for o in options]), idx + 1)


def space_steps(d: int) -> list[float]:
    """Steps of a d-dimensional low-discrepancy sequence frac(i * step): powers of 1 / g, where g^(d+1) = g + 1."""
    g = 2.0
    for _ in range(80):
        g = (1.0 + g) ** (1.0 / (d + 1))
    return [g ** -(j + 1) for j in range(d)]


def search_space(spark: SparkSession, n: int, space: dict[str, tuple], seed: int = 0) -> DataFrame:
    """Trials 0..n-1 over a space of named parameters, each (kind, *bounds[, (parent, value)]).

    Kinds are ``int`` and ``float`` (low, high), ``log`` (low, high, uniform in the logarithm) and ``choice``
    (options).  With a last (parent, value) the parameter is null unless the parent has that value; parents
    stand before.  Trials are numbered expressions, so any of them can be made again alone; another seed
    starts further along the same sequence."""
    t = spark.range(n).select(F.col("id").cast("bigint").alias("trial"))
    for (name, (kind, *rest)), step in zip(space.items(), space_steps(len(space))):
        parent = rest.pop() if rest and isinstance(rest[-1], tuple) and kind != "choice" or len(rest) > 1 and kind == "choice" else None
        u = weyl(F.col("trial") + 1 + seed * 100_003, step)
        if kind == "int":
            value = int_uniform(u, *rest)
        elif kind == "float":
            value = F.lit(float(rest[0])) + u * F.lit(float(rest[1]) - float(rest[0]))
        elif kind == "log":
            value = log_uniform(u, *rest)
        elif kind == "choice":
            value = choice(u, rest[0])
        else:
            raise ValueError(f"unknown kind {kind!r} of {name!r}")
        t = t.withColumn(name, value if parent is None else F.when(F.col(parent[0]) == parent[1], value))
    return t


def ridge_candidates(spark: SparkSession, n: int, features: Sequence[str],
                     decades: tuple[int, int] = (-2, 6)) -> DataFrame:
    """Trial -> (feature, alpha) with alpha on a decade grid (repeats
    happen, as with any sampler over a discrete space)."""
    lo, hi = decades
    t = spark.range(n).withColumnRenamed("id", "trial")
    k = F.floor(weyl(F.col("trial"), PHI) * F.lit(hi - lo + 1))
    return t.select(F.col("trial").cast("bigint").alias("trial"),
                    choice(weyl(F.col("trial"), SQRT2), list(features)).alias("feature"),
                    F.pow(F.lit(10.0), k + F.lit(lo)).alias("alpha"))


def fold_moments_1d(df: DataFrame, y: str, xs: Sequence[str], fold: str) -> DataFrame:
    """Per (fold, feature) raw moments of (x, y) after centring on the global
    means -- one aggregation for all features (unpivoted)."""
    center = df.agg(*[F.avg(c).alias(c) for c in [y, *xs]]).first().asDict()
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), (F.col(c).cast("double") - F.lit(center[c])).alias("x"))
        for c in xs]))
    yc = (F.col(y).cast("double") - F.lit(center[y])).alias("yc")
    long = df.select(fold, yc, pairs.alias("_p")).select(fold, "yc", "_p.feature", "_p.x")
    return long.groupBy(fold, "feature").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("x").alias("sx"),
        F.sum("yc").alias("sy"), F.sum(F.col("x") * F.col("x")).alias("sxx"),
        F.sum(F.col("x") * F.col("yc")).alias("sxy"), F.sum(F.col("yc") * F.col("yc")).alias("syy"))


def score_ridge_trials(cands: DataFrame, moments: DataFrame, fold: str) -> DataFrame:
    """E2/E3 for 1-feature ridge: (trial, step=fold+1, rmse) from moments.

    Training moments = totals - fold; validation SSE of the fold expands
    sum (y - b0 - b1 x)^2 over its own moments.  Both inputs are small
    (trials, folds x features), joined on ``feature``."""
    w = Window.partitionBy("feature")
    m = moments
    for c in ("n", "sx", "sy", "sxx", "sxy", "syy"):
        m = m.withColumn(f"t_{c}", F.sum(c).over(w) - F.col(c))
    j = cands.join(F.broadcast(m), "feature")
    n = F.col("t_n")
    mx, my = F.col("t_sx") / n, F.col("t_sy") / n
    cxx = F.col("t_sxx") - n * mx * mx
    cxy = F.col("t_sxy") - n * mx * my
    b1 = cxy / (cxx + F.col("alpha"))
    b0 = my - b1 * mx
    sse = (F.col("syy") - 2 * b0 * F.col("sy") - 2 * b1 * F.col("sxy") + F.col("n") * b0 * b0
           + 2 * b0 * b1 * F.col("sx") + b1 * b1 * F.col("sxx"))
    return j.select("trial", "feature", "alpha", (F.col(fold) + 1).alias("step"),
                    F.sqrt(F.greatest(sse / F.col("n"), F.lit(0.0))).alias("rmse"))


def array_median(arr: Column) -> Column:
    """Median of a numeric array (null when empty)."""
    s = F.array_sort(arr)
    n = F.size(s)
    mid = F.element_at(s, (F.floor((n + 1) / 2)).cast("int"))
    hi = F.element_at(s, (F.floor(n / 2) + 1).cast("int"))
    return F.when(n == 0, F.lit(None).cast("double")).when(
        n % 2 == 1, mid).otherwise((mid + hi) / 2)


def running_mean(log: DataFrame, trial: str = "trial", step: str = "step",
                 value: str = "rmse") -> DataFrame:
    """W7 report: mean of the values reported so far, per trial."""
    w = Window.partitionBy(trial).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    return log.withColumn("running", F.avg(value).over(w))


def median_prune(log: DataFrame, n_startup: int = 5, n_warmup: int = 1,
                 trial: str = "trial", step: str = "step") -> DataFrame:
    """A trial is pruned at the first step (after ``n_warmup``) where its
    running mean is worse than the median running mean of the earlier
    trials at that step; the first ``n_startup`` trials are never pruned.
    Trials are scored concurrently, so every earlier trial counts."""
    r = running_mean(log, trial, step)
    earlier = Window.partitionBy(step).orderBy(trial).rowsBetween(Window.unboundedPreceding, -1)
    # the earlier values at one step number at most the trial budget
    r = r.withColumn("median_before", array_median(F.collect_list("running").over(earlier)))
    worse = ((F.col(trial) >= n_startup) & (F.col(step) > n_warmup)
             & (F.col("running") > F.col("median_before")))
    flagged = r.withColumn("worse", worse)
    per = flagged.groupBy(trial).agg(
        F.min(F.when(F.col("worse"), F.col(step))).alias("pruned_at"),
        F.max(step).alias("steps"))
    vals = flagged.join(per, trial).filter(
        F.col("pruned_at").isNull() | (F.col(step) <= F.col("pruned_at")))
    return vals.groupBy(trial, "pruned_at").agg(
        F.max(F.struct(step, "running")).alias("_last"), F.count(F.lit(1)).alias("n_steps")
    ).select(trial, F.when(F.col("pruned_at").isNull(), "COMPLETE").otherwise("PRUNED").alias("state"),
             "pruned_at", F.col("n_steps").cast("bigint").alias("n_steps"),
             F.col("_last.running").alias("value"))


def early_stop(history: DataFrame, run: str, epoch: str, value: str, patience: int,
               min_delta: float = 0.0) -> DataFrame:
    """Best epoch under early stopping per run.

    ``min_delta == 0``: windows (running best = running min).  Otherwise
    the stateful rule is folded with ``aggregate`` over the run's
    epoch-ordered values (a run's history is bounded by its epoch budget)."""
    if min_delta == 0.0:
        w = Window.partitionBy(run).orderBy(epoch)
        prev_best = F.min(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
        h = history.withColumn("improved", prev_best.isNull() | (F.col(value) < prev_best))
        h = h.withColumn("last_improved", F.max(F.when(F.col("improved"), F.col(epoch))).over(
            w.rowsBetween(Window.unboundedPreceding, 0)))
        h = h.withColumn("stale", F.col(epoch) - F.col("last_improved"))
        stop = h.groupBy(run).agg(
            F.min(F.when(F.col("stale") >= patience, F.col(epoch))).alias("stopped_at"),
            F.max(epoch).alias("last_epoch"))
        h = h.join(stop, run).filter(F.col("stopped_at").isNull() | (F.col(epoch) <= F.col("stopped_at")))
        return h.groupBy(run, "stopped_at").agg(
            F.min(F.struct(value, epoch)).alias("_b"), F.count(F.lit(1)).alias("epochs_run")
        ).select(run, F.col("_b").getField(epoch).alias("best_epoch"),
                 F.col("_b").getField(value).alias("best_value"),
                 F.col("epochs_run").cast("bigint").alias("epochs_run"),
                 F.col("stopped_at").isNotNull().alias("stopped"))
    arr = history.groupBy(run).agg(F.sort_array(F.collect_list(F.struct(epoch, value))).alias("h"))
    init = F.struct(F.lit(float("inf")).alias("best"), F.lit(0).cast("bigint").alias("best_epoch"),
                    F.lit(0).alias("stale"), F.lit(False).alias("stopped"),
                    F.lit(0).cast("bigint").alias("n"))

    def step(acc, x):
        better = x[value] < acc["best"] - F.lit(min_delta)
        live = ~acc["stopped"]
        return F.struct(
            F.when(live & better, x[value]).otherwise(acc["best"]).alias("best"),
            F.when(live & better, x[epoch].cast("bigint")).otherwise(acc["best_epoch"]).alias("best_epoch"),
            F.when(live & better, F.lit(0)).when(live, acc["stale"] + 1).otherwise(acc["stale"]).alias("stale"),
            (acc["stopped"] | (live & ~better & (acc["stale"] + 1 >= patience))).alias("stopped"),
            F.when(live, acc["n"] + 1).otherwise(acc["n"]).alias("n"))
    folded = arr.select(run, F.aggregate("h", init, step).alias("s"))
    return folded.select(run, F.col("s.best_epoch").alias("best_epoch"),
                         F.col("s.best").alias("best_value"), F.col("s.n").alias("epochs_run"),
                         F.col("s.stopped").alias("stopped"))


def top_configs(results: DataFrame, config_cols: Sequence[str], value: str, k: int) -> DataFrame:
    """W8 + U2 + O1: best result per distinct config, first k by value
    (nulls last)."""
    w = Window.partitionBy(*config_cols).orderBy(F.asc_nulls_last(value), F.asc("trial"))
    best = results.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return best.orderBy(F.asc_nulls_last(value), F.asc("trial")).limit(k)


def rank_labels(results: DataFrame, kind: str, value: str, out: str = "label") -> DataFrame:
    """Finalists named <kind>_<rank> by value within their kind."""
    w = Window.partitionBy(kind).orderBy(F.asc_nulls_last(value), F.asc("trial"))
    r = results.withColumn("rank", F.row_number().over(w))
    return r.withColumn(out, F.concat_ws("_", F.col(kind), F.col("rank").cast("string")))


def argmin(results: DataFrame, value: str, cols: Sequence[str]) -> DataFrame:
    """O3: the row with the smallest value; ties go to the smallest ``cols``
    (``min`` of a struct, so the answer does not depend on row order)."""
    best = results.agg(F.min(F.struct(value, *cols)).alias("_b"))
    return best.select(*[F.col(f"_b.{c}").alias(c) for c in cols], F.col(f"_b.{value}").alias(value))


def stage_union(*stages: DataFrame) -> DataFrame:
    """Rows of different stages in one table, missing columns null."""
    out = stages[0]
    for s in stages[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def coarse_to_fine(spark: SparkSession, df: DataFrame, y: str, features: Sequence[str],
                   fold_coarse: str, fold_fine: str, n_trials: int, n_finalists: int = 3):
    """Every candidate on the coarse folds, the best few on the fine folds."""
    cands = ridge_candidates(spark, n_trials, features)
    coarse = score_ridge_trials(cands, fold_moments_1d(df, y, features, fold_coarse), fold_coarse)
    # compared at 1e-6, so equal configs tie exactly and the trial number decides
    summary = coarse.groupBy("trial", "feature", "alpha").agg(
        F.round(F.avg("rmse"), 6).alias("mean_rmse"))
    finalists = top_configs(summary, ["feature", "alpha"], "mean_rmse", n_finalists)
    fine = score_ridge_trials(finalists.select("trial", "feature", "alpha"),
                              fold_moments_1d(df, y, features, fold_fine), fold_fine)
    return fine.groupBy("trial", "feature", "alpha").agg(
        F.avg("rmse").alias("mean_rmse"), F.stddev_samp("rmse").alias("std_rmse"))


def selected_epochs(median_best_epoch: int, floor: int = 5) -> int:
    """Epochs for the final refit."""
    return int(max(floor, median_best_epoch))


def numpy_ridge_1d(x: np.ndarray, y: np.ndarray, alpha: float):
    xm, ym = x.mean(), y.mean()
    b1 = ((x - xm) * (y - ym)).sum() / (((x - xm) ** 2).sum() + alpha)
    return ym - b1 * xm, b1
