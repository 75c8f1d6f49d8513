"""Out-of-fold tables of any learners, nested bagging, and the final blend with refitted members.

Folds are columns of one stored table: every fit reads its training rows through a
filter, never a copy, and fits run side by side in driver threads that only wait for
Spark jobs.  The number of fits follows from folds, members and seeds alone.  Scorers
are projections, so the models of a fold, its inner models and the refits follow one
another in one pass over the rows to score, without a join or a shuffle.
"""

from __future__ import annotations

from collections.abc import Hashable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.target import floor_prediction
from ..session import drop_stages, stage
from . import blend as B
from .candidates import Learner, Scorer
from .split import nested_kfold

Fit = tuple[DataFrame, Learner, int]  # training rows, learner, seed


def fit_all(fits: Mapping[Hashable, Fit], workers: int = 4) -> dict[Hashable, Scorer]:
    """The scorer of every fit, ``workers`` fits at a time."""
    @inheritable_thread_target
    def one(fit: Fit) -> Scorer:
        train, learn, seed = fit
        return learn(train, seed)[0]

    with ThreadPoolExecutor(workers) as pool:
        return dict(zip(fits, pool.map(one, fits.values())))


def with_predictions(rows: DataFrame, scorers: Mapping[str, Scorer]) -> DataFrame:
    """``rows`` with a column per scorer, named by its key."""
    for name, scorer in scorers.items():
        rows = scorer(rows).withColumnRenamed("pred", name)
    return rows


def _mean(names: Sequence[str]) -> Column:
    return sum((F.col(n) for n in names), F.lit(0.0)) / F.lit(float(len(names)))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fold_scorers(base: DataFrame, fold: str, k: int, members: Mapping[str, Learner], seed: int = 0,
                 workers: int = 4) -> dict[int, dict[str, Scorer]]:
    """Per fold f and member, the scorer fitted on the rows outside f."""
    training = {f: base.filter(F.col(fold) != f) for f in range(k)}  # a table that members share, and so their preparation
    fits = {(f, m): (training[f], learn, seed) for f in range(k) for m, learn in members.items()}
    got = fit_all(fits, workers)
    return {f: {f"p_{m}": got[f, m] for m in members} for f in range(k)}


def out_of_fold(df: DataFrame, fold: str, k: int, members: Mapping[str, Learner], seed: int = 0, workers: int = 4) -> DataFrame:
    """Every row with a column p_<member>, predicted by the fit that didn't see its fold (0 to k - 1).

    The result is written once below the shared checkpoint folder.  Rows whose fold is null are in no result."""
    base = stage(df, "fold-rows")
    scorers = fold_scorers(base, fold, k, members, seed, workers)
    out = stage(_union([with_predictions(base.filter(F.col(fold) == f), scorers[f]) for f in range(k)]), "out-of-fold")
    drop_stages(base)
    return out


def with_inner_folds(df: DataFrame, key: str, strata: str, fold: str, k: int, k_inner: int, seed: int, out: str = "inner") -> DataFrame:
    """W5 as one array a row: element o is the row's inner fold while outer fold o is held out (null for its own).

    Only (key, stratum, fold) is copied per outer fold; ``key`` is unique and not null."""
    copies = nested_kfold(df.select(key, strata, fold), key, strata, k, k_inner, 0, seed, fold)
    per_key = copies.groupBy(F.col(key).alias("__key")).agg(F.array(*[F.max(F.when(F.col("outer") == o, F.col("inner"))) for o in range(k)]).alias(out))
    return df.join(per_key, F.col(key) == F.col("__key")).drop("__key")


def nested_bag(base: DataFrame, fold: str, k: int, k_inner: int, members: Mapping[str, Learner], seed: int = 0,
               inner: str = "inner", workers: int = 4) -> DataFrame:
    """Every row with a column b_<member>, the mean of k_inner models of its outer fold, each fitted on the
    outer training rows outside one inner fold.  ``base`` is a stored table with ``with_inner_folds``' array."""
    training = {(o, i): base.filter((F.col(fold) != o) & (F.col(inner)[o] != i)) for o in range(k) for i in range(k_inner)}
    fits = {(o, i, m): (training[o, i], learn, seed + 100 * o + i)
            for o in range(k) for i in range(k_inner) for m, learn in members.items()}
    got = fit_all(fits, workers)
    parts = []
    for o in range(k):
        rows = with_predictions(base.filter(F.col(fold) == o), {f"__b{i}_{m}": got[o, i, m] for m in members for i in range(k_inner)})
        parts.append(rows.select(*[F.col(f"`{c}`") for c in base.columns], *[_mean([f"__b{i}_{m}" for i in range(k_inner)]).alias(f"b_{m}") for m in members]))
    return _union(parts)


def direct_weights(bagged: DataFrame, y: str, members: Sequence[str], steps: int = 100) -> dict[str, dict[str, float]]:
    """B3 for every member at once: the weight w on a grid that makes w p + (1 - w) b best, from one aggregation.

    Equal errors go to the smaller weight.  Gives weight, rmse, rmse_direct and rmse_bag of each member."""
    moments = []
    for i, m in enumerate(members):
        e, d = F.col(f"b_{m}") - F.col(y).cast("double"), F.col(f"p_{m}") - F.col(f"b_{m}")
        moments += [F.avg(e * e).alias(f"ee{i}"), F.avg(e * d).alias(f"ed{i}"), F.avg(d * d).alias(f"dd{i}")]
    r = bagged.agg(*moments).first()
    w = np.arange(steps + 1) / steps
    out = {}
    for i, m in enumerate(members):
        errors = np.sqrt(np.maximum(r[f"ee{i}"] + 2 * w * r[f"ed{i}"] + w * w * r[f"dd{i}"], 0.0))
        best = int(np.argmin(errors))
        out[m] = {"weight": float(w[best]), "rmse": float(errors[best]), "rmse_direct": float(errors[-1]), "rmse_bag": float(errors[0])}
    return out


def champion(train: DataFrame, test: DataFrame, key: str, y: str, strata: str, fold: str, k: int, members: Mapping[str, Learner],
             refit: Sequence[str], k_inner: int = 4, seeds: Sequence[int] = (0,), replacements: Mapping[str, DataFrame] | None = None,
             active_above: float = 1e-4, drop_below: float = 1e-10, workers: int = 4) -> tuple[DataFrame, dict]:
    """The blend of all members with refitted components, calibrated and floored at 0, for the rows of ``test``.

    Blend weights (B1) come from the members' out-of-fold predictions of ``train``.  A member that isn't replaced
    predicts by the mean of its fold models (A20).  Members named in ``refit`` with a weight above ``active_above``
    mix that with the mean of fits on all rows over ``seeds``, by the weight that nested bagging chose (B8).  A table
    (key, pred) in ``replacements`` takes a member's place where it holds the key (J6).  Weights up to
    ``drop_below`` go, the rest are renormalised (B5), and the line fitted on the out-of-fold blend calibrates (B6).

    Returns (test's rows with t_<member> of every kept member and ``pred``, report)."""
    base = stage(with_inner_folds(train, key, strata, fold, k, k_inner, seed=seeds[0] + 9000), "champion-rows")
    scorers = fold_scorers(base, fold, k, members, seeds[0], workers)
    direct = stage(_union([with_predictions(base.filter(F.col(fold) == f), scorers[f]) for f in range(k)]), "champion-oof")
    weights = B.fit_simplex_blend(direct, [f"p_{m}" for m in members], y)
    kept = {m: weights[f"p_{m}"] for m in members if weights[f"p_{m}"] > drop_below}
    total = sum(kept.values())
    kept = {m: w / total for m, w in kept.items()}
    active = [m for m in refit if weights[f"p_{m}"] > active_above]

    nested = {}
    if active:
        bagged = nested_bag(direct, fold, k, k_inner, {m: members[m] for m in active}, seeds[0], workers=workers)
        nested = direct_weights(bagged, y, active)
    full = fit_all({(m, s): (base, members[m], s) for m in active for s in seeds}, workers)
    blended = direct.select(y, sum((F.lit(w) * F.col(f"p_{m}") for m, w in kept.items()), F.lit(0.0)).alias("__blend"))
    intercept, slope = B.linear_calibration(blended, "__blend", y)
    drop_stages(direct, base)

    rows = test
    for m in kept:
        parts = {f"__f{f}": scorers[f][f"p_{m}"] for f in range(k)}
        refits = {f"__s{i}": full[m, s] for i, s in enumerate(seeds)} if m in active else {}
        out = _mean(list(parts))
        if refits:
            w = nested[m]["weight"]
            out = F.lit(w) * _mean(list(refits)) + F.lit(1.0 - w) * out
        rows = with_predictions(rows, parts | refits).withColumn(f"t_{m}", out).drop(*parts, *refits)
        given = (replacements or {}).get(m)
        if given is not None:
            swap = given.select(F.col(key).alias("__key"), F.col("pred").cast("double").alias("__swap"))
            rows = rows.join(swap, F.col(key) == F.col("__key"), "left").withColumn(f"t_{m}", F.coalesce("__swap", f"t_{m}")).drop("__key", "__swap")
    raw = sum((F.lit(w) * F.col(f"t_{m}") for m, w in kept.items()), F.lit(0.0))
    calibrated = F.lit(float(intercept)) + F.lit(float(slope)) * raw
    report = {"weights": {m: weights[f"p_{m}"] for m in members}, "kept": kept, "nested": nested, "intercept": intercept, "slope": slope}
    return rows.withColumn("pred", floor_prediction(calibrated)), report
