"""Blending and calibration on out-of-fold prediction tables.

Everything a blend needs from the rows is a handful of second moments of
the prediction columns and the target (A22), gathered in one aggregation
(optionally per fold).  The k x k problems are then solved on the driver:
their size depends on the number of models, never on the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.target import floor_prediction
from ..session import stage


def gram_moments(df: DataFrame, cols: Sequence[str], y: str, by: Sequence[str] = ()) -> DataFrame:
    """N and E[a*b] for all pairs of (cols + y), per group; long form."""
    names = [*cols, y]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    aggs = [F.count(F.lit(1)).cast("double").alias("__n")]
    aggs += [F.avg(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"__{i}")
             for i, (a, b) in enumerate(pairs)]
    aggs += [F.avg(F.col(a).cast("double")).alias(f"__m_{a}") for a in names]
    one = df.groupBy(*by).agg(*aggs)
    return one.select(*by, "__n", F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"__{i}").alias("value"))
        for i, (a, b) in enumerate(pairs)] + [
        F.struct(F.lit(a).alias("a"), F.lit("1").alias("b"), F.col(f"__m_{a}").alias("value"))
        for a in names])).alias("_g")).select(*by, F.col("__n").alias("n"), "_g.*")


def _system(rows, cols: Sequence[str], y: str):
    """(n, E[PP'], E[Py], E[yy], E[P], E[y]) from A22 rows of one group."""
    m = {(r.a, r.b): r.value for r in rows}
    m.update({(r.b, r.a): r.value for r in rows})
    k = len(cols)
    g = np.array([[m[(a, b)] for b in cols] for a in cols])
    c = np.array([m[(a, y)] for a in cols])
    mp = np.array([m[(a, "1")] for a in cols])
    return rows[0].n, g, c, m[(y, y)], mp, m[(y, "1")], k


def simplex_weights(g: np.ndarray, c: np.ndarray) -> np.ndarray:
    """B1: argmin_w w'Gw - 2c'w over w >= 0, sum w = 1, by an exact active set.

    On the simplex the objective equals w'Ew with E = G - c1' - 1c' (+ a constant),
    the moments of the members' errors, which keeps the digits that G loses to
    the size of the target.  Raises if the optimality conditions fail."""
    k = len(c)
    e = g - c[:, None] - c[None, :]
    e = e - e.min()  # a constant matrix changes nothing on the simplex
    scale = max(np.abs(e).max(), 1e-300)
    e = e / scale
    free = np.ones(k, bool)
    w = np.full(k, 1.0 / k)
    for _ in range(50 * (k + 1)):
        idx = np.flatnonzero(free)
        m = np.zeros((len(idx) + 1, len(idx) + 1))
        m[:-1, :-1], m[:-1, -1], m[-1, :-1] = e[np.ix_(idx, idx)], 1.0, 1.0
        target = np.zeros(k)
        target[idx] = np.linalg.lstsq(m, np.append(np.zeros(len(idx)), 1.0), rcond=None)[0][:-1]
        if (target[idx] >= -1e-12).all():
            w = np.maximum(target, 0.0)
            w /= w.sum()
            grad = e @ w
            low = grad[idx].min()
            worst = int(np.argmin(np.where(free, np.inf, grad))) if not free.all() else -1
            if worst < 0 or grad[worst] >= low - 1e-10:
                if (grad[w > 1e-9] - grad.min() > 1e-6).any():
                    raise ArithmeticError("blend weights miss the optimality conditions")
                return w
            free[worst] = True
        else:
            down = idx[target[idx] < w[idx]]
            steps = w[down] / np.maximum(w[down] - target[down], 1e-300)
            t = min(1.0, float(steps[target[down] < 0].min()))
            w = np.maximum(w + t * (target - w), 0.0)
            drop = idx[(w[idx] <= 1e-12) & (target[idx] < 0)]
            w[drop] = 0.0
            free[drop] = False
    raise ArithmeticError("blend weights did not settle")


def fit_simplex_blend(oof: DataFrame, cols: Sequence[str], y: str) -> dict[str, float]:
    rows = gram_moments(oof, cols, y).collect()
    _, g, c, *_ = _system(rows, cols, y)
    return dict(zip(cols, simplex_weights(g, c).tolist()))


def fit_stable_blend(oof: DataFrame, cols: Sequence[str], y: str, fold: str):
    """B2: weights per fold from training moments (totals - fold), scored on
    the held-out fold; weights averaged and renormalised.  One job."""
    rows = gram_moments(oof, cols, y, by=[fold]).collect()
    per: dict = {}
    for r in rows:
        per.setdefault(r[fold], []).append(r)
    sys_ = {f: _system(rs, cols, y) for f, rs in per.items()}
    n_tot = sum(s[0] for s in sys_.values())
    g_tot = sum(s[0] * s[1] for s in sys_.values())
    c_tot = sum(s[0] * s[2] for s in sys_.values())
    ws, sse = [], 0.0
    for f, (n, g, c, yy, *_r) in sys_.items():
        w = simplex_weights((g_tot - n * g) / (n_tot - n), (c_tot - n * c) / (n_tot - n))
        ws.append(w)
        sse += n * (w @ g @ w - 2 * c @ w + yy)
    w = np.mean(ws, axis=0)
    w = w / w.sum()
    return dict(zip(cols, w.tolist())), float(np.sqrt(max(sse, 0.0) / n_tot))


def fit_nnls_blend(oof: DataFrame, cols: Sequence[str], y: str):
    """M4: non-negative least squares with a free intercept, from centred moments."""
    from .models import nnls_quadratic
    rows = gram_moments(oof, cols, y).collect()
    _, g, c, _, mp, my, _ = _system(rows, cols, y)
    gc = g - np.outer(mp, mp)
    cc = c - mp * my
    w = nnls_quadratic(gc, cc)
    return float(my - mp @ w), dict(zip(cols, w.tolist()))


def grid_blend(oof: DataFrame, a: str, b: str, y: str, steps: int = 20) -> DataFrame:
    """MSE of w*a + (1-w)*b for w = 0, 1/steps, ..., 1 from three moments
    (no row expansion), argmin with the smaller weight winning ties (O4)."""
    e = F.col(b).cast("double") - F.col(y).cast("double")
    d = F.col(a).cast("double") - F.col(b).cast("double")
    mom = oof.agg(F.avg(e * e).alias("ee"), F.avg(e * d).alias("ed"), F.avg(d * d).alias("dd"))
    grid = mom.select("*", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("i"))
    w = F.col("i") / F.lit(float(steps))
    scored = grid.select(w.alias("weight"),
                         F.sqrt(F.greatest(F.col("ee") + 2 * w * F.col("ed") + w * w * F.col("dd"),
                                           F.lit(0.0))).alias("rmse"))
    best = scored.agg(F.min(F.struct("rmse", "weight")).alias("b"))
    return best.select("b.weight", "b.rmse")


def apply_weights(weights: dict[str, float], intercept: float = 0.0) -> Column:
    """Linear blend floored at 0."""
    out = F.lit(float(intercept))
    for c, w in weights.items():
        out = out + F.lit(float(w)) * F.col(c)
    return floor_prediction(out)


def prune_weights(weights: DataFrame, drop_below: float = 1e-10, active_above: float = 1e-4) -> DataFrame:
    """Drop weights <= ``drop_below``, renormalise the rest, flag active ones.
    ``weights`` is a (model, weight) table with a row per model."""
    kept = weights.filter(F.col("weight") > F.lit(drop_below))
    # a row per model: the global window is over a handful of rows
    j = kept.withColumn("t", F.sum("weight").over(Window.partitionBy()))
    return j.select("model", (F.col("weight") / F.col("t")).alias("weight"),
                    (F.col("weight") / F.col("t") > F.lit(active_above)).alias("active"))


def linear_calibration(oof: DataFrame, pred: str, y: str):
    """Slope and intercept of y on the prediction (``regr_*``)."""
    r = oof.agg(F.regr_slope(y, pred).alias("slope"), F.regr_intercept(y, pred).alias("intercept")).first()
    return r.intercept, r.slope


def calibration_cv(oof: DataFrame, pred: str, y: str, fold: str) -> DataFrame:
    """K-fold RMSE with and without a linear calibration fitted on the
    other folds (fold moments, totals - fold; one job), and the decision."""
    p, t = F.col(pred).cast("double"), F.col(y).cast("double")
    rows = oof.groupBy(fold).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(p).alias("sp"), F.sum(t).alias("sy"),
        F.sum(p * p).alias("spp"), F.sum(p * t).alias("spy"), F.sum(t * t).alias("syy")).collect()
    tot = {k: sum(r[k] for r in rows) for k in ("n", "sp", "sy", "spp", "spy", "syy")}
    sse_raw = sse_cal = 0.0
    for r in rows:
        n = tot["n"] - r.n
        mp, my = (tot["sp"] - r.sp) / n, (tot["sy"] - r.sy) / n
        cpp = (tot["spp"] - r.spp) - n * mp * mp
        cpy = (tot["spy"] - r.spy) - n * mp * my
        slope = cpy / cpp if cpp else 0.0
        b0 = my - slope * mp
        sse_raw += r.syy - 2 * r.spy + r.spp
        # sum over the fold of (y - b0 - slope p)^2 from its moments
        sse_cal += (r.syy - 2 * b0 * r.sy - 2 * slope * r.spy + r.n * b0 * b0
                    + 2 * b0 * slope * r.sp + slope * slope * r.spp)
    n = tot["n"]
    raw, cal = float(np.sqrt(max(sse_raw, 0) / n)), float(np.sqrt(max(sse_cal, 0) / n))
    return oof.sparkSession.createDataFrame(
        [(raw, cal, cal < raw)], "rmse_raw double, rmse_calibrated double, use_calibration boolean")


def nested_bag_weight(df: DataFrame, key: str, y: str, xs: Sequence[str], fold: str,
                      direct: str, inner: str = "inner", outer: str = "outer",
                      steps: int = 100) -> dict:
    """B8 for moment models.  ``df`` is the nested fold table (rows x outer
    folds they train, with ``inner`` folds, from ``nested_kfold``); ``direct``
    names the OOF column of the full-fold model.  Per outer fold the inner
    models (training moments = outer part - inner fold) are averaged -- for a
    linear model the mean prediction is the prediction of the mean
    coefficients -- and score the outer validation rows; the weight between
    direct and bagged predictions is chosen on a grid from three moments."""
    from .models import Moments, linear_predict, moment_table, ridge_from_moments
    rows = moment_table(df, y, list(xs), [outer, inner]).collect()
    per: dict = {}
    for r in rows:
        per.setdefault(r[outer], {})[r[inner]] = Moments.from_row(r, y, list(xs))
    coefs = []
    for o, parts in per.items():
        tot = None
        for m in parts.values():
            tot = m if tot is None else tot + m
        fits = [ridge_from_moments(tot - m) for m in parts.values()]
        coefs.append((int(o), float(np.mean([b0 for b0, _ in fits])),
                      *[float(np.mean([b[i] for _, b in fits])) for i in range(len(xs))]))
    schema = ", ".join([f"`{fold}` int", "_b0 double"] + [f"`_b_{x}` double" for x in xs])
    c = df.sparkSession.createDataFrame(coefs, schema)
    base = df.select(key, fold, y, direct, *xs).dropDuplicates([key])
    # written: the grid, the error and the caller read it; the join is with k rows
    both = stage(base.join(F.broadcast(c), fold).withColumn(
        "p_bag", linear_predict(xs, F.col("_b0"), [F.col(f"_b_{x}") for x in xs])), "bagged")
    best = grid_blend(both, direct, "p_bag", y, steps=steps).first()
    rmse_bag = both.agg(F.sqrt(F.avg((F.col(y) - F.col("p_bag")) ** 2))).first()[0]
    return {"direct_weight": best.weight, "best_rmse": best.rmse, "rmse_bag": rmse_bag,
            "bagged": both}


def score_board(*candidates: DataFrame, value: str = "cv_rmse") -> DataFrame:
    """All candidates in one table (missing columns null), best first;
    ``first()`` of the result is the winner."""
    out = candidates[0]
    for c in candidates[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    return out.orderBy(F.asc_nulls_last(value))


def override(base_long: DataFrame, replacements: DataFrame, key: str, model: str = "model",
             pred: str = "pred") -> DataFrame:
    """Replacement prediction for (key, model) if present, else the base."""
    r = replacements.select(key, model, F.col(pred).alias("_rep"))
    return base_long.join(r, [key, model], "left").select(
        key, model, F.coalesce("_rep", pred).alias(pred))


def pivot_models(long: DataFrame, key: str, models: Sequence[str], model: str = "model",
                 pred: str = "pred") -> DataFrame:
    """Long (key, model, pred) -> one column per model (listed values,
    so no extra pass to discover them)."""
    return long.groupBy(key).pivot(model, list(models)).agg(F.first(pred))
