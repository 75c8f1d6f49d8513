"""Models (M1-M12).

Linear models are fitted from cross-product moments gathered in a single
aggregation (``p`` features -> (p+1)(p+2)/2 sums); the p x p solve on the
driver is independent of the row count.  Fold complements reuse one pass:
training moments of fold f = totals - moments of fold f.  Tree ensembles
and Huber regression are ``pyspark.ml`` estimators; the dense net is scored
with a vectorised pandas UDF and trained by data-parallel gradient sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ------------------------------------------------------------------ moments


def moment_table(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = (),
                 center: dict | None = None) -> DataFrame:
    """N, sums, cross products per group, of (optionally centred) values."""
    center = center or {}
    v = {c: F.col(f"`{c}`").cast("double") - F.lit(center.get(c, 0.0)) for c in [y, *xs]}
    aggs = [F.count(F.lit(1)).cast("double").alias("n"), F.sum(v[y]).alias(f"s_{y}"),
            F.sum(v[y] * v[y]).alias(f"ss_{y}_{y}"),
            # uncentred target sum: exact for integer targets, gives the mean model
            F.sum(F.col(f"`{y}`").cast("double")).alias("raw_sy")]
    for i, a in enumerate(xs):
        aggs.append(F.sum(v[a]).alias(f"s_{a}"))
        aggs.append(F.sum(v[a] * v[y]).alias(f"ss_{a}_{y}"))
        for b in xs[i:]:
            aggs.append(F.sum(v[a] * v[b]).alias(f"ss_{a}_{b}"))
    return df.groupBy(*by).agg(*aggs)


@dataclass
class Moments:
    n: float
    sx: np.ndarray
    sy: float
    sxx: np.ndarray
    sxy: np.ndarray
    syy: float
    raw_sy: float | None = None

    @staticmethod
    def from_row(row, y: str, xs: Sequence[str]) -> "Moments":
        p = len(xs)
        sxx = np.zeros((p, p))
        for i, a in enumerate(xs):
            for j in range(i, p):
                sxx[i, j] = sxx[j, i] = row[f"ss_{a}_{xs[j]}"]
        d = row.asDict()
        return Moments(row["n"], np.array([row[f"s_{a}"] for a in xs], dtype=float),
                       row[f"s_{y}"], sxx,
                       np.array([row[f"ss_{a}_{y}"] for a in xs], dtype=float), row[f"ss_{y}_{y}"],
                       d.get("raw_sy"))

    def _raw(self, o: "Moments", sign: int):
        if self.raw_sy is None or o.raw_sy is None:
            return None
        return self.raw_sy + sign * o.raw_sy

    def __sub__(self, o: "Moments") -> "Moments":
        return Moments(self.n - o.n, self.sx - o.sx, self.sy - o.sy, self.sxx - o.sxx,
                       self.sxy - o.sxy, self.syy - o.syy, self._raw(o, -1))

    def __add__(self, o: "Moments") -> "Moments":
        return Moments(self.n + o.n, self.sx + o.sx, self.sy + o.sy, self.sxx + o.sxx,
                       self.sxy + o.sxy, self.syy + o.syy, self._raw(o, 1))

    def raw_mean(self) -> float | None:
        return None if self.raw_sy is None else self.raw_sy / self.n

    def centered(self):
        mx, my = self.sx / self.n, self.sy / self.n
        cxx = self.sxx - self.n * np.outer(mx, mx)
        cxy = self.sxy - self.n * mx * my
        return mx, my, cxx, cxy


def ridge_from_moments(m: Moments, alpha: float = 0.0, positive: bool = False):
    """M2/M3/M4: intercept unpenalised; returns (intercept, coefficients)."""
    mx, my, cxx, cxy = m.centered()
    p = len(mx)
    a = cxx + alpha * np.eye(p)
    if positive:
        beta = nnls_quadratic(a, cxy)
    else:
        beta = np.linalg.lstsq(a, cxy, rcond=None)[0] if p else np.zeros(0)
    return float(my - mx @ beta), beta


def nnls_quadratic(a: np.ndarray, b: np.ndarray, iters: int = 500) -> np.ndarray:
    """min 1/2 w'Aw - b'w subject to w >= 0 (active set on a p x p system)."""
    p = len(b)
    passive = np.zeros(p, dtype=bool)
    w = np.zeros(p)
    for _ in range(iters):
        grad = b - a @ w
        cand = (~passive) & (grad > 1e-12)
        if not cand.any():
            break
        passive[np.argmax(np.where(cand, grad, -np.inf))] = True
        while passive.any():
            z = np.zeros(p)
            idx = np.where(passive)[0]
            z[idx] = np.linalg.lstsq(a[np.ix_(idx, idx)], b[idx], rcond=None)[0]
            if (z[idx] > 0).all():
                w = z
                break
            neg = idx[z[idx] <= 0]
            t = np.min(w[neg] / (w[neg] - z[neg] + 1e-300))
            w = w + t * (z - w)
            passive &= w > 1e-14
            w[~passive] = 0.0
    else:
        raise ArithmeticError("non-negative least squares did not settle")
    return w


def fold_linear_fits(df: DataFrame, y: str, xs: Sequence[str], fold: str, alpha: float = 0.0,
                     positive: bool = False) -> DataFrame:
    """M1-M4 per fold in one aggregation: training moments = totals - fold.

    Returns (fold, intercept, coef_<x>...) -- k rows; with no ``xs`` the
    model is the mean baseline (M1)."""
    xs = list(xs)
    center = df.agg(*[F.avg(c).alias(c) for c in [y, *xs]]).collect()[0].asDict()  # H5
    rows = moment_table(df, y, xs, [fold], center).collect()
    per = {r[fold]: Moments.from_row(r, y, xs) for r in rows}
    total = None
    for m in per.values():
        total = m if total is None else total + m
    out = []
    for f, m in sorted(per.items()):
        tr = total - m
        b0, beta = ridge_from_moments(tr, alpha, positive)
        b0 = b0 + center[y] - float(sum(beta[i] * center[c] for i, c in enumerate(xs)))
        if not xs and tr.raw_mean() is not None:
            b0 = tr.raw_mean()  # M1: the training mean, from uncentred sums
        out.append((int(f), float(b0), *[float(v) for v in beta]))
    schema = ", ".join([f"{fold} int", "intercept double"] + [f"coef_{c} double" for c in xs])
    return df.sparkSession.createDataFrame(out, schema)


def fit_linear(df: DataFrame, y: str, xs: Sequence[str], alpha: float = 0.0,
               positive: bool = False) -> tuple[float, np.ndarray]:
    xs = list(xs)
    center = df.agg(*[F.avg(c).alias(c) for c in [y, *xs]]).collect()[0].asDict()
    row = moment_table(df, y, xs, (), center).collect()[0]
    b0, beta = ridge_from_moments(Moments.from_row(row, y, xs), alpha, positive)
    return b0 + center[y] - float(sum(beta[i] * center[c] for i, c in enumerate(xs))), beta


def linear_predict(xs: Sequence[str], intercept, coefs) -> Column:
    """Prediction from literal or column coefficients."""
    out = intercept if isinstance(intercept, Column) else F.lit(float(intercept))
    for c, b in zip(xs, coefs):
        b = b if isinstance(b, Column) else F.lit(float(b))
        out = out + b * F.col(f"`{c}`").cast("double")
    return out


def oof_linear(df: DataFrame, key: str, y: str, xs: Sequence[str], fold: str,
               alpha: float = 0.0, positive: bool = False, out: str = "pred") -> DataFrame:
    """E4 for moment models: each row scored by the fit that excluded its fold."""
    coefs = fold_linear_fits(df, y, xs, fold, alpha, positive)
    # k rows: a bounded broadcast on the fold key
    j = df.join(F.broadcast(coefs), fold)
    return j.select(key, fold, y, linear_predict(
        xs, F.col("intercept"), [F.col(f"coef_{c}") for c in xs]).alias(out))


def ridge_alpha_for_spark(alpha: float, n: int, y_std_pop: float) -> float:
    """``regParam`` of ``LinearRegression(solver='normal', standardization=False)``
    that reproduces ``Ridge(alpha)`` (the objective is divided by n and y is
    scaled by its std)."""
    return alpha / n / (y_std_pop or 1.0)


# ------------------------------------------------------------------ pyspark.ml estimators


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol=out,
                           handleInvalid="keep").transform(df)


def make_estimator(kind: str, label: str = "label", features: str = "features",
                   seed: int = 0, **params):
    """M5-M7: estimator factory keyed by kind."""
    from pyspark.ml.regression import (GBTRegressor, LinearRegression,
                                       RandomForestRegressor)
    if kind == "gbt":
        # rows that the column ``validation`` marks decide after how many rounds the ensemble ends
        stop = {"validationIndicatorCol": params["validation"],
                "validationTol": params.get("validation_tol", 0.001)} if params.get("validation") else {}
        return GBTRegressor(labelCol=label, featuresCol=features, seed=seed,
                            maxDepth=params.get("max_depth", 4),
                            stepSize=params.get("learning_rate", 0.1),
                            maxIter=params.get("rounds", 50),
                            subsamplingRate=params.get("subsample", 1.0),
                            minInstancesPerNode=params.get("min_leaf", 1),
                            featureSubsetStrategy=params.get("feature_subset", "all"), **stop)
    if kind == "rf":
        return RandomForestRegressor(labelCol=label, featuresCol=features, seed=seed,
                                     numTrees=params.get("trees", 50),
                                     maxDepth=params.get("max_depth", 8),
                                     minInstancesPerNode=params.get("min_leaf", 1),
                                     featureSubsetStrategy=params.get("feature_subset", "onethird"),
                                     bootstrap=params.get("bootstrap", True))
    if kind == "huber":
        return LinearRegression(labelCol=label, featuresCol=features, loss="huber",
                                epsilon=params.get("epsilon", 1.35),
                                regParam=params.get("reg", 0.0), elasticNetParam=0.0)
    if kind == "ridge":
        return LinearRegression(labelCol=label, featuresCol=features, solver="normal",
                                regParam=params.get("reg", 0.0), elasticNetParam=0.0,
                                standardization=False)
    raise ValueError(f"unknown model kind {kind!r}")


# ------------------------------------------------------------------ dense net (M8, M9)

ACTIVATIONS = ("relu", "leaky_relu", "gelu", "silu", "tanh")


def _act(name: str, z: np.ndarray) -> np.ndarray:
    if name == "relu":
        return np.maximum(z, 0.0)
    if name == "leaky_relu":
        return np.where(z > 0, z, 0.1 * z)
    if name == "tanh":
        return np.tanh(z)
    if name == "silu":
        return z / (1.0 + np.exp(-z))
    if name == "gelu":
        return 0.5 * z * (1.0 + np.tanh(np.sqrt(2.0 / np.pi) * (z + 0.044715 * z ** 3)))
    raise ValueError(name)


def _act_grad(name: str, z: np.ndarray) -> np.ndarray:
    if name == "relu":
        return (z > 0).astype(float)
    if name == "leaky_relu":
        return np.where(z > 0, 1.0, 0.1)
    if name == "tanh":
        return 1.0 - np.tanh(z) ** 2
    if name == "silu":
        s = 1.0 / (1.0 + np.exp(-z))
        return s * (1.0 + z * (1.0 - s))
    if name == "gelu":
        k = np.sqrt(2.0 / np.pi)
        t = np.tanh(k * (z + 0.044715 * z ** 3))
        return 0.5 * (1.0 + t) + 0.5 * z * (1.0 - t ** 2) * k * (1.0 + 3 * 0.044715 * z ** 2)
    raise ValueError(name)


def init_dense(n_in: int, layers: Sequence[int], seed: int = 0) -> list[np.ndarray]:
    """Weights as a flat list [W1, b1, ..., Wout, bout] (He-uniform-like)."""
    rng = np.random.default_rng(seed)
    sizes = [n_in, *layers, 1]
    ws = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        bound = np.sqrt(6.0 / max(a, 1)) / 2
        ws += [rng.uniform(-bound, bound, size=(a, b)), np.zeros(b)]
    return ws


def dense_forward(x: np.ndarray, ws: Sequence[np.ndarray], activation: str = "relu",
                  keep: bool = False):
    h, cache = x, []
    n_layers = len(ws) // 2
    for i in range(n_layers):
        z = h @ ws[2 * i] + ws[2 * i + 1]
        cache.append((h, z))
        h = z if i == n_layers - 1 else _act(activation, z)
    return (h[:, 0], cache) if keep else h[:, 0]


def dense_grad(x: np.ndarray, t: np.ndarray, ws: Sequence[np.ndarray], activation: str,
               loss: str = "mse", beta: float = 0.5):
    """Summed loss and summed gradients over the rows of one batch."""
    out, cache = dense_forward(x, ws, activation, keep=True)
    r = out - t
    if loss == "smooth_l1":
        small = np.abs(r) < beta
        lval = np.where(small, 0.5 * r ** 2 / beta, np.abs(r) - 0.5 * beta).sum()
        g = np.where(small, r / beta, np.sign(r))
    else:
        lval = (r ** 2).sum()
        g = 2.0 * r
    grads = [None] * len(ws)
    delta = g[:, None]
    n_layers = len(ws) // 2
    for i in reversed(range(n_layers)):
        h, z = cache[i]
        if i != n_layers - 1:
            delta = delta * _act_grad(activation, z)
        grads[2 * i] = h.T @ delta
        grads[2 * i + 1] = delta.sum(axis=0)
        delta = delta @ ws[2 * i].T
    return float(lval), grads


def oof_linear_wide(df: DataFrame, key: str, y: str, models: dict[str, Sequence[str]],
                    fold: str, alpha: float = 0.0, keep: Sequence[str] = (),
                    prefix: str = "p_") -> DataFrame:
    """E4 for several moment models at once: one moment pass over the union
    of their features, one k-row coefficient table, one broadcast join."""
    xs = sorted({x for v in models.values() for x in v})
    center = df.agg(*[F.avg(c).alias(c) for c in [y, *xs]]).first().asDict()
    rows = moment_table(df, y, xs, [fold], center).collect()
    per = {r[fold]: Moments.from_row(r, y, xs) for r in rows}
    total = None
    for m in per.values():
        total = m if total is None else total + m
    cols, out = [fold], []
    for name, mx in models.items():
        cols.append(f"{name}__b0")
        cols += [f"{name}__{x}" for x in mx]
    for f, m in sorted(per.items()):
        tr = total - m
        row = [int(f)]
        for name, mx in models.items():
            idx = [xs.index(x) for x in mx]
            sub = Moments(tr.n, tr.sx[idx], tr.sy, tr.sxx[np.ix_(idx, idx)], tr.sxy[idx], tr.syy)
            b0, beta = ridge_from_moments(sub, alpha)
            b0 = b0 + center[y] - float(sum(beta[i] * center[x] for i, x in enumerate(mx)))
            if not mx and tr.raw_mean() is not None:
                b0 = tr.raw_mean()  # M1: the training mean, from uncentred sums
            row += [float(b0), *[float(b) for b in beta]]
        out.append(tuple(row))
    schema = ", ".join([f"`{fold}` int"] + [f"`{c}` double" for c in cols[1:]])
    coefs = df.sparkSession.createDataFrame(out, schema)
    j = df.join(F.broadcast(coefs), fold)  # k rows
    preds = [linear_predict(mx, F.col(f"{name}__b0"), [F.col(f"{name}__{x}") for x in mx])
             .alias(f"{prefix}{name}") for name, mx in models.items()]
    return j.select(key, fold, y, *keep, *preds)
