"""Hold-out, k-fold and out-of-fold evaluation.

The fold table is persisted once and every fold's fit reads it; predictions
of all folds are unioned into one OOF table keyed by (key[, repeat, model]).
Driver loops run k (or k x repeats) Spark fits -- the number of jobs depends
on the parameters, not on the data size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cache, materialize
from .metrics import metric_aggs
from .models import assemble, dense_forward, dense_grad, init_dense, make_estimator

FitPredict = Callable[[DataFrame, DataFrame], DataFrame]
"""(train rows, rows to score) -> rows to score with a ``pred`` column."""


def rescore(df: DataFrame, key: str, features: Sequence[str], model_paths: Sequence[str],
            target_mode: str = "raw", power: float | None = None, fold: str | None = None) -> DataFrame:
    """E5: score rows with stored fold/seed models, whose metadata say how to read them.

    Without ``fold`` the models' predictions are averaged (A20); with it, row by row the model
    of the row's fold answers (the OOF form), one pass over the rows either way."""
    from pyspark.ml.util import DefaultParamsReader

    from ..functions.target import inverse_target
    spark = df.sparkSession
    cur = assemble(df, features)
    own = [F.col(f"`{c}`") for c in cur.columns]
    names = [f"__p{i}" for i in range(len(model_paths))]
    for i, path in enumerate(model_paths):
        scored = DefaultParamsReader.loadParamsInstance(path, spark).transform(cur)
        cur = scored.select(*own, *names[:i], inverse_target("prediction", target_mode, power).alias(names[i]))
    if fold is None:
        return cur.select(key, (sum(F.col(n) for n in names) / F.lit(float(len(names)))).alias("pred"))
    return cur.select(key, fold, F.coalesce(*[F.when(F.col(fold) == i, F.col(n)) for i, n in enumerate(names)]).alias("pred"))


def holdout_eval(df: DataFrame, y: str, split: str, fit_predict: FitPredict) -> DataFrame:
    """Fit on dev, metrics on dev (train) and test (validation)."""
    dev = df.filter(F.col(split) == "dev")
    scored = fit_predict(dev, df)
    return scored.groupBy(split).agg(*metric_aggs(y, "pred"))


def oof_predictions(df: DataFrame, key: str, y: str, fold: str, k: int,
                    fit_predict: FitPredict, extra: DataFrame | None = None,
                    progress: Callable[[float], None] | None = None) -> DataFrame:
    """Each row is predicted by the model that did not see its fold.

    ``extra`` (e.g. a test table) is scored by every fold model and averaged
    (A20).  ``progress`` is called with the running mean fold RMSE (E2)."""
    base = cache(df)
    parts, extras, rmses = [], [], []
    for f in range(k):
        train = base.filter(F.col(fold) != f)
        val = base.filter(F.col(fold) == f)
        scored = materialize(fit_predict(train, val).select(key, fold, y, "pred"))
        parts.append(scored)
        if extra is not None:
            extras.append(materialize(fit_predict(train, extra).select(key, "pred")))
        if progress:
            rmses.append(scored.agg(F.sqrt(F.avg((F.col(y) - F.col("pred")) ** 2))).first()[0])
            progress(float(np.mean(rmses)))
    base.unpersist()  # every result above is written; nothing reads the cache any more
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    if extra is None:
        return oof
    test = extras[0]
    for p in extras[1:]:
        test = test.unionByName(p)
    return oof, test.groupBy(key).agg(F.avg("pred").alias("pred"))


def fold_metrics(oof: DataFrame, y: str, fold: str, pred: str = "pred",
                 by: Sequence[str] = ()) -> DataFrame:
    """E2/E3 per-fold rows; E6 pooled is ``regression_metrics`` on ``oof``."""
    return oof.groupBy(*by, fold).agg(*metric_aggs(y, pred))


def ml_fit_predict(kind: str, features: Sequence[str], y: str, seed: int = 0,
                   target_mode: str = "raw", power: float | None = None,
                   **params) -> FitPredict:
    """M5-M7 (+M11 target mode) as a FitPredict for the OOF loop."""
    from ..functions.target import forward_target, inverse_target

    def run(train: DataFrame, score: DataFrame) -> DataFrame:
        tr = assemble(train.withColumn("label", forward_target(y, target_mode, power)), features)
        model = make_estimator(kind, seed=seed, **params).fit(tr)
        out = model.transform(assemble(score, features))
        return out.withColumn("pred", inverse_target("prediction", target_mode, power)) \
                  .drop("features", "prediction")
    return run


def seed_ensemble(fit_predicts: Sequence[FitPredict]) -> FitPredict:
    """Same config under several seeds, mean prediction."""
    def run(train: DataFrame, score: DataFrame) -> DataFrame:
        cols = score.columns
        preds = [fp(train, score).select(*cols, F.col("pred").alias(f"_p{i}"))
                 for i, fp in enumerate(fit_predicts)]
        out = preds[0]
        for i, p in enumerate(preds[1:], start=1):
            out = out.join(p.select(cols[0], f"_p{i}"), cols[0])
        mean = sum(F.col(f"_p{i}") for i in range(len(preds))) / F.lit(float(len(preds)))
        return out.withColumn("pred", mean).drop(*[f"_p{i}" for i in range(len(preds))])
    return run


def repeated_oof(df: DataFrame, key: str, y: str, folds_by_repeat: dict[int, str], k: int,
                 fit_predict: FitPredict) -> tuple[DataFrame, DataFrame]:
    """OOF per repeat (one fold column per repeat), the row mean over
    repeats, RMSE per repeat and of the mean."""
    per = []
    for r, fold in folds_by_repeat.items():
        o = oof_predictions(df, key, y, fold, k, fit_predict)
        per.append(o.select(key, y, F.lit(r).alias("repeat"), "pred"))
    long = per[0]
    for p in per[1:]:
        long = long.unionByName(p)
    mean = long.groupBy(key, y).agg(F.avg("pred").alias("pred"))
    scores = long.groupBy("repeat").agg(*metric_aggs(y, "pred")).unionByName(
        mean.agg(*metric_aggs(y, "pred")).withColumn("repeat", F.lit(-1)))
    return mean, scores


# ------------------------------------------------------------------ dense net on Spark


def dense_score(df: DataFrame, features: Sequence[str], weights: Sequence[np.ndarray],
                activation: str = "relu", out: str = "pred") -> DataFrame:
    """M8: vectorised forward pass over Arrow batches; the weights travel
    with the function (their size is the network's, not the data's)."""
    feats = list(features)
    ws = [np.asarray(w, dtype=float) for w in weights]
    schema = f"{', '.join(f'`{c}` {t}' for c, t in df.dtypes)}, `{out}` double"

    def run(batches):
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype=float)
            pdf[out] = dense_forward(x, ws, activation) if len(pdf) else np.zeros(0)
            yield pdf
    return df.mapInPandas(run, schema)


def dense_fit(train: DataFrame, features: Sequence[str], target: str,
              layers: Sequence[int] = (16, 8), activation: str = "relu", epochs: int = 30,
              lr: float = 1e-2, weight_decay: float = 0.0, loss: str = "mse",
              clip_norm: float | None = 5.0, patience: int = 5, min_delta: float = 0.0,
              val: DataFrame | None = None, seed: int = 0, schedule: str = "constant",
              plateau_factor: float = 0.5, plateau_patience: int = 2, unscale: Callable | None = None):
    """M9: full-batch Adam(W); each epoch is one Spark job summing per-partition
    gradients (``mapInPandas`` -> explode -> ``groupBy(pos).sum``), then one
    optimizer step on the driver.  Early stopping on validation RMSE.
    ``schedule``: ``constant``, ``cosine`` (to 0 over ``epochs``) or
    ``plateau`` (rate x ``plateau_factor`` after ``plateau_patience`` epochs
    without a validation improvement).  ``unscale`` turns a scaled target column
    into target units, in which validation errors are then measured.

    Returns (weights, history rows, best_epoch)."""
    feats = list(features)
    ws = init_dense(len(feats), layers, seed)
    shapes = [w.shape for w in ws]
    sizes = [int(np.prod(s)) for s in shapes]
    m = [np.zeros_like(w) for w in ws]
    v = [np.zeros_like(w) for w in ws]
    data = cache(train.select(*feats, target))
    n = data.count()
    base_lr, since_drop = lr, 0
    best, best_ws, best_epoch, stale, history = np.inf, ws, 0, 0, []
    for epoch in range(1, epochs + 1):
        if schedule == "cosine":
            lr = 0.5 * base_lr * (1.0 + np.cos(np.pi * (epoch - 1) / max(epochs, 1)))
        elif schedule == "plateau" and since_drop >= plateau_patience:
            lr, since_drop = lr * plateau_factor, 0
        cur = [w.copy() for w in ws]

        def grads(batches, cur=cur):
            total = np.zeros(1 + sum(sizes))  # one row per weight and task, however many batches it has
            for pdf in batches:
                if len(pdf):
                    lval, g = dense_grad(pdf[feats].to_numpy(dtype=float), pdf[target].to_numpy(dtype=float), cur, activation, loss)
                    total += np.concatenate([[lval], *[gi.ravel() for gi in g]])
            yield pd.DataFrame({"pos": np.arange(len(total)), "v": total})
        summed = (data.mapInPandas(grads, "pos long, v double")
                  .groupBy("pos").agg(F.sum("v").alias("v")).collect())
        vec = np.zeros(sum(sizes) + 1)
        for r in summed:
            vec[r.pos] = r.v
        train_loss = vec[0] / n
        flat = vec[1:] / n
        if clip_norm:
            norm = np.linalg.norm(flat)
            if norm > clip_norm:
                flat = flat * (clip_norm / norm)
        off, g = 0, []
        for s, sz in zip(shapes, sizes):
            g.append(flat[off:off + sz].reshape(s))
            off += sz
        b1, b2 = 0.9, 0.999
        for i in range(len(ws)):
            m[i] = b1 * m[i] + (1 - b1) * g[i]
            v[i] = b2 * v[i] + (1 - b2) * g[i] ** 2
            mh, vh = m[i] / (1 - b1 ** epoch), v[i] / (1 - b2 ** epoch)
            ws[i] = ws[i] * (1 - lr * weight_decay) - lr * mh / (np.sqrt(vh) + 1e-8)
        row = {"epoch": epoch, "train_loss": float(train_loss), "learning_rate": lr}
        if val is not None:
            scored = dense_score(val.select(*feats, target), feats, ws, activation)
            units = unscale or (lambda c: c)
            vr = scored.agg(F.sqrt(F.avg((units(F.col(target)) - units(F.col("pred"))) ** 2))).first()[0]
            row["val_rmse"] = float(vr)
            if vr < best - min_delta:
                best, best_ws, best_epoch, stale, since_drop = vr, [w.copy() for w in ws], epoch, 0, 0
            else:
                stale += 1
                since_drop += 1
        else:
            best_ws, best_epoch = [w.copy() for w in ws], epoch
        history.append(row)
        if val is not None and stale >= patience:
            break
    data.unpersist()
    return best_ws, history, best_epoch
