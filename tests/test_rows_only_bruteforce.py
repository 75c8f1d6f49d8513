"""Queries without a SQL statement, checked against brute force on the
smallest driver tables (collected to numpy)."""

import itertools

import numpy as np

from .conftest import SF_SMALL


def _q(name):
    import __spark_entry__ as entry
    return entry.queries()[name]


def test_dense_score_equals_numpy_forward(spark):
    from tabspark.operators.models import dense_forward, init_dense
    from tabspark.plans.catalogue_ml import _dense_inputs
    x, feats, get = _dense_inputs(spark, SF_SMALL)
    pdf = x.select("doc_id", *feats).toPandas().sort_values("doc_id")
    z = dense_forward(pdf[feats].to_numpy(float), init_dense(len(feats), (16, 8), seed=0))
    center = get("n_chars", "center")
    scale = get("n_chars", "scale")
    c = spark.range(1).select(center.alias("c"), scale.alias("s")).first()
    expected = np.maximum(np.expm1(z * c.s + c.c), 0.0)
    got = _q("dense_score")(spark, SF_SMALL).toPandas().sort_values("doc_id")
    assert np.allclose(got.pred.to_numpy(), expected, atol=1e-3, rtol=1e-9)


def _oof_numpy(spark):
    from tabspark.plans.catalogue_models import oof_base
    o = oof_base(spark, SF_SMALL).toPandas()
    return o, o[["p_words", "p_lines", "p_mean"]].to_numpy(), o.n_chars.to_numpy(float)


def test_nnls_blend_equals_active_set_enumeration(spark):
    o, p, y = _oof_numpy(spark)
    got = {r.model: (r.weight, r.intercept) for r in _q("nnls_blend")(spark, SF_SMALL).collect()}
    best = None
    for k in range(0, 4):
        for subset in itertools.combinations(range(3), k):
            a = np.column_stack([np.ones(len(y))] + [p[:, j] for j in subset])
            coef = np.linalg.lstsq(a, y, rcond=None)[0]
            if (coef[1:] < -1e-9).any():
                continue
            sse = ((a @ coef - y) ** 2).sum()
            if best is None or sse < best[0] - 1e-6:
                w = np.zeros(3)
                w[list(subset)] = coef[1:]
                best = (sse, coef[0], w)
    names = ["p_words", "p_lines", "p_mean"]
    for j, n in enumerate(names):
        assert np.isclose(got[n][0], best[2][j], atol=1e-4)
    assert np.isclose(got["p_words"][1], best[1], atol=1e-2)


def test_stable_blend_equals_per_fold_numpy(spark):
    from tabspark.operators.blend import simplex_weights
    o, p, y = _oof_numpy(spark)
    ws, sse = [], 0.0
    for f in sorted(o.fold.unique()):
        tr, va = o.fold.to_numpy() != f, o.fold.to_numpy() == f
        g = p[tr].T @ p[tr] / tr.sum()
        c = p[tr].T @ y[tr] / tr.sum()
        w = simplex_weights(g, c)
        ws.append(w)
        sse += ((p[va] @ w - y[va]) ** 2).sum()
    w = np.mean(ws, axis=0)
    w /= w.sum()
    got = {r.model: (r.weight, r.cv_rmse) for r in _q("stable_blend")(spark, SF_SMALL).collect()}
    for j, n in enumerate(["p_words", "p_lines", "p_mean"]):
        assert np.isclose(got[n][0], w[j], atol=1e-5)
    assert np.isclose(got["p_words"][1], np.sqrt(sse / len(y)), rtol=1e-6)
