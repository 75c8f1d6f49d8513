"""Fitted transforms, models, blends: parity with numpy and invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import blend as B
from tabspark.operators import prep as P
from tabspark.operators.models import (dense_forward, fit_linear, init_dense, oof_linear,
                                       ridge_from_moments)
from tabspark.operators.quantiles import column_quantiles
from tabspark.operators.quality import schema_check
from tabspark.sources.tables import docs

from .conftest import SF_SMALL


def _table(spark, n=100, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = float(rng.normal(10, 3))
        z = None if i % 7 == 0 else float(rng.normal(0, 1))
        y = 3.0 * x + (z or 0.0) + float(rng.normal(0, 0.1))
        rows.append((i, x, z, y, ["a", "b", "c"][i % 3]))
    return spark.createDataFrame(rows, "k long, x double, z double, y double, cat string")


def test_exact_quantiles_match_numpy(spark):
    df = _table(spark)
    pdf = df.toPandas()
    q = {(r.column, r.p): r.value for r in column_quantiles(df, ["x", "z"], [0.005, 0.25, 0.5, 0.995], "k").collect()}
    for c in ("x", "z"):
        vals = pdf[c].dropna().to_numpy()
        for p in (0.005, 0.25, 0.5, 0.995):
            assert np.isclose(q[(c, p)], np.quantile(vals, p))


def test_numeric_pipeline_matches_numpy(spark):
    df = _table(spark)
    m = P.fit_numeric(df, ["x", "z"], "k")
    out = P.apply_numeric(df, m).toPandas().sort_values("k")
    pdf = df.toPandas().sort_values("k")
    z = pdf.z.fillna(pdf.z.median())
    assert m.indicators == ["z"]
    assert np.allclose(out.z, (z - z.mean()) / z.std(ddof=0))
    ind = pdf.z.isna().astype(float)
    assert np.allclose(out.missingindicator_z, (ind - ind.mean()) / ind.std(ddof=0))


def test_constant_all_null_and_nan_columns(spark):
    df = spark.createDataFrame([(1, 5.0, None, 1.0), (2, 5.0, None, float("nan")), (3, 5.0, None, 3.0)],
                               "k long, c double, n double, m double")
    m = P.fit_numeric(df, ["c", "n", "m"], "k")
    assert m.output_cols == ["c", "m", "missingindicator_n", "missingindicator_m"]
    rows = P.apply_numeric(df, m).select(*m.output_cols).collect()
    assert all(r.c == 0.0 and r.missingindicator_n == 0.0 for r in rows)   # zero variance -> 0
    assert rows[1].m == 0.0                                                # NaN imputed by the median


def test_apply_never_adds_or_drops_rows(spark):
    df = _table(spark)
    m = P.fit_numeric(df, ["x", "z"], "k", winsorize=True, scaler="robust")
    d = P.fit_onehot(df, ["cat"], min_frequency=40)
    assert P.apply_numeric(df, m).count() == df.count()
    assert P.onehot_slots(df, d, "cat").count() == df.count()
    assert P.onehot_columns(df, d)[0].count() == df.count()


def test_fit_ignores_validation_rows(spark):
    """Leakage: changing rows outside the fit set leaves the parameters unchanged."""
    df = _table(spark).withColumn("split", F.when(F.col("k") < 80, "dev").otherwise("test"))
    changed = df.withColumn("x", F.when(F.col("split") == "test", F.lit(1e9)).otherwise(F.col("x")))
    a = P.fit_numeric(df.filter("split = 'dev'"), ["x", "z"], "k").scale.values()
    b = P.fit_numeric(changed.filter("split = 'dev'"), ["x", "z"], "k").scale.values()
    assert a == b


def test_unknown_category_is_tolerated(spark):
    df = _table(spark)
    d = P.fit_onehot(df, ["cat"], min_frequency=None)
    new = spark.createDataFrame([(1, "a"), (2, "zzz"), (3, None)], "k long, cat string")
    wide, names = P.onehot_columns(new, d)
    rows = {r.k: [r[n] for n in names] for r in wide.collect()}
    assert rows[1] == [1.0, 0.0, 0.0] and rows[2] == [0.0, 0.0, 0.0] and rows[3] == [0.0, 0.0, 0.0]
    slots = {r.k: r.slot for r in P.onehot_slots(new, d, "cat").collect()}
    assert slots == {1: 0, 2: -1, 3: -1}
    code = new.select("k", P.ordinal_code("cat", ["Missing", "a", "b"]).alias("c")).collect()
    assert {r.k: r.c for r in code} == {1: 1.0, 2: -1.0, 3: 0.0}


def test_rare_levels_share_one_slot(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["a"] * 5 + ["b"] * 5 + ["c", "d"])],
                               "k long, cat string")
    d = {r.level: (r.slot, r.rare) for r in P.fit_onehot(df, ["cat"], min_frequency=2).collect()}
    assert d == {"a": (0, False), "b": (1, False), "c": (2, True), "d": (2, True)}


def test_missing_feature_raises(spark):
    df = _table(spark)
    with pytest.raises(ValueError, match="missing=\\['w'\\]"):
        schema_check(df.drop("y"), ["k", "x", "z", "cat", "w"])


def test_moment_ols_equals_lstsq(spark):
    df = _table(spark).na.fill(0.0)
    b0, beta = fit_linear(df, "y", ["x", "z"])
    pdf = df.toPandas()
    a = np.column_stack([np.ones(len(pdf)), pdf.x, pdf.z])
    ref = np.linalg.lstsq(a, pdf.y, rcond=None)[0]
    assert np.allclose([b0, *beta], ref)


def test_ridge_closed_form(spark):
    from tabspark.operators.models import Moments
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 2))
    y = x @ [1.0, -2.0] + 3
    m = Moments(50.0, x.sum(0), y.sum(), x.T @ x, x.T @ y, y @ y)
    b0, beta = ridge_from_moments(m, alpha=10.0)
    xc, yc = x - x.mean(0), y - y.mean()
    ref = np.linalg.solve(xc.T @ xc + 10 * np.eye(2), xc.T @ yc)
    assert np.allclose(beta, ref) and np.isclose(b0, y.mean() - x.mean(0) @ ref)


def test_oof_each_row_once(spark):
    from tabspark.operators.split import stratified_kfold, target_bins
    d = stratified_kfold(target_bins(docs(spark, SF_SMALL), "n_chars", "doc_id"), "doc_id", "bin", 5, 42)
    o = oof_linear(d, "doc_id", "n_chars", ["n_words"], "fold")
    assert o.count() == d.count() == o.select("doc_id").distinct().count()


def test_simplex_blend_properties(spark):
    rng = np.random.default_rng(2)
    y = rng.normal(100, 10, 300)
    rows = [(float(t), float(t + rng.normal(0, 3)), float(t + rng.normal(0, 6)), float(rng.normal(100, 10)))
            for t in y]
    df = spark.createDataFrame(rows, "y double, a double, b double, c double")
    w = B.fit_simplex_blend(df, ["a", "b", "c"], "y")
    assert abs(sum(w.values()) - 1) < 1e-9 and min(w.values()) >= 0
    mse = lambda col: df.agg(F.avg((F.col("y") - col) ** 2)).first()[0]
    blend = mse(sum(F.lit(v) * F.col(k) for k, v in w.items()))
    assert blend <= min(mse(F.col(c)) for c in "abc") + 1e-9


def test_prune_weights_renormalises(spark):
    w = spark.createDataFrame([("a", 0.7), ("b", 0.3 - 1e-12), ("c", 1e-12)], "model string, weight double")
    out = {r.model: r.weight for r in B.prune_weights(w).collect()}
    assert set(out) == {"a", "b"} and abs(sum(out.values()) - 1) < 1e-12


@pytest.mark.parametrize("schedule", ["cosine", "plateau"])
def test_dense_fit_learns_and_schedules(spark, schedule):
    from tabspark.operators.oof import dense_fit, dense_score
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b), float(0.7 * a - 0.4 * b)) for a, b in rng.normal(size=(400, 2))]
    df = spark.createDataFrame(rows, "a double, b double, t double")
    ws, hist, best = dense_fit(df, ["a", "b"], "t", layers=(8,), epochs=25, lr=0.05,
                               val=df, patience=25, schedule=schedule, loss="smooth_l1")
    rates = [h["learning_rate"] for h in hist]
    assert rates[-1] < rates[0]
    assert hist[-1]["val_rmse"] < hist[0]["val_rmse"]
    pred = dense_score(df, ["a", "b"], ws).agg(F.sqrt(F.avg((F.col("t") - F.col("pred")) ** 2))).first()[0]
    assert np.isclose(pred, min(h["val_rmse"] for h in hist))


def test_dense_net_shape():
    ws = init_dense(12, (16, 8), seed=0)
    assert dense_forward(np.zeros((7, 12)), ws).shape == (7,)
