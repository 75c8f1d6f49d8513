"""Out-of-fold tables of several learners, nested bagging and the final blend, against numpy least squares."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import blend as B
from tabspark.operators import candidates as C
from tabspark.operators import champion as H

K, INNER = 3, 2


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    out = []
    for i in range(240):
        a, b = rng.gauss(5, 2), rng.gauss(10, 3)
        out.append((i, i % 4, (i // 4) % K, a, b, 3 * a + b * b / 4 + rng.gauss(0, 1), i % 7))
    return spark.createDataFrame(out, "k long, bin int, fold int, a double, b double, y double, `odd.name` int").cache()


@pytest.fixture(scope="module")
def members():
    return {m: C.candidate("ridge", "k", [m], "y") for m in ("a", "b")}


def line(x, y):
    slope, intercept = np.polyfit(x, y, 1)
    return lambda z: intercept + slope * z


def arrays(df, *names):
    data = df.orderBy("k").collect()
    return [np.array([r[n] for r in data]) for n in names]


def test_out_of_fold_of_several_learners(rows, members):
    got = H.out_of_fold(rows, "fold", K, members)
    assert got.columns == [*rows.columns, "p_a", "p_b"] and got.count() == 240
    fold, y, a, b, pa, pb = arrays(got, "fold", "y", "a", "b", "p_a", "p_b")
    for f in range(K):
        t = fold != f
        assert np.allclose(pa[~t], line(a[t], y[t])(a[~t])) and np.allclose(pb[~t], line(b[t], y[t])(b[~t]))


def test_learners_with_nulls_winsor_and_rows_without_fold(spark, rows):
    holed = rows.withColumn("a", F.when(F.col("k") % 5 > 0, F.col("a"))).withColumn("fold", F.when(F.col("k") != 0, F.col("fold")))
    learn = C.candidate("rf", "k", ["a", "b"], "y", "log", winsorize=True, scaler="robust", trees=3)
    got = H.out_of_fold(holed.withColumn("y", F.abs("y")), "fold", K, {"rf": learn})
    assert got.count() == 239 and got.filter("p_rf is null or isnan(p_rf)").count() == 0
    # the given columns come back untouched: neither imputed, clipped nor scaled
    assert got.drop("p_rf", "y").exceptAll(holed.drop("y")).count() == 0


def test_nested_bagging_and_direct_weights(spark, rows, members):
    nested = H.with_inner_folds(rows, "k", "bin", "fold", K, INNER, 11)
    fold, inner = arrays(nested, "fold", "inner")
    for o in range(K):
        of = [v[o] for v in inner]
        assert all((v is None) == (f == o) for v, f in zip(of, fold))
        sizes = np.bincount([v for v in of if v is not None])
        assert len(sizes) == INNER and sizes.max() - sizes.min() <= 4  # one row a stratum
    direct = H.out_of_fold(nested, "fold", K, members)
    bagged = H.nested_bag(direct, "fold", K, INNER, members)
    fold, inner, y, a, pa, ba = arrays(bagged, "fold", "inner", "y", "a", "p_a", "b_a")
    for o in range(K):
        of, held = np.array([v[o] if v[o] is not None else -1 for v in inner]), fold == o
        mean = np.mean([line(a[~held & (of != i)], y[~held & (of != i)])(a[held]) for i in range(INNER)], axis=0)
        assert np.allclose(ba[held], mean)
    w = H.direct_weights(bagged, "y", ["a", "b"])
    best = B.grid_blend(bagged, "p_a", "b_a", "y", steps=100).first()
    assert w["a"]["weight"] == best.weight and w["a"]["rmse"] == pytest.approx(best.rmse)
    assert w["a"]["rmse_direct"] == pytest.approx(np.sqrt(np.mean((pa - y) ** 2)))
    assert w["a"]["rmse_bag"] == pytest.approx(np.sqrt(np.mean((ba - y) ** 2)))


def test_equal_predictions_take_the_smaller_weight(spark):
    same = spark.createDataFrame([(1.0, 2.0, 2.0), (3.0, 1.0, 1.0)], "y double, p_m double, b_m double")
    assert H.direct_weights(same, "y", ["m"])["m"]["weight"] == 0.0


def test_champion_against_numpy(spark, rows, members):
    train, test = rows.filter("k < 200"), rows.filter("k >= 200").drop("y", "fold", "bin")
    swap = spark.createDataFrame([(205, 50.0), (210, -1e6)], "k long, pred double")
    more = members | {"c": C.candidate("ridge", "k", ["a", "b"], "y")}
    scored, report = H.champion(train, test, "k", "y", "bin", "fold", K, more, ["a", "c"], INNER, seeds=(1, 2), replacements={"b": swap, "a": swap})
    assert scored.columns[:len(test.columns)] == test.columns and scored.count() == 40
    y, fold = arrays(train, "y", "fold")
    x, xt = np.stack(arrays(train, "a", "b"), 1), np.stack(arrays(test, "a", "b"), 1)
    own = {"a": [0], "b": [1], "c": [0, 1]}

    def fit(m, t):
        z = np.c_[np.ones(t.sum()), x[t][:, own[m]]]
        beta = np.linalg.lstsq(z, y[t], rcond=None)[0]
        return lambda v: np.c_[np.ones(len(v)), v[:, own[m]]] @ beta
    oof, mean = {m: np.zeros(200) for m in own}, {}
    for m in own:
        for f in range(K):
            oof[m][fold == f] = fit(m, fold != f)(x[fold == f])
        mean[m] = np.mean([fit(m, fold != f)(xt) for f in range(K)], axis=0)
    assert set(report["kept"]) <= set(own) and sum(report["kept"].values()) == pytest.approx(1.0)
    assert set(report["nested"]) == {m for m in ("a", "c") if report["weights"][m] > 1e-4}
    key = np.array([r.k for r in scored.orderBy("k").collect()])
    raw, blend = np.zeros(40), np.zeros(200)
    for m, w in report["kept"].items():
        d = report["nested"][m]["weight"] if m in report["nested"] else 0.0
        p = d * fit(m, np.ones(200, bool))(xt) + (1 - d) * mean[m]
        if m in ("a", "b"):
            p = np.where(key == 205, 50.0, np.where(key == 210, -1e6, p))
        assert np.allclose(arrays(scored, f"t_{m}")[0], p)
        raw, blend = raw + w * p, blend + w * oof[m]
    calibrated = line(blend, y)
    assert report["slope"] == pytest.approx(calibrated(1.0) - calibrated(0.0))
    pred = arrays(scored, "pred")[0]
    assert np.allclose(pred, np.maximum(calibrated(raw), 0.0)) and (pred >= 0).all()


def test_learners_of_one_table_share_its_preparation(spark, monkeypatch):
    from tabspark.operators import candidates, prep
    calls, real = [], prep.fit_numeric
    monkeypatch.setattr(prep, "fit_numeric", lambda *a, **b: calls.append(1) or real(*a, **b))
    df = spark.createDataFrame([(i, float(i % 7), float(i)) for i in range(60)], "k long, x double, y double")
    learners = [candidates.candidate("ridge", "k", ["x"], "y"), candidates.candidate("rf", "k", ["x"], "y", trees=2, max_depth=2)]
    assert len(H.fit_all({i: (df, learn, 0) for i, learn in enumerate(learners)})) == 2
    assert len(calls) == 1
