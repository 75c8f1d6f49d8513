"""Gram matrices, the meta-model register, candidate cross-validation and live pruning."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import candidates as C
from tabspark.operators import gram as G
from tabspark.operators import search as S
from tabspark.operators.prep import fit_onehot


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    out = []
    for i in range(400):
        a, b, c, d = rng.gauss(5, 2), rng.gauss(1000, 3), rng.choice(["x", "y", "z"]), rng.choice(["p", None, "q", f"r{i % 50}"])
        out.append((i, i % 4, a, b, c, d, 3 * a - b + 5 * "xyz".index(c) + rng.gauss(0, 1)))
    return spark.createDataFrame(out, "k long, fold int, a double, b double, c string, d string, y double").cache()


def test_ridge_on_a_design_with_one_hot_columns(spark, rows):
    dictionary = fit_onehot(rows, ["c", "d"])
    design, width = G.nominal_slots(rows, dictionary, ["c", "d"])
    got = {r.k: r.pred for r in G.ridge_design_oof(design, "k", "y", ["a", "b"], "fold", "slots", width, 2, alpha=7.0).collect()}
    data = design.orderBy("k").collect()
    x = np.zeros((400, 2 + width))
    for i, r in enumerate(data):
        x[i, :2] = r.a, r.b
        for s in r.slots:
            if s >= 0:
                x[i, 2 + s] = 1
    y, fold = np.array([r.y for r in data]), np.array([r.fold for r in data])
    for f in range(4):
        t = fold != f
        mx, my = x[t].mean(0), y[t].mean()
        beta = np.linalg.solve((x[t] - mx).T @ (x[t] - mx) + 7.0 * np.eye(x.shape[1]), (x[t] - mx).T @ (y[t] - my))
        for i in np.flatnonzero(fold == f):
            assert got[i] == pytest.approx(my + (x[i] - mx) @ beta, abs=1e-6)
    gs = G.grams(design, "y", ["a", "b"], "fold", "slots", width, 2, center=False)
    z = np.c_[np.ones(400), x, y]
    assert np.allclose(gs.total(), z.T @ z) and np.allclose(gs.folds[2], z[fold == 2].T @ z[fold == 2])


def test_width_nulls_and_rows_without_target(spark, rows, monkeypatch):
    some = rows.withColumn("y", F.when(F.col("k") % 3 > 0, F.col("y")))
    assert G.grams(some, "y", ["a"]).total()[0, 0] == rows.filter("k % 3 > 0").count()
    with pytest.raises(Exception, match="missing value"):
        G.grams(rows.withColumn("a", F.when(F.col("k") > 5, F.col("a"))), "y", ["a"])
    monkeypatch.setattr(G, "MAX_WIDTH", 3)
    with pytest.raises(ValueError, match="wider"):
        G.grams(rows, "y", ["a", "b"])


def test_register_ranks_by_cross_validated_error(spark, rows):
    board, scorer = G.stack_register(rows, "y", "fold", {"ab": ["a", "b"], "a": ["a"], "b": ["b"]}, [0.0, 5.0])
    assert [r["model"] for r in board[:2]] == ["ab", "ab"] and board == sorted(board, key=lambda r: round(r["cv_rmse"], 9))
    data = rows.orderBy("k").collect()
    x, y, fold = np.array([[r.a, r.b] for r in data]), np.array([r.y for r in data]), np.array([r.fold for r in data])
    for r in board:
        own = x[:, ["ab".index(c) for c in r["columns"]]]
        err = 0.0
        for f in [0, 1, 2, 3, None]:
            t = fold != f if f is not None else np.ones(400, bool)
            mx, my = own[t].mean(0), y[t].mean()
            beta = np.linalg.solve((own[t] - mx).T @ (own[t] - mx) + r["alpha"] * np.eye(own.shape[1]), (own[t] - mx).T @ (y[t] - my))
            if f is None:
                scored = [p[0] for p in rows.orderBy("k").select(scorer(r)).collect()]
                assert np.allclose(scored, my + (own - mx) @ beta)
            else:
                err += ((y[~t] - my - (own[~t] - mx) @ beta) ** 2).sum()
        assert r["cv_rmse"] == pytest.approx(np.sqrt(err / 400), rel=1e-9)


def test_boosting_stops_on_validation_rows(spark, rows):
    fit = C.candidate_fit("gbt", "k", ["a", "b"], "y", validation=0.25, rounds=15, max_depth=2, learning_rate=0.9, validation_tol=0.05)
    folds = C.cross_validate(rows, "y", {1: "fold"}, 2, fit, workers=2)
    got = folds.collect()
    assert sorted(r.fold for r in got) == [0, 1] and all(1 <= r.used < 15 and r.r2 > 0 for r in got)
    summary = C.cv_summary(folds)
    assert summary["mean_rmse"] == pytest.approx(statistics.fmean(r.rmse for r in got)) and summary["median_used"] == int(statistics.median(r.used for r in got))


def test_live_pruning_decides_as_a_replay_and_runs_fewer_fits(spark):
    rng = random.Random(6)
    values = {(t, s): (1.0 + t * 0.1 if t >= 4 else 1.0) + rng.random() * 0.3 for t in range(9) for s in range(1, 6)}
    calls = []

    def score(trial, step):
        calls.append((trial, step))
        return spark.range(100).select(F.lit(values[trial, step]).alias("v")).agg(F.max("v")).first()[0]
    log = C.live_pruned(spark, list(range(9)), 5, score, n_startup=3, workers=3, ahead=1)
    df = spark.createDataFrame([(r["trial"], r["step"], r["value"]) for r in log], "trial long, step int, rmse double")
    replay = {r.trial: (r.state == "PRUNED", r.n_steps) for r in S.median_prune(df, 3, 1).collect()}
    live = {t: (any(r["pruned"] for r in log if r["trial"] == t), max(r["step"] for r in log if r["trial"] == t)) for t in range(9)}
    assert live == replay and any(p for p, _ in live.values()) and len(calls) < 45
    assert all(values[r["trial"], r["step"]] == r["value"] for r in log)
    with pytest.raises(ZeroDivisionError):
        C.live_pruned(spark, [0, 1], 2, lambda t, s: 1 / 0)


def test_stored_fold_models_give_the_oof_table_again(spark, rows):
    import tempfile

    from tabspark.operators.models import assemble, make_estimator
    from tabspark.operators.oof import rescore
    root, want, paths = tempfile.mkdtemp(prefix="tabspark-folds-"), {}, []
    for f in range(4):
        model = make_estimator(["gbt", "rf", "ridge", "rf"][f], seed=f, **[{"rounds": 2}, {"trees": 2}, {}, {"trees": 2}][f]).fit(
            assemble(rows.filter(F.col("fold") != f).withColumn("label", F.col("y")), ["a", "b"]))
        paths.append(f"{root}/{f}")
        model.write().save(paths[-1])
        want |= {r.k: r.prediction for r in model.transform(assemble(rows.filter(F.col("fold") == f), ["a", "b"])).collect()}
    assert {r.k: r.pred for r in rescore(rows, "k", ["a", "b"], paths, fold="fold").collect()} == want
    with pytest.raises(Exception):
        rescore(rows, "k", ["a", "b"], [root + "/none"])


def test_net_cross_validation_reports_epochs(spark, rows):
    shifted = rows.withColumn("y", F.col("y") + 1100)
    folds = C.cross_validate(shifted, "y", {0: "fold"}, 2, C.net_fit("k", ["a", "b"], "y", layers=(4,), epochs=4, lr=0.1, patience=2), workers=2)
    assert all(1 <= r.used <= 4 and np.isfinite(r.rmse) for r in folds.collect())
    assert C.refit_epochs(folds, floor=3) >= 3


def test_partial_matrices_of_a_wide_design_are_small(spark):
    width = 600
    totals = np.zeros((width + 2, width + 2))
    G._add(totals, np.array([[1.0, 2.0], [1.0, -3.0]]), np.array([[5], [599]]))
    parts = list(G._blocks({0: totals}))
    assert sum(p.nbytes for p in parts) < totals.nbytes / 100
    back = np.zeros_like(totals)
    for batch in G._summed(parts + parts, width + 2):
        (block,), (at,), (data,) = [batch.column(i).to_pylist() for i in (1, 2, 3)]
        G._add_packed(back.ravel()[block * G.BLOCK_ROWS * (width + 2):(block + 1) * G.BLOCK_ROWS * (width + 2)], at, data)
    assert (back == 2 * totals).all()
