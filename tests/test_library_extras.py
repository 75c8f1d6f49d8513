"""Router, guarded joins, template fill, prefix check, stored-model rescoring,
search-log operators and streaming scoring."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.functions.features import FeatureSpec
from tabspark.operators import blend as B
from tabspark.operators import search as S
from tabspark.operators.design import PreprocessConfig, fit_preprocessor
from tabspark.operators.infer import apply_output_template, check_prefix, with_row_index
from tabspark.operators.joins import join_one_to_one
from tabspark.operators.models import assemble, make_estimator
from tabspark.operators.oof import rescore

from .conftest import SF_SMALL


def _houses(spark):
    rows = [(i, float(50 + i % 17), None if i % 9 == 0 else float(i % 5),
             ["Ex", "Gd", "TA", None][i % 4], ["N1", "N2", "N3"][i % 3], float(100 + 3 * i))
            for i in range(60)]
    return spark.createDataFrame(
        rows, "Id long, Area double, Rooms double, Qual string, Hood string, Price double")


def test_router_widths_and_unknowns(spark):
    df = _houses(spark)
    cfg = PreprocessConfig(feature_engineering=False, add_log_features=False, encoding="ordinal")
    fitted = fit_preprocessor(df, "Id", "Price", FeatureSpec(), cfg,
                              {"Qual": ["Missing", "TA", "Gd", "Ex"]})
    x, names = fitted.transform(df)
    assert names[:3] == ["Area", "Rooms", "missingindicator_Rooms"]
    assert "Qual" in names and "Hood_N1" in names and "Price" not in names
    new = spark.createDataFrame([(1000, 55.0, None, "Po", "N9", None)], df.schema)
    y, _ = fitted.transform(new)
    arr = y.select(F.col("features")).first()[0].toArray()
    assert len(arr) == len(names) and np.isfinite(arr).all()
    numeric_only = fit_preprocessor(df, "Id", "Price", FeatureSpec(),
                                    PreprocessConfig(False, False, numeric_only=True))
    assert numeric_only.transform(df)[1] == ["Area", "Rooms", "missingindicator_Rooms"]


def test_join_one_to_one_guard(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, a string")
    b = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k long, b double")
    with pytest.raises(ValueError, match="right side"):
        join_one_to_one(a, b, "k")
    assert join_one_to_one(a, b.limit(1), "k").count() == 1


def test_template_fill_and_prefix(spark):
    t = with_row_index(spark.range(10, 0, -1).select(F.col("id").alias("Id")))
    pred = t.select("Id", (F.col("Id") * 2.0).alias("Prediction")).repartition(3)
    out = apply_output_template(pred, t)
    assert [r.Id for r in out.collect()] == list(range(10, 0, -1))
    head = t.filter(F.col("Id") > 6).select("Id", "row_index")
    assert check_prefix(head, t, "Id")
    with pytest.raises(ValueError):
        apply_output_template(pred.filter("Id > 1"), t)


def test_rescore_stored_models(spark):
    df = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") % 10).cast("double").alias("x"))
    df = df.withColumn("label", F.col("x") * 3 + 1)
    root = tempfile.mkdtemp(prefix="tabspark-models-")
    paths = []
    for seed in (1, 2):
        m = make_estimator("rf", seed=seed, trees=5, max_depth=4).fit(assemble(df, ["x"]))
        p = os.path.join(root, f"rf_{seed}")
        m.write().overwrite().save(p)
        paths.append(p)
    out = rescore(df, "k", ["x"], paths)
    assert out.count() == 200 and out.filter(F.col("pred").isNull()).count() == 0


def test_signature_flatten_and_counts(spark):
    from tabspark.functions.config import flatten_struct, signature
    from tabspark.operators.metrics import value_counts
    df = spark.createDataFrame([(1, ("a", (2, 3.0)))], "id int, cfg struct<name:string, m:struct<d:int, lr:double>>")
    flat = flatten_struct(df)
    assert flat.columns == ["id", "cfg.name", "cfg.m.d", "cfg.m.lr"]
    a = df.select(signature(F.col("cfg.m")).alias("s")).first().s
    b = spark.createDataFrame([((2, 3.0),)], "m struct<d:int, lr:double>").select(signature("m")).first()[0]
    assert a == b and len(a) == 10
    states = spark.createDataFrame([("COMPLETE",), ("PRUNED",), ("COMPLETE",)], "state string")
    assert value_counts(states, "state", as_map=True).first().counts == {"COMPLETE": 2, "PRUNED": 1}


def test_index_categories_and_error_report(spark):
    from tabspark.operators.design import index_categories
    from tabspark.operators.infer import error_report
    from tabspark.operators.quality import same_columns
    df = spark.createDataFrame([(i, ["x", "y", None][i % 3], float(i), float(i) + (i % 4)) for i in range(40)],
                               "k long, c string, y double, p double").fillna({"c": "__MISSING__"})
    model = index_categories(df, ["c"])
    new = spark.createDataFrame([(100, "zzz", 1.0, 1.0)], df.schema)
    assert model.transform(new).first().c_idx == 3.0  # unseen level: the extra bucket
    rep = error_report(df, "y", "p", "k", df.select("k", "c"))
    assert rep["metrics"].first().n == 40
    assert rep["by_quartile"].count() == 4 and rep["worst"].count() == 10
    with pytest.raises(ValueError):
        same_columns(df, df.select("k", "y"))


def test_quality_report_dict(spark):
    from tabspark.operators.quality import quality_report
    from tabspark.sources.tables import docs
    rep = quality_report(docs(spark, SF_SMALL), "doc_id", "n_chars")
    assert rep["rows"] == 200 and rep["duplicate_ids"] == 0
    assert rep["columns_with_missing"] == 2 and set(rep["missing_rates"]) == {"quality", "toxic"}
    assert rep["target_skew"] > 0 and rep["target_min"] <= rep["target_median"] <= rep["target_max"]
    assert len(rep["top_iqr_outliers"]) <= 15


def test_repeated_oof_mean_and_scores(spark):
    from tabspark.operators.models import fit_linear, linear_predict
    from tabspark.operators.oof import repeated_oof
    from tabspark.operators.split import stratified_kfold, target_bins
    from tabspark.sources.tables import docs
    d = target_bins(docs(spark, SF_SMALL), "n_chars", "doc_id")
    d = stratified_kfold(d, "doc_id", "bin", 5, 1, out="f1")
    d = stratified_kfold(d, "doc_id", "bin", 5, 2, out="f2")

    def fit_predict(train, score):
        b0, beta = fit_linear(train, "n_chars", ["n_words"])
        return score.withColumn("pred", linear_predict(["n_words"], b0, beta))
    mean, scores = repeated_oof(d, "doc_id", "n_chars", {0: "f1", 1: "f2"}, 5, fit_predict)
    assert mean.count() == 200
    s = {r.repeat: r.rmse for r in scores.collect()}
    assert set(s) == {0, 1, -1} and s[-1] <= max(s[0], s[1]) + 1e-9


def test_seed_ensemble_is_member_mean(spark):
    from tabspark.operators.oof import ml_fit_predict, seed_ensemble
    df = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") % 13).cast("double").alias("x"))
    df = df.withColumn("y", F.col("x") * 2 + (F.col("k") % 3))
    members = [ml_fit_predict("rf", ["x"], "y", seed=s, trees=4, max_depth=3) for s in (1, 2)]
    ens = {r.k: r.pred for r in seed_ensemble(members)(df, df).select("k", "pred").collect()}
    one = {r.k: r.pred for r in members[0](df, df).select("k", "pred").collect()}
    two = {r.k: r.pred for r in members[1](df, df).select("k", "pred").collect()}
    assert all(np.isclose(ens[k], (one[k] + two[k]) / 2) for k in ens)


def test_candidates_and_running_mean(spark):
    c = S.ridge_candidates(spark, 24, ["a", "b"])
    assert c.count() == 24 and c.filter(~F.col("feature").isin("a", "b")).count() == 0
    alphas = [r.alpha for r in c.collect()]
    assert all(0.01 <= a <= 1e6 and np.isclose(np.log10(a), round(np.log10(a))) for a in alphas)
    assert len(set(alphas)) < len(alphas)  # a discrete space: repeats happen
    log = spark.createDataFrame([(0, 1, 3.0), (0, 2, 1.0), (1, 1, 5.0), (1, 2, 5.0)],
                                "trial long, step long, rmse double")
    r = {(x.trial, x.step): x.running for x in S.running_mean(log).collect()}
    assert r[(0, 2)] == 2.0 and r[(1, 2)] == 5.0


def test_early_stop_both_forms_agree(spark):
    vals = [5.0, 4.0, 4.5, 4.2, 4.1, 3.0, 3.5]
    h = spark.createDataFrame([("r", i + 1, v) for i, v in enumerate(vals)], "run string, epoch int, v double")
    a = S.early_stop(h, "run", "epoch", "v", patience=3).first()
    b = S.early_stop(h, "run", "epoch", "v", patience=3, min_delta=1e-12).first()
    assert (a.best_epoch, a.best_value, a.epochs_run) == (2, 4.0, 5)
    assert (b.best_epoch, b.best_value, b.epochs_run) == (a.best_epoch, a.best_value, a.epochs_run)


def test_score_board_orders_nulls_last(spark):
    a = spark.createDataFrame([("m1", 3.0)], "name string, cv_rmse double")
    b = spark.createDataFrame([("m2", None, 7)], "name string, cv_rmse double, extra int")
    c = spark.createDataFrame([("m3", 1.0)], "name string, cv_rmse double")
    assert [r.name for r in B.score_board(a, b, c).collect()] == ["m3", "m1", "m2"]


def test_stream_scoring_matches_batch(spark):
    from tabspark.streaming.score import run_to_table, stream_table
    out = run_to_table(stream_table(spark, SF_SMALL, "benchmark"),
                       lambda s: s.select("item_id", F.length("text").alias("n")))
    batch = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", F.length("text").alias("n"))
    assert sorted(out.collect()) == sorted(batch.collect())


def test_router_takes_more_levels_than_dense_columns(spark):
    df = spark.range(11_000).select(F.col("id").alias("Id"), (F.col("id") % 7).cast("double").alias("slot"),
                                    F.format_string("v%06d", "id").alias("Code"), F.format_string("w%d", F.col("id") % 3).alias("Kind"),
                                    F.col("id").cast("double").alias("Price"))
    fitted = fit_preprocessor(df, "Id", "Price", FeatureSpec(), PreprocessConfig(False, False))
    new = spark.createDataFrame([(20_000, 3.0, "v000005", "w2", 0.0), (20_001, 3.0, "unseen", "w0", 0.0)], df.schema)
    x, names = fitted.transform(df.union(new))
    assert names == ["slot", "Code_onehot", "Kind_onehot"]
    assert x.columns == ["Id", "slot", "features"] and x.count() == 11_002
    got = {r.Id: r.features for r in x.filter("Id in (0, 10999, 20000, 20001)").collect()}
    assert {v.size for v in got.values()} == {1 + 11_000 + 3}
    on = {k: [int(i) for i, a in zip(v.indices, v.values) if i > 0 and a == 1.0] for k, v in got.items()}
    assert on == {0: [1, 11_001], 10_999: [11_000, 11_002], 20_000: [6, 11_003], 20_001: [11_001]}
