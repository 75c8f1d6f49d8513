"""Catalogue, part 2: models, out-of-fold tables, metrics, blends, search log.

Base OOF table of the documents analogue (k = 5 stratified folds):
``p_words`` = OLS on n_words, ``p_lines`` = OLS on n_lines, ``p_mean`` =
mean baseline; each row predicted by the fit that excluded its fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blend as B
from ..operators import metrics as M
from ..operators import search as S
from ..operators.models import fit_linear, linear_predict, oof_linear_wide
from ..operators.split import stratified_kfold
from ..session import stage
from ..sources.tables import docs
from .catalogue import query
from .common import FOLD_SEED, K, REPEAT_SEEDS, docs_binned, docs_folds, rounded

BASE_MODELS = {"words": ["n_words"], "lines": ["n_lines"], "mean": []}


def oof_base(spark, sf, seed: int = FOLD_SEED) -> DataFrame:
    """The OOF table is written once; blends, metrics and reports read it."""
    return oof_table(docs_folds(spark, sf, seed))


def oof_table(folds: DataFrame) -> DataFrame:
    """The OOF table of a fold table, written."""
    return stage(oof_linear_wide(folds, "doc_id", "n_chars", BASE_MODELS, "fold", keep=["bin"]), "oof")


def oof_long(oof: DataFrame, *keep: str) -> DataFrame:
    return oof.select("doc_id", "n_chars", *keep, F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(f"p_{m}").alias("pred")) for m in BASE_MODELS
    ])).alias("_m")).select("doc_id", "n_chars", *keep, "_m.model", "_m.pred")


def oof_seeds(spark, sf, seeds) -> list[DataFrame]:
    """The base OOF table of every seed: the analogue table and its bins are made once."""
    from ..session import materialize
    binned = materialize(docs_binned(spark, sf))
    return [materialize(oof_linear_wide(materialize(stratified_kfold(binned, "doc_id", "bin", K, s)), "doc_id", "n_chars",
                                        BASE_MODELS, "fold", keep=["bin"])) for s in seeds]


# ===================================================================== models

@query
def mean_baseline(spark, sf):
    o = oof_base(spark, sf)
    return rounded(o.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.first("p_mean").alias("train_mean"),
        F.sqrt(F.avg((F.col("n_chars") - F.col("p_mean")) ** 2)).alias("rmse")), 4)


@query
def ols_oof(spark, sf):
    o = oof_base(spark, sf)
    return rounded(o.select("doc_id", "fold", F.col("p_words").alias("pred")), 2)


@query
def holdout_metrics(spark, sf):
    """OLS fitted on the dev split, metrics on dev (train) and test rows."""
    from ..operators.oof import holdout_eval
    from .common import docs_split

    def fit_predict(train, score):
        b0, beta = fit_linear(train, "n_chars", ["n_words"])
        return score.withColumn("pred", linear_predict(["n_words"], b0, beta))
    return rounded(holdout_eval(docs_split(spark, sf), "n_chars", "split", fit_predict), 4)


@query
def ridge_moments(spark, sf):
    from ..operators.models import fold_linear_fits
    f = docs_folds(spark, sf)
    return rounded(fold_linear_fits(f, "n_chars", ["n_words", "n_lines"], "fold", alpha=10.0), 6)


# ===================================================================== metrics

@query
def regression_metrics(spark, sf):
    return rounded(M.regression_metrics(oof_long(oof_base(spark, sf)), "n_chars", "pred",
                                        by=["model"]), 4)


@query
def metrics_by_quartile(spark, sf):
    o = oof_base(spark, sf)
    return rounded(M.metrics_by_quartile(o, "n_chars", "p_words", "doc_id"), 4)


@query
def worst_cases(spark, sf):
    o = oof_base(spark, sf).select("doc_id", "n_chars", F.col("p_words").alias("pred"))
    details = docs(spark, sf).select("doc_id", "lang", "source", "n_words")
    return rounded(M.worst_cases(o, "n_chars", "pred", "doc_id", details), 2)


@query
def fold_summary(spark, sf):
    long = oof_long(oof_base(spark, sf), "fold")
    per_fold = long.groupBy("model", "fold").agg(*M.metric_aggs("n_chars", "pred"))
    samp = M.fold_summary(per_fold, ["model"])
    pop = M.fold_summary(per_fold, ["model"], population_std=True).select(
        "model", F.col("std_rmse").alias("std_rmse_pop"))
    return rounded(samp.join(pop, "model"), 4)


@query
def residuals(spark, sf):
    """Truth, prediction, residual per row and the truth range."""
    o = oof_base(spark, sf).select("doc_id", "n_chars", F.col("p_words").alias("pred"))
    res, (lo, hi) = M.residual_table(o, "n_chars", "pred", "doc_id")
    return rounded(res.select("*", F.lit(lo).cast("double").alias("truth_min"),
                              F.lit(hi).cast("double").alias("truth_max")), 2)


@query
def seed_mean(spark, sf):
    parts = [o.select("doc_id", F.lit(s).alias("seed"), "p_words") for s, o in zip(REPEAT_SEEDS, oof_seeds(spark, sf, REPEAT_SEEDS))]
    long = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rounded(M.row_mean(long, "doc_id", "p_words"), 2)


@query
def gain_pct(spark, sf):
    tables = oof_seeds(spark, sf, REPEAT_SEEDS)
    single = tables[0].select("doc_id", "n_chars", "p_words")
    parts = [o.select("doc_id", "p_words") for o in tables]
    mean = M.row_mean(parts[0].unionByName(parts[1]).unionByName(parts[2]), "doc_id", "p_words")
    j = single.join(mean.select("doc_id", F.col("p_words").alias("p_ens")), "doc_id")
    r = j.agg(F.sqrt(F.avg((F.col("n_chars") - F.col("p_words")) ** 2)).alias("rmse_single"),
              F.sqrt(F.avg((F.col("n_chars") - F.col("p_ens")) ** 2)).alias("rmse_ensemble"))
    return rounded(r.withColumn("gain_pct", M.gain_pct(F.col("rmse_single"), F.col("rmse_ensemble"))), 6)


# ===================================================================== blending

@query
def linear_calibration(spark, sf):
    o = oof_base(spark, sf)
    b0, slope = B.linear_calibration(o, "p_lines", "n_chars")
    return rounded(o.select("doc_id", (F.lit(b0) + F.lit(slope) * F.col("p_lines")).alias("calibrated")), 2)


@query
def calibration_cv(spark, sf):
    o = stratified_kfold(oof_base(spark, sf), "doc_id", "bin", 7, 7, out="cal_fold")
    return rounded(B.calibration_cv(o, "p_lines", "n_chars", "cal_fold"), 4)


@query
def grid_blend(spark, sf):
    return rounded(B.grid_blend(oof_base(spark, sf), "p_words", "p_lines", "n_chars"), 4)


@query
def blend_moments(spark, sf):
    g = B.gram_moments(oof_base(spark, sf), ["p_words", "p_lines", "p_mean"], "n_chars")
    return rounded(g, 2)


@query
def blend_apply(spark, sf):
    o = oof_base(spark, sf)
    w = B.grid_blend(o, "p_words", "p_lines", "n_chars").first().weight
    return rounded(o.select("doc_id", B.apply_weights({"p_words": w, "p_lines": 1.0 - w}).alias("pred")), 2)


@query
def weight_prune(spark, sf):
    # inverse-MSE weights of the three base models, then the prune rule
    mse = oof_long(oof_base(spark, sf)).groupBy("model").agg(
        F.avg((F.col("n_chars") - F.col("pred")) ** 2).alias("mse"))
    inv = mse.select("model", (F.lit(1.0) / F.col("mse")).alias("w"))
    return rounded(B.prune_weights(_inverse_weights(inv), drop_below=0.05), 8)


def _inverse_weights(inv: DataFrame) -> DataFrame:
    from pyspark.sql import Window
    return inv.select("model", (F.col("w") / F.sum("w").over(Window.partitionBy())).alias("weight"))


@query
def repeat_oof_mean(spark, sf):
    parts = [o.select("doc_id", "n_chars", F.lit(i).alias("repeat"), F.col("p_words").alias("pred"))
             for i, o in enumerate(oof_seeds(spark, sf, REPEAT_SEEDS))]
    long = parts[0].unionByName(parts[1]).unionByName(parts[2])
    mean = long.groupBy("doc_id", "n_chars").agg(F.avg("pred").alias("pred"))
    per = long.groupBy("repeat").agg(F.sqrt(F.avg((F.col("n_chars") - F.col("pred")) ** 2)).alias("rmse"))
    overall = mean.agg(F.sqrt(F.avg((F.col("n_chars") - F.col("pred")) ** 2)).alias("rmse")) \
        .select(F.lit(-1).alias("repeat"), "rmse")
    return rounded(per.unionByName(overall), 4)


@query
def override_blend(spark, sf):
    o = oof_base(spark, sf)
    long = oof_long(o).select("doc_id", "model", "pred")
    # replacement for one component: its refit on all rows
    d = docs(spark, sf)
    b0, beta = fit_linear(d, "n_chars", ["n_words"])
    rep = d.select("doc_id", F.lit("words").alias("model"),
                   linear_predict(["n_words"], b0, beta).alias("pred"))
    return rounded(B.override(long, rep, "doc_id"), 2)


@query
def pred_pivot(spark, sf):
    long = oof_long(oof_base(spark, sf)).select("doc_id", "model", "pred")
    return rounded(B.pivot_models(long, "doc_id", list(BASE_MODELS)), 2)


# ===================================================================== search log

N_TRIALS = 24


def search_log(spark, sf) -> DataFrame:
    f = docs_folds(spark, sf)
    cands = S.ridge_candidates(spark, N_TRIALS, ["n_words", "n_lines"])
    mom = S.fold_moments_1d(f, "n_chars", ["n_words", "n_lines"], "fold")
    return S.score_ridge_trials(cands, mom, "fold")


@query
def trial_log(spark, sf):
    return rounded(search_log(spark, sf), 2)


@query
def median_prune(spark, sf):
    return rounded(S.median_prune(search_log(spark, sf)), 2)


@query
def state_counts(spark, sf):
    return rounded(M.value_counts(S.median_prune(search_log(spark, sf)), "state"))


def _trial_summary(spark, sf) -> DataFrame:
    return search_log(spark, sf).groupBy("trial", "feature", "alpha").agg(
        # compared at 1e-6: equal configs tie exactly, the trial number decides
        F.round(F.avg("rmse"), 6).alias("mean_rmse"))


@query
def top_configs(spark, sf):
    return rounded(S.top_configs(_trial_summary(spark, sf), ["feature", "alpha"], "mean_rmse", 5), 2)


@query
def finalist_rank(spark, sf):
    return rounded(S.rank_labels(_trial_summary(spark, sf), "feature", "mean_rmse")
                   .select("trial", "label"))


@query
def argmin_config(spark, sf):
    return rounded(S.argmin(_trial_summary(spark, sf), "mean_rmse", ["trial", "feature", "alpha"]), 2)


@query
def early_stop(spark, sf):
    from pyspark.sql import Window
    # each feature's trials in order form one run; the trial mean is its epoch value
    order = Window.partitionBy("feature").orderBy("trial")
    hist = _trial_summary(spark, sf).select(F.col("feature").alias("run"),
                                            F.row_number().over(order).alias("epoch"),
                                            F.round("mean_rmse", 6).alias("value"))
    w = S.early_stop(hist, "run", "epoch", "value", patience=3)
    return rounded(w, 2)


@query
def history_long(spark, sf):
    from ..functions.config import history_long as hl
    # per-trial arrays (one entry per fold step: bounded by k), then back to rows
    arrays = search_log(spark, sf).groupBy("trial").agg(
        F.sort_array(F.collect_list(F.struct("step", "rmse"))).alias("h")).select(
        "trial", F.col("h.rmse").alias("val_rmse"),
        F.transform("h", lambda x: x["rmse"] * x["rmse"]).alias("val_mse"))
    return rounded(hl(arrays, "trial", ["val_rmse", "val_mse"]), 2)


@query
def stage_union(spark, sf):
    base = oof_base(spark, sf).groupBy("fold").agg(
        F.sqrt(F.avg((F.col("n_chars") - F.col("p_mean")) ** 2)).alias("rmse")).select(
        F.lit("baseline").alias("stage"), F.col("fold").cast("bigint").alias("id"), "rmse")
    trials = _trial_summary(spark, sf).select(
        F.lit("search").alias("stage"), F.col("trial").alias("id"),
        F.col("mean_rmse").alias("rmse"), "feature", "alpha")
    return rounded(S.stage_union(base, trials), 2)
