"""Query catalogue, part 5: whole-design ridge, the register of meta-models, candidates and live pruning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import candidates as C
from ..operators import champion as H
from ..operators import gram as G
from ..operators.prep import fit_onehot
from ..operators.split import stratified_kfold, stratified_split
from ..session import materialize
from ..sources.tables import docs, ord_table
from .catalogue import query
from .catalogue_models import oof_base
from .common import FOLD_SEED, K, REPEAT_SEEDS, SPLIT_SEED, assigned, docs_binned, docs_folds, docs_split, rounded

STACK = {"both": ["p_words", "p_lines"], "lines": ["p_lines"], "words": ["p_words"]}
ALPHAS = (0.0, 10.0, 1000.0)

# parameters of a net or a boosted ensemble over a table's documents
SPACE = {"kind": ("choice", ["net", "gbt"]), "rounds": ("int", 20, 400, ("kind", "gbt")), "depth": ("int", 2, 8, ("kind", "gbt")),
         "width": ("int", 8, 128, ("kind", "net")), "lr": ("log", 1e-4, 0.3), "subsample": ("float", 0.5, 1.0, ("kind", "gbt"))}


@query
def ridge_design_oof(spark, sf):
    """M2 + E4 over a wide design: one-hot of nation x segment x month (up to 1,500 columns), out of fold."""
    o = ord_table(spark, sf).select("o_orderkey", "o_totalprice", F.concat_ws("|", "n_name", "c_mktsegment", "o_month").alias("cell"))
    f = assigned(o, "o_orderkey", "o_totalprice", lambda b: stratified_kfold(b, "o_orderkey", "bin", K, FOLD_SEED))
    design, width = G.nominal_slots(f, fit_onehot(f, ["cell"]), ["cell"])
    return rounded(G.ridge_design_oof(design, "o_orderkey", "o_totalprice", [], "fold", "slots", width, 1, alpha=10.0).select(
        "o_orderkey", "fold", "pred"), 3)


@query
def stack_board(spark, sf):
    """E8 + M12 + B10: linear meta-models over out-of-fold predictions by cross-validated error, each with
    its refit on all rows and the mean of its predictions."""
    meta = materialize(stratified_kfold(oof_base(spark, sf), "doc_id", "bin", 7, 7, out="meta_fold"))
    board, scorer = G.stack_register(meta, "n_chars", "meta_fold", STACK, ALPHAS)
    means = meta.agg(*[F.avg(scorer(r)).alias(f"m{i}") for i, r in enumerate(board)]).first()
    rows = [(i + 1, r["model"], r["alpha"], r["cv_rmse"], r["intercept"], sum(r["coefficients"]), means[i]) for i, r in enumerate(board)]
    return rounded(spark.createDataFrame(rows, "rank long, model string, alpha double, cv_rmse double, intercept double, coef_sum double, mean_pred double"), 4)


@query
def candidate_cv(spark, sf):
    """A least-squares candidate over seeds x folds, a row per fit."""
    d, folds = docs_binned(spark, sf), {}
    for seed in REPEAT_SEEDS[:2]:
        folds[seed] = f"fold{seed}"
        d = stratified_kfold(d, "doc_id", "bin", K, seed, out=folds[seed])
    rows = d.select("doc_id", "n_chars", "n_words", *folds.values())
    out = C.cross_validate(rows, "n_chars", folds, K, C.candidate_fit("ridge", "doc_id", ["n_words"], "n_chars"))
    return rounded(out.select("seed", "fold", "n", "rmse", "mae", "r2"), 3)


@query
def gbt_early_stop(spark, sf):
    """M6: boosting that a share of the training rows stops, out of fold: per fold its rows, whether the
    rounds used lie within the budget and whether it beats the mean."""
    f = docs_folds(spark, sf).select("doc_id", "fold", "n_chars", "n_words", "n_lines", "quality", "toxic")
    fit = C.candidate_fit("gbt", "doc_id", ["n_words", "n_lines", "quality", "toxic"], "n_chars", validation=0.2,
                          rounds=30, max_depth=3, learning_rate=0.3)
    out = C.cross_validate(f, "n_chars", {FOLD_SEED: "fold"}, K, fit)
    return out.select(F.col("fold").cast("long").alias("fold"), "n", F.col("used").between(1, 30).alias("rounds_in_budget"),
                      (F.col("r2") > 0).alias("beats_mean"))


@query
def live_prune(spark, sf):
    """W7 + E11: one-feature ridge trials pruned while they run; a row per trial, and whether replaying the
    pruning rule over the log in trial order gives the same decisions."""
    from ..operators import search as S
    from ..operators.models import fit_linear, linear_predict
    f = materialize(docs_folds(spark, sf).select("doc_id", "fold", "n_chars", "n_words", "n_lines"))
    trials = S.ridge_candidates(spark, 10, ["n_words", "n_lines"]).orderBy("trial").collect()

    def score(trial, step):
        b0, beta = fit_linear(f.filter(F.col("fold") != step - 1), "n_chars", [trial.feature], trial.alpha)
        p = linear_predict([trial.feature], b0, beta)
        return f.filter(F.col("fold") == step - 1).agg(F.sqrt(F.avg((F.col("n_chars") - p) ** 2))).first()[0]
    log = C.live_pruned(spark, trials, K, score, n_startup=3)
    rows = spark.createDataFrame([(r["trial"], r["step"], r["value"], r["pruned"]) for r in log], "trial long, step int, rmse double, pruned boolean")
    live = rows.groupBy("trial").agg(F.max("step").cast("long").alias("n_steps"), F.max("pruned").alias("pruned"))
    again = S.median_prune(rows.drop("pruned"), 3, 1).select("trial", (F.col("state") == "PRUNED").alias("_replayed"), F.col("n_steps").alias("_n"))
    return live.join(again, "trial").select("trial", "n_steps", "pruned", ((F.col("pruned") == F.col("_replayed")) & (F.col("n_steps") == F.col("_n"))).alias("as_replayed"))


@query
def dense_refit(spark, sf):
    """M9 + E12 + S9: a net cross-validated on dev rows, fitted on all of them for the median best epoch, stored and
    loaded: for every test row whether it has a score, and whether the epochs lie within the budget."""
    import uuid

    from pyspark.ml import Pipeline

    from ..functions.features import FeatureSpec
    from ..operators import artifacts as A
    from ..operators.design import PreprocessConfig
    from ..session import checkpoint_dir
    cols, net = ["n_words", "n_lines", "quality", "toxic"], {"layers": (8,), "activation": "relu", "lr": 0.05}
    s = docs_split(spark, sf).select("doc_id", "bin", "n_chars", *cols, "split")
    dev = stratified_kfold(s.filter("split = 'dev'"), "doc_id", "bin", 3, FOLD_SEED).drop("split", "bin")
    folds = C.cross_validate(dev, "n_chars", {0: "fold"}, 3, C.net_fit("doc_id", cols, "n_chars", epochs=8, patience=3, **net), workers=3)
    epochs = C.refit_epochs(folds, floor=3)
    plain = PreprocessConfig(feature_engineering=False, add_log_features=False, numeric_only=True)
    model = Pipeline(stages=[A.Preparation("doc_id", "n_chars", FeatureSpec(), plain),
                             A.ScaledTarget(A.DenseNet(epochs=epochs, seed=0, **net), "n_chars", "log")]).fit(dev.drop("fold"))
    root = f"{checkpoint_dir(spark).rstrip('/')}/net-{uuid.uuid4().hex}"
    A.save_scorers(root, model, metadata={"epochs": epochs})
    scored = A.predict_from_store(spark, root, s.filter("split = 'test'").select("doc_id", *cols), out="pred")
    return scored.select("doc_id", (F.col("pred") >= 0).alias("scored"), F.lit(3 <= epochs <= 8).alias("epochs_in_budget"))


@query
def search_space(spark, sf):
    """One trial per thousand characters of the corpus over a mixed, conditional space."""
    from ..operators.search import search_space as sample
    from ..sources.tables import read_table
    n = read_table(spark, sf, "documents").agg(F.sum("n_chars")).first()[0] // 1000
    return rounded(sample(spark, n, SPACE), 9)


FEATURES = ["n_words", "n_lines", "quality", "toxic"]


@query
def nested_bag_tree(spark, sf):
    """B8 over boosted trees, and over least squares by the same operator: the direct weight and the errors."""
    from ..session import stage
    members = {"trees": C.candidate("gbt", "doc_id", FEATURES, "n_chars", "log", max_depth=3, rounds=5, learning_rate=0.3),
               "words": C.candidate("ridge", "doc_id", ["n_words"], "n_chars")}
    d = docs_folds(spark, sf).select("doc_id", "bin", "fold", "n_chars", *FEATURES)
    nested = H.with_inner_folds(d, "doc_id", "bin", "fold", K, 4, FOLD_SEED + 100)
    direct = H.out_of_fold(nested, "fold", K, members, seed=7)
    bagged = stage(H.nested_bag(direct, "fold", K, 4, members, seed=7).select("n_chars", *[f"{c}_{m}" for c in "pb" for m in members]), "bagged")
    w = H.direct_weights(bagged, "n_chars", list(members))
    baseline = bagged.agg(F.stddev_pop("n_chars")).first()[0]
    fine = all(r["rmse"] <= min(r["rmse_direct"], r["rmse_bag"]) and r["rmse"] < baseline for r in w.values())
    best = w["words"]
    return rounded(spark.createDataFrame([(best["weight"], best["rmse_bag"], best["rmse"], fine)],
                                         "direct_weight double, rmse_bag double, best_rmse double, blends_no_worse boolean"), 4)


@query
def champion_blend(spark, sf):
    """Trees and least squares blended on dev rows, the trees swapped for a mix with refits, scored on test
    rows: for each whether it has a score, and whether the blend beats dev's mean there."""
    s = assigned(docs(spark, sf), "doc_id", "n_chars", lambda b: stratified_split(b, "doc_id", "bin", SPLIT_SEED)).select("doc_id", "bin", "n_chars", *FEATURES, "split")
    dev = stratified_kfold(s.filter("split = 'dev'").drop("split"), "doc_id", "bin", K, FOLD_SEED)
    members = {"trees": C.candidate("gbt", "doc_id", FEATURES, "n_chars", "log", max_depth=3, rounds=5, learning_rate=0.3),
               "forest": C.candidate("rf", "doc_id", FEATURES, "n_chars", trees=8, max_depth=5),
               "words": C.candidate("ridge", "doc_id", ["n_words"], "n_chars")}
    test = s.filter("split = 'test'").drop("split", "bin")
    scored, _ = H.champion(dev, test, "doc_id", "n_chars", "bin", "fold", K, members, ["trees", "forest"], k_inner=4, seeds=(7, 8))
    scored = materialize(scored.select("doc_id", "n_chars", "pred"))
    mean = dev.agg(F.avg("n_chars")).first()[0]
    err, base = scored.agg(F.avg((F.col("n_chars") - F.col("pred")) ** 2), F.avg((F.col("n_chars") - mean) ** 2)).first()
    return scored.select("doc_id", (F.col("pred") >= 0).alias("scored"), F.lit(err < base).alias("beats_mean"))
