"""Catalogue, part 3: pyspark.ml models, iterative solvers, nested bagging,
the dense net, and source/sink round trips.

Model fits and iterative solvers have no SQL statement (the driver checks
their rows and schema); nested bagging with moment models and the CSV
round trip do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import blend as B
from ..operators import prep as P
from ..operators import oof as O
from ..operators.candidates import candidate
from ..operators.champion import out_of_fold
from ..operators.search import coarse_to_fine
from ..operators.split import nested_kfold, stratified_kfold
from ..session import checkpoint_dir, materialize
from ..sources.tables import docs, ord_table
from .catalogue import query
from .catalogue_models import BASE_MODELS, oof_base, oof_table
from .common import FOLD_SEED, K, assigned, docs_binned, docs_folds, docs_split, rounded

NUM = ["n_words", "n_lines", "quality", "toxic"]


def _oof_ml(spark, sf, kind, target_mode="raw", **params) -> DataFrame:
    """The numeric pipeline (F11) and a pyspark.ml estimator, both fitted per fold on training rows only."""
    f = docs_folds(spark, sf).select("doc_id", "fold", "n_chars", *NUM)
    oof = out_of_fold(f, "fold", K, {"ml": candidate(kind, "doc_id", NUM, "n_chars", target_mode, **params)}, seed=7)
    return rounded(oof.select("doc_id", "fold", "n_chars", F.col("p_ml").alias("pred")), 2)


@query
def gbt_oof(spark, sf):
    """M6 + M11: boosted trees on a log target, out of fold."""
    return _oof_ml(spark, sf, "gbt", "log", max_depth=3, rounds=20, learning_rate=0.2)


@query
def rf_oof(spark, sf):
    """M7: random forest, out of fold."""
    return _oof_ml(spark, sf, "rf", trees=30, max_depth=6)


@query
def huber_meta(spark, sf):
    """M5 + M12 + E8 + J4: Huber meta-model over robust-scaled OOF
    predictions and one raw column, itself evaluated out of fold."""
    o = oof_base(spark, sf).join(docs(spark, sf).select("doc_id", "n_lines"), "doc_id")
    cols = ["p_words", "p_lines", "n_lines"]
    meta = stratified_kfold(o, "doc_id", "bin", 7, 7, out="meta_fold")
    learn = candidate("huber", "doc_id", cols, "n_chars", scaler="robust", epsilon=1.35)
    out = out_of_fold(meta.select("doc_id", "meta_fold", "n_chars", *cols), "meta_fold", 7, {"huber": learn})
    return rounded(out.select("doc_id", "meta_fold", F.col("p_huber").alias("pred")), 2)


# ------------------------------------------------------------------ iterative blends (B1, B2, M4)

def _weights_table(spark, weights: dict, extra: dict | None = None) -> DataFrame:
    rows = [(m, float(w)) for m, w in weights.items()]
    t = spark.createDataFrame(rows, "model string, weight double")
    for k, v in (extra or {}).items():
        t = t.withColumn(k, F.lit(v))
    return t


@query
def simplex_blend(spark, sf):
    o = oof_base(spark, sf)
    cols = [f"p_{m}" for m in BASE_MODELS]
    w = B.fit_simplex_blend(o, cols, "n_chars")
    blended = o.select(B.apply_weights(w).alias("p"), "n_chars").agg(
        F.sqrt(F.avg((F.col("n_chars") - F.col("p")) ** 2))).first()[0]
    return rounded(_weights_table(spark, w, {"oof_rmse": blended}), 6)


@query
def stable_blend(spark, sf):
    o = oof_base(spark, sf)
    cols = [f"p_{m}" for m in BASE_MODELS]
    w, cv = B.fit_stable_blend(o, cols, "n_chars", "fold")
    return rounded(_weights_table(spark, w, {"cv_rmse": cv}), 6)


@query
def nnls_blend(spark, sf):
    o = oof_base(spark, sf)
    cols = [f"p_{m}" for m in BASE_MODELS]
    b0, w = B.fit_nnls_blend(o, cols, "n_chars")
    return rounded(_weights_table(spark, w, {"intercept": b0}), 6)


# ------------------------------------------------------------------ search

@query
def cv_search(spark, sf):
    b = docs_binned(spark, sf)
    f = stratified_kfold(b, "doc_id", "bin", 3, 1, out="fold3")
    f = stratified_kfold(f, "doc_id", "bin", 5, FOLD_SEED, out="fold5")
    res = coarse_to_fine(spark, f, "n_chars", ["n_words", "n_lines"], "fold3", "fold5", 24, 3)
    return rounded(res, 4)


# ------------------------------------------------------------------ nested bagging

@query
def nested_bag(spark, sf):
    """Per outer fold, the mean of the inner-fold models (fitted on the
    inner training parts of the outer training rows) predicts the outer
    validation rows; the direct-vs-bag weight is chosen on a 101-point grid."""
    folds = assigned(docs(spark, sf), "doc_id", "n_chars", lambda b: stratified_kfold(b, "doc_id", "bin", K, FOLD_SEED))
    f = folds.join(oof_table(folds).select("doc_id", "p_words"), "doc_id").select("doc_id", "bin", "fold", "n_chars", "n_words", "p_words")
    n = nested_kfold(f, "doc_id", "bin", K, 4, FOLD_SEED, FOLD_SEED + 100)
    r = B.nested_bag_weight(n, "doc_id", "n_chars", ["n_words"], "fold", "p_words")
    bagged = r["bagged"]
    return rounded(bagged.agg(F.sqrt(F.avg((F.col("n_chars") - F.col("p_bag")) ** 2)).alias("rmse_bag"))
                   .select(F.lit(r["direct_weight"]).alias("direct_weight"), "rmse_bag",
                           F.lit(r["best_rmse"]).alias("best_rmse")), 4)


ORD_NUMERIC_FEATURES = ["o_custkey", "o_year", "o_month", "c_acctbal", "n_regionkey", "l_n_lines",
                        "l_qty", "l_price", "l_max_disc", "l_ship_year"]


@query
def preprocess_design(spark, sf):
    """numeric / ordinal / nominal routing fitted on dev rows, applied to
    every order, assembled into one vector; per-row size, sum and sum of
    squares of the vector."""
    from pyspark.ml.functions import vector_to_array
    from ..functions.features import FeatureSpec
    from ..operators.design import PreprocessConfig, fit_preprocessor
    from .catalogue import ORD_LEVELS
    from .common import ord_split
    s = ord_split(spark, sf).select("o_orderkey", "o_totalprice", *ORD_NUMERIC_FEATURES,
                                    "o_orderpriority", "o_orderstatus", "c_mktsegment", "n_name",
                                    "split")
    cfg = PreprocessConfig(feature_engineering=False, add_log_features=False, encoding="ordinal")
    fitted = fit_preprocessor(s.filter(F.col("split") == "dev").drop("split"), "o_orderkey",
                              "o_totalprice", FeatureSpec(), cfg, ORD_LEVELS)
    x, names = fitted.transform(s.drop("split"))
    arr = vector_to_array("features")
    return rounded(x.select("o_orderkey", F.size(arr).alias("n_features"),
                            F.aggregate(arr, F.lit(0.0), lambda a, v: a + v).alias("total"),
                            F.aggregate(arr, F.lit(0.0), lambda a, v: a + v * v).alias("total_sq")), 6)


# ------------------------------------------------------------------ dense net (M8, M9)

def _dense_inputs(spark, sf):
    s = docs_split(spark, sf)
    m = P.fit_numeric(s.filter(F.col("split") == "dev"), NUM, "doc_id")
    t = P.fit_target_scaler(s.filter(F.col("split") == "dev"), "n_chars", "log1p")
    _, get = t.attach(s, [])
    x = P.apply_numeric(s, m).withColumn("z", P.target_forward("n_chars", get, "log1p"))
    return x, m.output_cols, get


@query
def dense_score(spark, sf):
    from ..operators.models import init_dense
    x, feats, get = _dense_inputs(spark, sf)
    ws = init_dense(len(feats), (16, 8), seed=0)
    scored = O.dense_score(x.select("doc_id", "n_chars", *feats), feats, ws, "relu", out="zhat")
    return rounded(scored.select("doc_id", P.target_inverse(F.col("zhat"), "n_chars", get, "log1p")
                                 .alias("pred")), 4)


@query
def dense_fitted_score(spark, sf):
    """M8 + M9 + S9: a net fitted on dev rows, stored with its preparation, loaded and scored on all rows."""
    from pyspark.ml import Pipeline

    from ..functions.features import FeatureSpec
    from ..operators import artifacts as A
    from ..operators.design import PreprocessConfig
    s = docs_split(spark, sf).select("doc_id", "n_chars", *NUM, "split")
    plain = PreprocessConfig(feature_engineering=False, add_log_features=False, numeric_only=True)
    net = A.DenseNet(layers=(16, 8), activation="relu", epochs=12, lr=0.02, seed=0)
    model = Pipeline(stages=[A.Preparation("doc_id", "n_chars", FeatureSpec(), plain), A.ScaledTarget(net, "n_chars", "log")]).fit(
        s.filter(F.col("split") == "dev").drop("split"))
    root = f"{checkpoint_dir(spark).rstrip('/')}/net-{uuid.uuid4().hex}"
    A.save_scorers(root, model)
    return rounded(A.predict_from_store(spark, root, s.drop("n_chars", "split"), out="pred").select("doc_id", "pred"), 4)


@query
def dense_fit(spark, sf):
    x, feats, get = _dense_inputs(spark, sf)
    train = x.filter(F.col("split") == "dev")
    val = x.filter(F.col("split") == "test")
    _, history, best = O.dense_fit(train, feats, "z", layers=(16, 8), activation="relu",
                                 epochs=12, lr=0.02, val=val, patience=4, seed=0)
    rows = [(h["epoch"], h["train_loss"], h.get("val_rmse"), best) for h in history]
    return rounded(spark.createDataFrame(rows, "epoch int, train_loss double, val_rmse double, "
                                               "best_epoch int"), 6)


# ------------------------------------------------------------------ sources and sinks

@query
def csv_roundtrip(spark, sf):
    """Write the order table as CSV (nulls become empty cells), read it
    back under the declared schema with NA tokens and coercion."""
    from ..sources.io import read_csv_table
    o = ord_table(spark, sf).select("o_orderkey", "l_qty", "l_n_lines", "c_mktsegment")
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    o.write.option("header", True).csv(path)
    schema = o.schema
    return rounded(read_csv_table(spark, path, schema), 4)


@query
def predictions_csv(spark, sf):
    """Id,Prediction text with six decimals in input order (row_index: the place in the scan)."""
    from ..operators.infer import with_row_index
    from ..sources.io import format_predictions
    from ..sources.tables import read_table
    ids = with_row_index(read_table(spark, sf, "documents").select("doc_id"))
    scored = ids.join(oof_base(spark, sf).select("doc_id", "p_words"), "doc_id")
    named = scored.select(F.col("doc_id").alias("Id"), F.col("p_words").alias("Prediction"), "row_index")
    return format_predictions(named).join(named.select("Id", F.col("row_index").cast("bigint").alias("row_index")), "Id")


@query
def stream_score(spark, sf):
    """I1 on a stream: documents arrive through ``readStream``; features and
    a linear model fitted on the batch table score them in a stateless plan."""
    from ..operators.models import fit_linear, linear_predict
    from ..sources.tables import line_count, word_count
    from ..streaming.score import run_to_table, stream_table
    b0, beta = fit_linear(docs(spark, sf), "n_chars", ["n_words", "n_lines"])

    def score(s: DataFrame) -> DataFrame:
        f = s.select("doc_id", word_count("text").cast("bigint").alias("n_words"),
                     line_count("text").cast("bigint").alias("n_lines"))
        return f.select("doc_id", linear_predict(["n_words", "n_lines"], b0, beta).alias("pred"))
    return rounded(run_to_table(stream_table(spark, sf, "documents"), score), 2)


@query
def table_digest(spark, sf):
    """Order-free digest of the lineitem table (same for any partitioning)."""
    from ..sources.io import table_digest as td
    from ..sources.tables import read_table
    return td(read_table(spark, sf, "lineitem"))


@query
def score_from_artifacts(spark, sf):
    """I1 + S9 + S10: preparation and least-squares models stored as pipelines, loaded and scored in
    single and ensemble mode, and in ensemble mode on a stream.  Member m learns from the rows outside fold m."""
    from pyspark.ml import Pipeline, PipelineModel

    from ..functions.features import FeatureSpec
    from ..operators import artifacts as A
    from ..operators.design import PreprocessConfig
    from ..operators.models import make_estimator
    from ..sources.tables import line_count, word_count
    from ..streaming.score import run_to_table, stream_table
    f = docs_folds(spark, sf).select("doc_id", "fold", "n_chars", "n_words", "n_lines")
    plain = PreprocessConfig(feature_engineering=False, add_log_features=False, numeric_only=True)
    prepared = A.Preparation("doc_id", "n_chars", FeatureSpec(), plain, exclude=["fold"]).fit(f.filter(F.col("fold") != 0))
    design = materialize(prepared.transform(f))

    def fitted(m):
        learner = A.ScaledTarget(make_estimator("ridge"), "n_chars")
        return PipelineModel([prepared, *Pipeline(stages=[learner]).fit(design.filter(F.col("fold") != m)).stages])
    root = f"{checkpoint_dir(spark).rstrip('/')}/scorers-{uuid.uuid4().hex}"
    A.save_scorers(root, fitted(0), {f"fold{m}": fitted(m) for m in (1, 2, 3)}, {"target": "n_chars", "seed": FOLD_SEED})
    rows = f.select("doc_id", "n_words", "n_lines")

    def from_text(s):
        return A.predict_from_store(spark, root, s.select(
            "doc_id", word_count("text").cast("bigint").alias("n_words"), line_count("text").cast("bigint").alias("n_lines")),
            "ensemble", "streamed").select("doc_id", "streamed")
    streamed = run_to_table(stream_table(spark, sf, "documents"), from_text)
    single = A.predict_from_store(spark, root, rows, "single", "single").select("doc_id", "single")
    many = A.predict_from_store(spark, root, rows, "ensemble", "ensemble").select("doc_id", "ensemble")
    return rounded(single.join(many, "doc_id").join(streamed, "doc_id"), 3)
