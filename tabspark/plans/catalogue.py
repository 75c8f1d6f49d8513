"""Query catalogue: one Spark query per operator group of the inventory.

Each entry takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables.  ``oracle.py`` holds the DuckDB SQL of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import features as FE
from ..functions.target import forward_target, inverse_target
from ..operators import prep as P
from ..operators import quality as Q
from ..operators.split import nested_kfold, quartile_label, split_check, stratified_kfold
from ..sources.tables import docs, ord_table, read_table
from .common import (FOLD_SEED, K, docs_binned, docs_folds, docs_split, ord_split,
                     rounded)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


# ===================================================================== cleaning

def _raw_strings(spark, sf) -> DataFrame:
    d = read_table(spark, sf, "documents")
    return d.select(
        "doc_id", "text",
        F.concat(F.lit(" '"), "source", F.lit("' ")).alias("raw_a"),
        F.concat(F.lit("'"), "lang").alias("raw_b"),
        F.concat(F.lit("\t'  "), "lang", F.lit(" '\n")).alias("raw_c"),
        F.lit("'").alias("raw_d"))


@query
def clean_strings(spark, sf):
    r = _raw_strings(spark, sf)
    return rounded(r.select(
        "doc_id", *[C.clean_string(c).alias(c.replace("raw", "clean"))
                    for c in ("raw_a", "raw_b", "raw_c", "raw_d")],
        F.length(C.clean_string("text")).alias("text_len_clean")))


@query
def fill_absence(spark, sf):
    d = docs(spark, sf).select("doc_id", "lang",
                               F.col("quality").cast("string").alias("quality_s"),
                               F.col("toxic").cast("string").alias("toxic_s"))
    return rounded(C.clean_frame(d, absence_columns=("quality_s", "toxic_s")))


@query
def na_tokens(spark, sf):
    d = read_table(spark, sf, "documents")
    words = d.select("lang", F.explode(F.expr("regexp_extract_all(text, '\\\\S+', 0)")).alias("w"))
    t = words.select("lang", C.na_to_null("w").alias("v"))
    return rounded(t.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.sum(F.col("v").isNull().cast("int")).alias("n_na"),
        F.sum(C.to_number("v").isNotNull().cast("int")).alias("n_numeric")))


# ===================================================================== features

@query
def feature_ages(spark, sf):
    o = ord_table(spark, sf)
    return rounded(o.select("o_orderkey",
                            FE.age("l_ship_year", "o_year").alias("ship_lag_years"),
                            FE.age("o_year", "l_ship_year").alias("order_before_ship")))


@query
def feature_sums_null(spark, sf):
    o = ord_table(spark, sf)
    return rounded(o.select("o_orderkey",
                            FE.sum_nullprop(["l_qty", "l_n_lines"], [1.0, 0.5]).alias("qty_lines"),
                            FE.sum_nullprop(["l_price", "c_acctbal"]).alias("price_bal")), 4)


@query
def feature_sums_zero(spark, sf):
    o = ord_table(spark, sf)
    return rounded(o.select("o_orderkey",
                            FE.sum_zero(["l_qty", "l_n_lines"], [1.0, 0.5]).alias("qty_lines"),
                            FE.sum_zero(["l_price", "c_acctbal"]).alias("price_bal")), 4)


@query
def feature_flags(spark, sf):
    o = ord_table(spark, sf)
    return rounded(o.select("o_orderkey", FE.presence("l_n_lines").alias("has_lines"),
                            FE.presence("c_acctbal").alias("has_credit"),
                            FE.product("l_qty", "l_max_disc").alias("qty_disc")), 6)


@query
def feature_log1p(spark, sf):
    o = ord_table(spark, sf)
    return rounded(o.select("o_orderkey", *[FE.log1p_floor0(c).alias(f"log1p_{c}")
                                            for c in ("l_qty", "l_price", "c_acctbal", "l_n_lines")]), 8)


@query
def nominal_cast(spark, sf):
    o = ord_table(spark, sf)
    n = FE.native_category_features(
        o.select("o_orderkey", "o_month", "n_regionkey", "l_n_lines", "c_mktsegment"),
        nominal_cols=("o_month", "n_regionkey", "l_n_lines"))
    return rounded(n)


@query
def feature_builder(spark, sf):
    o = ord_table(spark, sf).select(
        "o_orderkey", "o_year", "l_ship_year", "l_qty", "l_n_lines", "l_price", "c_acctbal",
        "l_max_disc")
    built = FE.build_features(o, FE.ORD_SPEC)
    keep = ["o_orderkey"] + [c for c in built.columns if c not in o.columns]
    return rounded(built.select(*keep), 4)


@query
def target_power_roundtrip(spark, sf):
    d = docs(spark, sf).select("doc_id", "n_chars")
    rows = []
    for p in (0.0, 0.2, 0.35, 0.5, 0.7, 1.0):
        fwd = forward_target("n_chars", "power", p)
        rows.append(d.select("doc_id", F.lit(p).alias("p"), fwd.alias("fwd"),
                             inverse_target(fwd, "power", p).alias("back")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return rounded(out, 6)


# ===================================================================== audit

@query
def table_counts(spark, sf):
    o = ord_table(spark, sf)
    return rounded(Q.table_counts(o, "o_totalprice"))


@query
def dup_rows(spark, sf):
    d = read_table(spark, sf, "documents").select("text", "lang", "source")
    return rounded(Q.duplicate_rows(d))


@query
def dup_keys(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return rounded(Q.duplicate_keys(li, ["l_orderkey", "l_linenumber"]))


@query
def null_profile(spark, sf):
    return rounded(Q.null_profile(ord_table(spark, sf)), 8)


@query
def null_totals(spark, sf):
    return rounded(Q.null_totals(docs(spark, sf)))


@query
def target_profile(spark, sf):
    return rounded(Q.target_profile(docs(spark, sf), "n_chars", "doc_id"), 4)


@query
def skewness_pair(spark, sf):
    return rounded(Q.skewness_pair(docs(spark, sf), "n_chars"), 8)


ORD_NUMERIC = ("c_acctbal", "l_n_lines", "l_qty", "l_price", "l_max_disc", "o_totalprice",
               "o_year", "o_month", "n_regionkey")


@query
def iqr_outliers(spark, sf):
    return rounded(Q.iqr_outliers(ord_table(spark, sf), list(ORD_NUMERIC), "o_orderkey"))


@query
def quote_count(spark, sf):
    r = _raw_strings(spark, sf).drop("text")
    raw = Q.quote_count(r, ["raw_a", "raw_b", "raw_c", "raw_d"]).withColumnRenamed(
        "wrapped_values", "wrapped_raw")
    cleaned = r.select(*[C.clean_string(c).alias(c) for c in ("raw_a", "raw_b", "raw_c", "raw_d")])
    after = Q.quote_count(cleaned).withColumnRenamed("wrapped_values", "wrapped_clean")
    return rounded(_two_counts(raw, after))


def _two_counts(raw: DataFrame, after: DataFrame) -> DataFrame:
    # both are one-row aggregates; a union + max keeps it a plain aggregation
    return raw.select("wrapped_raw", F.lit(None).cast("bigint").alias("wrapped_clean")).unionByName(
        after.select(F.lit(None).cast("bigint").alias("wrapped_raw"), "wrapped_clean")
    ).agg(F.max("wrapped_raw").alias("wrapped_raw"), F.max("wrapped_clean").alias("wrapped_clean"))


@query
def consistency(spark, sf):
    o = ord_table(spark, sf).withColumn("lines_s", F.col("l_n_lines").cast("string"))
    return rounded(Q.consistency(o, {"lines_absence_mismatches": ("lines_s", "l_qty"),
                                     "credit_absence_mismatches": ("c_mktsegment", "c_acctbal")}))


@query
def describe_cols(spark, sf):
    return rounded(Q.describe(ord_table(spark, sf),
                              ["c_acctbal", "l_qty", "l_price", "o_totalprice"], "o_orderkey"), 4)


@query
def target_corr(spark, sf):
    d = docs(spark, sf)
    return rounded(Q.target_correlations(d, "n_chars", ["doc_id", "quality", "toxic",
                                                        "n_words", "n_lines"]), 8)


@query
def eta_squared(spark, sf):
    d = docs(spark, sf).withColumn("quality_s", F.col("quality").cast("string"))
    return rounded(Q.eta_squared(d, "n_chars", ["lang", "source", "quality_s"]), 8)


@query
def extreme_rows(spark, sf):
    """Documents longer than 20,000 characters, with a few columns."""
    from ..operators.joins import extreme_rows as er
    return rounded(er(read_table(spark, sf, "documents"), "n_chars", 20000,
                      ["doc_id", "n_chars", "lang", "source"]))


@query
def labelled_docs(spark, sf):
    """Documents joined with their labels, asserted one-to-one."""
    from ..operators.joins import join_one_to_one
    d = read_table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    return rounded(join_one_to_one(d, read_table(spark, sf, "labels"), "doc_id"))


@query
def event_profile(spark, sf):
    """A5/A6 per category on the events analogue: JSON ``props`` parsed to
    ``k``; a zero ``k`` is turned into a null (``nullif``) and counted."""
    from ..functions.stats import skew_unbiased
    from ..sources.tables import ev
    e = ev(spark, sf).withColumn("k_nz", F.expr("nullif(k, 0)"))
    return rounded(e.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"),
        skew_unbiased("value").alias("skew_value"),
        F.sum(F.col("k_nz").isNull().cast("int")).alias("k_missing"),
        F.avg("k_nz").alias("mean_k")), 6)


@query
def target_hist(spark, sf):
    d = docs(spark, sf)
    raw = Q.histogram(d, "n_chars").withColumn("kind", F.lit("raw"))
    log = Q.histogram(d, F.log1p("n_chars")).withColumn("kind", F.lit("log1p"))
    return rounded(raw.unionByName(log), 6)


# ===================================================================== validation

@query
def key_violations(spark, sf):
    o = Q.key_violations(read_table(spark, sf, "orders"), "o_orderkey")
    li = Q.key_violations(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return rounded(o.withColumn("table_name", F.lit("orders")).unionByName(
        li.withColumn("table_name", F.lit("lineitem"))))


@query
def target_violations(spark, sf):
    return rounded(Q.target_violations(read_table(spark, sf, "events"), "value"))


@query
def template_check(spark, sf):
    from ..operators.infer import order_mismatches, with_row_index
    orders = with_row_index(read_table(spark, sf, "orders").select("o_orderkey"))
    # the output side went through a shuffle (join + aggregate) and carries row_index
    scored = orders.join(ord_table(spark, sf).select("o_orderkey", "o_totalprice"), "o_orderkey")
    return rounded(order_mismatches(orders, scored, "o_orderkey"))


# ===================================================================== split / folds

@query
def target_bins(spark, sf):
    return rounded(docs_binned(spark, sf).select("doc_id", "bin"))


@query
def price_quartiles(spark, sf):
    o = ord_table(spark, sf).select("o_orderkey", "o_totalprice")
    return rounded(quartile_label(o, "o_totalprice", "o_orderkey").select("o_orderkey", "quartile"))


@query
def split_80_20(spark, sf):
    return rounded(docs_split(spark, sf).select("doc_id", "bin", "split"))


@query
def kfold(spark, sf):
    f = docs_folds(spark, sf)
    f = stratified_kfold(f, "doc_id", "bin", K, FOLD_SEED + 1, out="fold_r1")
    return rounded(f.select("doc_id", "fold", "fold_r1"))


@query
def kfold_nested(spark, sf):
    f = docs_folds(spark, sf)
    n = nested_kfold(f, "doc_id", "bin", K, 4, FOLD_SEED, FOLD_SEED + 100)
    return rounded(n.select("doc_id", "fold", "outer", "inner"))


@query
def split_disjoint(spark, sf):
    return rounded(split_check(docs_split(spark, sf), "doc_id"))


# ===================================================================== fitted transforms

@query
def winsorize(spark, sf):
    s = docs_split(spark, sf)
    cols = ["n_words", "n_lines"]
    params = P.fit_winsor(s.filter(F.col("split") == "dev"), cols, "doc_id")
    return rounded(P.apply_winsor(s, params, cols).select("doc_id", *cols), 4)


ORD_IMPUTE = ["l_qty", "l_price", "l_n_lines"]


@query
def impute_indicator(spark, sf):
    s = ord_split(spark, sf)
    params = P.fit_median_impute(s.filter(F.col("split") == "dev"), ORD_IMPUTE, "o_orderkey")
    vals = params.values()
    ind = [c for c in ORD_IMPUTE if vals.get((c, "had_null"), 0) > 0]
    out = P._apply_impute(s, params, ORD_IMPUTE, ind)
    return rounded(out.select("o_orderkey", *ORD_IMPUTE, *[f"missingindicator_{c}" for c in ind]), 4)


def _numeric_pipeline(spark, sf, scaler, winsorize_=False):
    s = ord_split(spark, sf)
    cols = ORD_IMPUTE + ["c_acctbal"]
    m = P.fit_numeric(s.filter(F.col("split") == "dev"), cols, "o_orderkey",
                      winsorize=winsorize_, scaler=scaler)
    return rounded(P.apply_numeric(s, m).select("o_orderkey", *m.output_cols), 6)


@query
def standard_scale(spark, sf):
    return _numeric_pipeline(spark, sf, "standard")


@query
def robust_scale(spark, sf):
    return _numeric_pipeline(spark, sf, "robust", winsorize_=True)


# Level orders of the order analogue's ordinal columns.
ORD_LEVELS = {
    "o_orderpriority": ["Missing", "5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"],
    "o_orderstatus": ["Missing", "P", "O"],
}


@query
def ordinal_encode(spark, sf):
    s = ord_split(spark, sf)
    params = P.fit_ordinal(s.filter(F.col("split") == "dev"), ORD_LEVELS)
    out = P.apply_ordinal(s, ORD_LEVELS, params)
    return rounded(out.select("o_orderkey", *ORD_LEVELS), 6)


@query
def onehot_rare(spark, sf):
    s = docs_split(spark, sf).withColumn("lang_source", F.concat_ws("-", "lang", "source"))
    dictionary = P.fit_onehot(s.filter(F.col("split") == "dev"), ["lang_source"], min_frequency=8)
    slots = P.onehot_slots(s, dictionary, "lang_source")
    return rounded(slots.select("doc_id", "lang_source", "slot", "n_slots"))


@query
def target_scale(spark, sf):
    s = docs_split(spark, sf)
    params = P.fit_target_scaler(s.filter(F.col("split") == "dev"), "n_chars", "log1p")
    _, get = params.attach(s, [])
    z = P.target_forward("n_chars", get, "log1p")
    return rounded(s.select("doc_id", z.alias("z"),
                            P.target_inverse(z, "n_chars", get, "log1p").alias("back")), 6)


@query
def fold_params(spark, sf):
    f = docs_folds(spark, sf)
    mom = P.fold_complement_standard(f, ["n_words", "n_lines"], "fold", K)
    med = P.fit_median_impute(P.expand_training_folds(f, "fold", K, out="fit_fold"),
                              ["n_words", "n_lines"], "doc_id", by=("fit_fold",)).table
    med = med.filter(F.col("stat") == "median").withColumnRenamed("fit_fold", "fold")
    return rounded(mom.unionByName(med), 6)
