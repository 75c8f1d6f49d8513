"""Data audit and validation.

Per-column statistics are computed for all columns in one aggregation and
then unpivoted to long (column, statistic) rows, instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions.clean import absent, is_quote_wrapped, string_columns, to_number
from ..functions.encode import row_text
from ..functions.features import numeric_columns
from ..functions.stats import count_true, not_finite, safe_corr, skew_unbiased
from ..session import drop_stages, written
from .quantiles import column_quantiles, quantile_wide


def _long(one_row: DataFrame, cols: Sequence[str], value: str) -> DataFrame:
    """Unpivot a one-row aggregate (column c -> row (c, value))."""
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(value)) for c in cols
    ])).alias("_kv")).select("_kv.column", f"_kv.{value}")


# ---------------------------------------------------------------- counts / dups

def table_counts(df: DataFrame, target: str | None = None) -> DataFrame:
    """A1: rows, columns, numeric and categorical feature counts (schema-based)."""
    num_all = numeric_columns(df)
    num = [c for c in num_all if c != target]
    n_cat = len(df.columns) - len(num_all)  # every non-numeric column (text, dates)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).alias("columns"),
        F.lit(len(num)).alias("numeric_features"),
        F.lit(n_cat).alias("categorical_features"))


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: rows beyond the first of each identical row (nulls compare equal, as do NaNs and both zeros)."""
    # rows meet by a 256-bit digest of their typed values, so wide text columns are not shuffled
    groups = df.groupBy(F.sha2(row_text(df, cols), 256).alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").cast("bigint").alias("rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
        (F.sum("_n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"))


def duplicate_keys(df: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """A3 / V3: null keys and key occurrences beyond the first."""
    key = [key] if isinstance(key, str) else list(key)
    any_null = F.greatest(*[F.col(k).isNull().cast("int") for k in key]) if len(key) > 1 \
        else F.col(key[0]).isNull().cast("int")
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"),
                                  F.max(any_null).alias("_null"))
    return groups.agg(
        F.sum("_n").cast("bigint").alias("rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
        (F.sum("_n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_keys"),
        F.sum(F.when(F.col("_null") == 1, F.col("_n")).otherwise(0)).cast("bigint").alias("null_keys"))


# ---------------------------------------------------------------- nulls

def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN of floating columns becomes null: a missing value for every audit below."""
    return df.select(*[
        F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`") for f in df.schema.fields])


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A4: per column null (or NaN) count and rate, columns with nulls only, rate desc."""
    df = nan_to_null(df)
    cols = list(cols or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.sum(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in cols])
    long = one.select("__rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("bigint").alias("n_null"))
        for c in cols])).alias("_kv")).select("__rows", "_kv.*")
    return (long.filter(F.col("n_null") > 0)
            .select("column", "n_null",
                    (F.col("n_null") / F.col("__rows")).alias("null_rate"))
            .orderBy(F.desc("null_rate"), F.asc("column")))


def null_totals(df: DataFrame) -> DataFrame:
    """A4 totals: null cells and number of columns holding a null."""
    prof = null_profile(df)
    return prof.agg(F.coalesce(F.sum("n_null"), F.lit(0)).cast("bigint").alias("total_missing"),
                    F.count(F.lit(1)).cast("bigint").alias("columns_with_missing"))


# ---------------------------------------------------------------- target stats

def target_profile(df: DataFrame, y: str, key: str) -> DataFrame:
    """A5: mean, exact median, sample std, min, max of the target."""
    df = nan_to_null(df)
    med = column_quantiles(df, [y], [0.5], key).collect()
    median = med[0].value if med else None
    return df.agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"),
        F.min(y).cast("double").alias("min"), F.max(y).cast("double").alias("max"),
    ).withColumn("median", F.lit(median).cast("double"))


def skewness_pair(df: DataFrame, y: str) -> DataFrame:
    """Bias-corrected skewness of y and of log1p(y)."""
    return df.agg(skew_unbiased(F.col(y).cast("double")).alias("skew"),
                  skew_unbiased(F.log1p(F.col(y))).alias("log_skew"))


# ---------------------------------------------------------------- outliers, strings

def iqr_outliers(df: DataFrame, cols: Sequence[str], key: str, top: int = 15) -> DataFrame:
    """Values strictly outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR], per column, top-k."""
    # the cells alone, made once: quantiles and counts read them several times
    df, staged = written(nan_to_null(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(cols)])), "outlier-cells")
    q = {(r.column, r.p): r.value
         for r in column_quantiles(df, cols, [0.25, 0.75], key).collect()}
    counts = []
    for c in cols:
        q1, q3 = q.get((c, 0.25)), q.get((c, 0.75))
        if q1 is None:
            counts.append(F.lit(0).cast("bigint").alias(c))
            continue
        iqr = q3 - q1
        x = F.col(f"`{c}`")
        counts.append(count_true((x < F.lit(q1 - 1.5 * iqr)) | (x > F.lit(q3 + 1.5 * iqr))).alias(c))
    one = df.agg(*counts)
    found = df.sparkSession.createDataFrame(one.collect(), one.schema)  # one row
    drop_stages(*staged)
    long = _long(found, cols, "n_outliers")
    return long.orderBy(F.desc("n_outliers"), F.asc("column")).limit(top)


def quote_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """String cells starting or ending with a single quote, all columns."""
    cols = list(cols or string_columns(df))
    total = None
    for c in cols:
        t = count_true(is_quote_wrapped(c))
        total = t if total is None else total + t
    return df.agg(F.coalesce(total, F.lit(0)).cast("bigint").alias("wrapped_values"))


def consistency(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """A10: rows where "category absent" disagrees with "quantity is 0"."""
    return df.agg(*[
        count_true(absent(a) != F.coalesce(F.col(b) == 0, F.lit(False))).alias(name)
        for name, (a, b) in pairs.items()])


def describe(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per column (transposed)."""
    df, _ = written(nan_to_null(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(cols)])), "described-cells")
    stats = df.agg(*[
        F.struct(F.count(F.col(f"`{c}`")).cast("bigint").alias("count"),
                 F.avg(F.col(f"`{c}`")).alias("mean"),
                 F.stddev_samp(F.col(f"`{c}`")).alias("std"),
                 F.min(F.col(f"`{c}`")).cast("double").alias("min"),
                 F.max(F.col(f"`{c}`")).cast("double").alias("max")).alias(c)
        for c in cols])
    long = stats.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.*")) for c in cols])).alias("_s")
    ).select("_s.*")
    q = quantile_wide(column_quantiles(df, cols, [0.25, 0.5, 0.75], key),
                      names={0.25: "q25", 0.5: "q50", 0.75: "q75"})
    # both sides have one row per column: a bounded broadcast
    return long.join(F.broadcast(q), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


# ---------------------------------------------------------------- association

def target_correlations(df: DataFrame, y: str, cols: Sequence[str], top: int = 15) -> DataFrame:
    """|Pearson r| of each numeric column with the target, top-k."""
    one = df.agg(*[safe_corr(F.col(f"`{c}`").cast("double"), F.col(y).cast("double")).alias(c)
                   for c in cols])
    long = _long(one, cols, "corr")
    return (long.filter(F.col("corr").isNotNull())
            .select("column", F.abs("corr").alias("abs_corr"))
            .orderBy(F.desc("abs_corr"), F.asc("column")).limit(top))


def eta_squared(df: DataFrame, y: str, cols: Sequence[str], top: int = 15,
                missing: str = "Missing") -> DataFrame:
    """Between-level share of target variance per categorical column.

    One pass over an unpivoted (column, level, y) view grouped by level
    (partial aggregation absorbs hot levels), then a tiny per-column sum.
    """
    yy = F.col(y).cast("double")
    base = df.filter(F.col(y).isNotNull())
    overall = base.agg(F.avg(yy).alias("m")).collect()[0].m
    if overall is None:
        return df.sparkSession.createDataFrame([], "column string, eta2 double")
    sst = base.agg(F.sum((yy - F.lit(overall)) ** 2).alias("s")).collect()[0].s
    levels = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(missing)).alias("level"))
        for c in cols]))
    grouped = (base.select(yy.alias("_y"), levels.alias("_l"))
               .groupBy("_l.column", "_l.level")
               .agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("m")))
    between = grouped.groupBy("column").agg(
        F.sum(F.col("n") * (F.col("m") - F.lit(overall)) ** 2).alias("ssb"))
    eta = (F.col("ssb") / F.lit(sst)) if sst else F.lit(0.0)
    return (between.select("column", eta.alias("eta2"))
            .orderBy(F.desc("eta2"), F.asc("column")).limit(top))


def histogram(df: DataFrame, x, bins: int = 35) -> DataFrame:
    """Equal-width bins over [min, max], last bin right-closed."""
    xc = (F.col(x) if isinstance(x, str) else x).cast("double")
    xc = F.when(~F.isnan(xc), xc)
    lim = df.agg(F.min(xc).alias("lo"), F.max(xc).alias("hi")).collect()[0]
    lo, hi = lim.lo, lim.hi
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n bigint")
    width = (hi - lo) / bins
    b = (F.lit(1) if hi == lo else
         F.least(F.floor(F.lit(float(bins)) * (xc - F.lit(lo)) / F.lit(hi - lo)) + 1, F.lit(bins)))
    counts = (df.filter(xc.isNotNull()).groupBy(b.cast("int").alias("bin"))
              .agg(F.count(F.lit(1)).cast("bigint").alias("n")))
    domain = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (domain.join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


# ---------------------------------------------------------------- validation

def schema_check(df: DataFrame, expected: Iterable[str], target: str | None = None,
                 require_target: bool = True) -> None:
    """V1 + V2: exact feature-name set; the error lists missing and extra names."""
    expected = set(expected)
    actual = set(df.columns) - ({target} if target else set())
    missing, extra = sorted(expected - actual), sorted(actual - expected)
    if missing or extra:
        raise ValueError(f"invalid schema: missing={missing}; extra={extra}")
    if require_target and target and target not in df.columns:
        raise ValueError(f"training data must contain the target {target!r}")


def key_violations(df: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """V3: null and duplicate keys (one shuffle on the key)."""
    return duplicate_keys(df, key).select("rows", "null_keys", "duplicate_keys")


def target_violations(df: DataFrame, y: str) -> DataFrame:
    """V4: target must be numeric, finite and > 0 -- one aggregation."""
    v = to_number(F.col(y).cast("string"))
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        count_true(v.isNull()).alias("not_numeric"),
        count_true(v.isNotNull() & not_finite(v)).alias("not_finite"),
        count_true(v.isNotNull() & ~not_finite(v) & (v <= 0)).alias("not_positive"))


def all_finite(df: DataFrame, col: str) -> DataFrame:
    """Number of non-finite values (must be 0)."""
    return df.agg(count_true(not_finite(F.col(col))).alias("non_finite"))


def same_columns(a: DataFrame, b: DataFrame) -> None:
    """V6: prepared train/test column lists must be identical (ordered)."""
    if a.columns != b.columns:
        raise ValueError(f"column mismatch: {a.columns} vs {b.columns}")


def check_target(df: DataFrame, y: str) -> None:
    bad = target_violations(df, y).collect()[0]
    if bad.not_numeric or bad.not_finite or bad.not_positive:
        raise ValueError(f"target {y!r} must be positive and finite: {bad.asDict()}")


def check_key(df: DataFrame, key: str) -> None:
    bad = key_violations(df, key).collect()[0]
    if bad.null_keys or bad.duplicate_keys:
        raise ValueError(f"key {key!r} must be complete and unique: {bad.asDict()}")


def quality_report(df: DataFrame, key: str, target: str) -> dict:
    """The audit as one nested dict (the JSON report of the reference)."""
    num = [c for c in numeric_columns(df)]
    rep = table_counts(df, target).collect()[0].asDict()
    rep.update(duplicate_rows(df).select("duplicate_rows").collect()[0].asDict())
    rep["duplicate_ids"] = duplicate_keys(df, key).collect()[0].duplicate_keys
    rep.update(null_totals(df).collect()[0].asDict())
    rep.update(quote_count(df).collect()[0].asDict())
    prof = target_profile(df, target, key).collect()[0].asDict()
    rep.update({f"target_{k}": v for k, v in prof.items()})
    rep.update({("target_skew" if k == "skew" else "log_target_skew"): v
                for k, v in skewness_pair(df, target).collect()[0].asDict().items()})
    rep["top_iqr_outliers"] = {r.column: r.n_outliers for r in iqr_outliers(df, num, key).collect()}
    rep["missing_rates"] = {r.column: r.null_rate for r in
                            null_profile(df).orderBy(F.desc("null_rate"), "column").collect()}
    return rep
