"""Target bins, quartile labels, stratified split and (nested) k-fold.

A split is a column on one DataFrame (``split`` = dev/test, ``fold`` = 0..k-1),
never two copies of the table.  Every assignment is a pure function of the key,
the seed and the data, so it is repeatable under any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import column_quantiles
from .rank import global_row_number, grouped_row_number


def seeded_hash(key: str, seed: int) -> Column:
    """Deterministic shuffle order: md5 of "<key>-<seed>" (hex text)."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))


def bin_of_rank(rank: Column, n: Column, bins: int) -> Column:
    """Equal-population bin of a 1-based first-come rank (qcut of ranks).

    bin = max(0, ceil((r-1)*q/(n-1)) - 1) with q = min(bins, n), in integers.
    """
    q = F.least(F.lit(bins).cast("bigint"), n)
    ceil_ = F.floor(((rank - 1) * q + n - 2) / (n - 1))
    return F.when(n <= 1, F.lit(0)).otherwise(F.greatest(F.lit(0), ceil_ - 1)).cast("int")


def target_bins(df: DataFrame, target: str, key: str, bins: int = 10,
                out: str = "bin") -> DataFrame:
    """``qcut(y.rank(method='first'), min(bins, n))`` -- ties broken by key."""
    ranked = global_row_number(df, [target, key], out="_r", size_col="_n", key=key)
    return ranked.withColumn(out, bin_of_rank(F.col("_r"), F.col("_n"), bins)).drop("_r", "_n")


def quartile_edges(df: DataFrame, value: str, key: str) -> tuple[float, float, float]:
    """Exact linear-interpolated quartiles (fitted scalars, computed distributed)."""
    q = column_quantiles(df, [value], [0.25, 0.5, 0.75], key)
    got = {r.p: r.value for r in q.collect()}
    return got[0.25], got[0.5], got[0.75]


def quartile_label(df: DataFrame, value: str, key: str, out: str = "quartile") -> DataFrame:
    """Q1..Q4, right-closed, lowest value included (``qcut(v, 4)``); null and NaN have no label."""
    q1, q2, q3 = quartile_edges(df, value, key)
    v = F.col(value)
    label = (F.when(v <= F.lit(q1), "Q1").when(v <= F.lit(q2), "Q2")
             .when(v <= F.lit(q3), "Q3").when(v.isNotNull() & ~F.isnan(v.cast("double")), "Q4"))
    return df.withColumn(out, label)


def stratified_split(df: DataFrame, key: str, strata: str, seed: int,
                     test_pct: int = 20, out: str = "split") -> DataFrame:
    """Per stratum, the first ceil(test_pct% of n_stratum) rows in seeded
    hash order are ``test``, the rest ``dev``."""
    r = grouped_row_number(df, [seeded_hash(key, seed), key], [strata],
                           out="_r", size_col="_n", key=key)
    n_test = F.floor((F.col("_n") * test_pct + 99) / 100)
    return r.withColumn(out, F.when(F.col("_r") <= n_test, "test").otherwise("dev")).drop("_r", "_n")


def stratified_kfold(df: DataFrame, key: str, strata: str, k: int, seed: int,
                     out: str = "fold", within: tuple[str, ...] = ()) -> DataFrame:
    """fold = (position in seeded hash order inside the stratum - 1) mod k.

    ``within`` adds grouping columns (e.g. the outer fold for nested CV)."""
    # with ``within`` the key repeats (one copy per outer fold): rank in place
    r = grouped_row_number(df, [seeded_hash(key, seed), key], [*within, strata], out="_r",
                           key=None if within else key)
    return r.withColumn(out, F.pmod(F.col("_r") - 1, F.lit(k)).cast("int")).drop("_r")


def nested_kfold(df: DataFrame, key: str, strata: str, k_outer: int, k_inner: int,
                 seed: int, inner_seed: int, fold: str = "fold") -> DataFrame:
    """Rows x the outer folds they train (k-1 copies, a generator, not a
    cross join), then a stratified k-fold inside each outer training part."""
    if fold not in df.columns:
        df = stratified_kfold(df, key, strata, k_outer, seed, out=fold)
    others = F.filter(F.sequence(F.lit(0), F.lit(k_outer - 1)), lambda x: x != F.col(fold))
    expanded = df.withColumn("outer", F.explode(others)).withColumn("outer", F.col("outer").cast("int"))
    return stratified_kfold(expanded, key, strata, k_inner, inner_seed,
                            out="inner", within=("outer",))


def split_check(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """J9 + U4: sizes, dev/test key overlap and the size of their union, in
    one shuffle on the key (no self join)."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum((F.col(split) == "dev").cast("int")).alias("_dev"),
        F.sum((F.col(split) == "test").cast("int")).alias("_test"))
    return per_key.agg(
        F.sum("_rows").cast("bigint").alias("n_all"),
        F.sum("_dev").cast("bigint").alias("n_dev"),
        F.sum("_test").cast("bigint").alias("n_test"),
        F.sum(((F.col("_dev") > 0) & (F.col("_test") > 0)).cast("int")).cast("bigint").alias("n_overlap"),
        F.sum(((F.col("_dev") > 0) | (F.col("_test") > 0)).cast("int")).cast("bigint").alias("n_union"))
