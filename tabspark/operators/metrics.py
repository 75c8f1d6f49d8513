"""Regression metrics and their group summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .split import quartile_label


def metric_aggs(y: str, p: str) -> list[Column]:
    """RMSE, MAE, R^2 as aggregate expressions (R^2 via n * var_pop(y),
    a numerically stable total sum of squares; null for a constant target).
    Every term, ``n`` too, covers the rows that have both truth and prediction."""
    err = F.col(y).cast("double") - F.col(p).cast("double")
    scored = F.when(err.isNotNull(), F.col(y).cast("double"))
    sse = F.sum(err * err)
    sst = F.var_pop(scored) * F.count(scored)
    return [
        F.count(scored).cast("bigint").alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"),
    ]


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*metric_aggs(y, p))


def metrics_by_quartile(df: DataFrame, y: str, p: str, key: str) -> DataFrame:
    """Count, RMSE, MAE and mean bias (y - p) per quartile of the truth."""
    q = quartile_label(df, y, key, out="quartile")
    err = F.col(y).cast("double") - F.col(p).cast("double")
    return q.groupBy("quartile").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err).alias("bias"))


def worst_cases(df: DataFrame, y: str, p: str, key: str, details: DataFrame,
                top: int = 10) -> DataFrame:
    """O2 + J2: the ``top`` largest absolute errors (key breaks ties), joined
    with descriptive columns.  The top-k side is ``top`` rows: broadcast."""
    err = df.select(key, y, p, (F.col(y) - F.col(p)).alias("residual"),
                    F.abs(F.col(y) - F.col(p)).alias("abs_error"))
    worst = err.orderBy(F.desc("abs_error"), F.asc(key)).limit(top)
    return details.join(F.broadcast(worst), key)


def residual_table(df: DataFrame, y: str, p: str, key: str) -> tuple[DataFrame, tuple]:
    """(key, truth, prediction, residual) plus the truth range (for the
    identity line of a residual plot)."""
    res = df.select(key, y, p, (F.col(y) - F.col(p)).alias("residual"))
    lim = df.agg(F.min(y).alias("lo"), F.max(y).alias("hi")).first()
    return res, (lim.lo, lim.hi)


def fold_summary(fold_metrics: DataFrame, group: Sequence[str] = (), epoch: str | None = None,
                 population_std: bool = False) -> DataFrame:
    """Mean RMSE/MAE/R^2 over folds, std of RMSE (sample, 0.0 for a
    single fold; or population), truncated median of the best epoch."""
    std = F.stddev_pop("rmse") if population_std else F.coalesce(F.stddev_samp("rmse"), F.lit(0.0))
    aggs = [F.count(F.lit(1)).cast("bigint").alias("n_folds"),
            F.avg("rmse").alias("mean_rmse"), std.alias("std_rmse"),
            F.avg("mae").alias("mean_mae"), F.avg("r2").alias("mean_r2")]
    if epoch:
        aggs.append(F.median(epoch).cast("int").alias("median_best_epoch"))
    return fold_metrics.groupBy(*group).agg(*aggs)


def value_counts(df: DataFrame, col: str, as_map: bool = False) -> DataFrame:
    """Rows per state; ``as_map`` folds the (few) states into one map."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    if not as_map:
        return counts
    return counts.agg(F.map_from_entries(F.collect_list(F.struct(F.col(col), F.col("n"))))
                      .alias("counts"))


def row_mean(df: DataFrame, key: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean prediction per row over seeds / folds / repeats (long form)."""
    return df.groupBy(key, *by).agg(F.avg(pred).alias(pred), F.count(F.lit(1)).alias("n_members"))


def gain_pct(base: Column, new: Column) -> Column:
    """Relative improvement of ``new`` over ``base`` in percent."""
    return F.lit(100.0) * (base - new) / base
