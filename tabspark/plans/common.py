"""Shared building blocks of the query catalogue: analogue tables with bins,
splits and folds, and output rounding (so both engines compare equal)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, ShortType

from ..operators.split import stratified_kfold, stratified_split, target_bins
from ..session import drop_stages, materialize, stage
from ..sources.tables import docs, ord_table

# Fixed parameters of the catalogue.
SPLIT_SEED = 71
FOLD_SEED = 42
REPEAT_SEEDS = (42, 43, 44)
K = 5


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column and widen every integer column to bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, (IntegerType, ShortType, LongType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def docs_binned(spark: SparkSession, sf: str) -> DataFrame:
    return target_bins(docs(spark, sf), "n_chars", "doc_id")


# The split and fold tables are written once (checkpoint folder) and every
# later fit, apply and metric pass reads them, instead of re-deriving the
# analogue table (text scans, lineitem aggregation) in each pass.  Orders joined
# with lines are written before that too, for the ranks of bins, splits and folds
# read them several times; of documents those read no text.

def assigned(table: DataFrame, key: str, target: str, assign: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``assign`` (a split or folds) of the table with its target bins, written."""
    base = stage(table, "analogue")
    out = stage(assign(target_bins(base, target, key)), "assigned")
    drop_stages(base)
    return out


def docs_split(spark: SparkSession, sf: str) -> DataFrame:
    return materialize(stratified_split(docs_binned(spark, sf), "doc_id", "bin", SPLIT_SEED))


def docs_folds(spark: SparkSession, sf: str, seed: int = FOLD_SEED, k: int = K) -> DataFrame:
    return materialize(stratified_kfold(docs_binned(spark, sf), "doc_id", "bin", k, seed))


def ord_split(spark: SparkSession, sf: str) -> DataFrame:
    return assigned(ord_table(spark, sf), "o_orderkey", "o_totalprice", lambda b: stratified_split(b, "o_orderkey", "bin", SPLIT_SEED))
