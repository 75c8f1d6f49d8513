"""Rows that are dear to make are made once, however many passes read them."""

import pytest
from pyspark.sql import functions as F

from tabspark.operators import prep as P
from tabspark.operators import quality as Q
from tabspark.operators.quantiles import column_quantiles
from tabspark.plans.common import assigned
from tabspark.operators.split import stratified_split


@pytest.fixture()
def dear(spark):
    """(rows behind a shuffle, counter of the rows made)."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def made_one(i):
        made.add(1)
        return None if i % 11 == 0 else float(i * i % 97)
    return spark.range(500).repartition(4).select(F.col("id").alias("k"), made_one("id").alias("v")), made


def test_outliers_make_rows_once(dear):
    df, made = dear
    assert Q.iqr_outliers(df, ["v"], "k").collect()[0].n_outliers == 0
    assert made.value == 500


def test_quantiles_make_rows_once(dear):
    df, made = dear
    assert len(column_quantiles(df, ["v"], [0.1, 0.5], "k").collect()) == 2
    assert made.value == 500


def test_split_makes_rows_once_and_pipeline_fits(dear):
    df, made = dear
    s = assigned(df, "k", "v", lambda b: stratified_split(b, "k", "bin", 1))
    assert s.groupBy("split").count().count() == 2
    m = P.fit_numeric(s.filter("split = 'dev'"), ["v"], "k", winsorize=True, scaler="robust")
    assert m.indicators == ["v"] and P.apply_numeric(s, m).count() == 500
    assert made.value == 500


def test_counts_by_group_of_a_wide_range(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"), (F.pow(F.lit(-1.0), F.col("id")) * F.exp(F.col("id") % 50)).alias("v")).repartition(3)
    exact = {(r.g, p): v for r in df.groupBy("g").agg(F.percentile("v", [0.1, 0.5, 0.9]).alias("q")).collect() for p, v in zip([0.1, 0.5, 0.9], r.q)}
    got = {(r.g, r.p): r.value for r in column_quantiles(df, ["v"], [0.1, 0.5, 0.9], "id", ["g"]).collect()}
    assert got.keys() == exact.keys() and all(got[k] == pytest.approx(exact[k], rel=1e-12) for k in exact)
