"""Output contract, audit edge cases, driver entry points."""

import pytest
from pyspark.sql import functions as F

from tabspark.operators import quality as Q
from tabspark.operators.infer import check_template, order_mismatches, with_row_index

from .conftest import SF_SMALL


def test_template_order_and_reversed(spark):
    t = with_row_index(spark.range(0, 50).select(F.col("id").alias("Id")))
    out = t.select("Id", F.lit(1.0).alias("Prediction"), "row_index").repartition(4)
    check_template(out, t, "Id")
    r = order_mismatches(t, out, "Id").first()
    assert r.n_mismatch == 0 and r.n_mismatch_reversed == 50
    rev = t.select("Id", (F.lit(1000) - F.col("row_index")).alias("row_index"))
    with pytest.raises(ValueError, match="order"):
        check_template(out, rev, "Id")


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert Q.duplicate_rows(df).first().duplicate_rows == 1
    keys = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    r = Q.duplicate_keys(keys, "k").first()
    assert r.duplicate_keys == 2 and r.null_keys == 2


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 35]], "x double")
    h = {r.bin: r.n for r in Q.histogram(df, "x", bins=35).collect()}
    assert h[35] == 1 and sum(h.values()) == 5 and len(h) == 35


def test_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "k long, x double")
    assert Q.null_totals(empty).first().total_missing == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "k long, x double")
    prof = {r.column: r.null_rate for r in Q.null_profile(nulls).collect()}
    assert prof == {"x": 1.0}


def test_target_violations(spark):
    df = spark.createDataFrame([("1",), ("x",), ("-3",), ("inf",), (None,)], "y string")
    r = Q.target_violations(df, "y").first()
    assert (r.not_numeric, r.not_finite, r.not_positive) == (2, 1, 1)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() == 4
    assert set(df.columns) == {"quartile", "n", "rmse", "mae", "bias"}
