"""Row-level functions: cleaning, features, target transforms, statistics."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabspark.functions import clean as C
from tabspark.functions import features as FE
from tabspark.functions.stats import safe_corr, skew_unbiased
from tabspark.functions.target import forward_target, inverse_target
from tabspark.operators.metrics import regression_metrics
from tabspark.operators.split import bin_of_rank


def test_clean_string_and_absence(spark):
    df = spark.createDataFrame([(" 'Wd Sdng' ", None), ("RL", "Pave"), (None, None)],
                               "x string, Alley string")
    out = C.clean_frame(df).collect()
    assert out[0].x == "Wd Sdng" and out[0].Alley == "None"
    assert out[1].x == "RL" and out[1].Alley == "Pave"
    assert out[2].x is None and out[2].Alley == "None"


def test_clean_string_edges(spark):
    vals = ["'", "''", "\t' a '\n", "'a", "a'", "  b  "]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(C.clean_string("v")).collect()]
    expected = []
    for v in vals:
        s = v.strip()
        if len(s) >= 2 and s.startswith("'") and s.endswith("'"):
            s = s[1:-1].strip()
        expected.append(s)
    assert got == expected


def test_na_tokens_and_coercion(spark):
    df = spark.createDataFrame([(t,) for t in ["NA", "", "null", " NA", "12.5", "x1"]], "v string")
    got = [(r.n, r.d) for r in df.select(C.na_to_null("v").alias("n"),
                                         C.to_number(C.na_to_null("v")).alias("d")).collect()]
    assert got[0] == (None, None) and got[1] == (None, None) and got[2] == (None, None)
    assert got[3] == (" NA", None)       # padded tokens are not null
    assert got[4] == ("12.5", 12.5) and got[5] == ("x1", None)


def test_age_keeps_null_and_floors(spark):
    df = spark.createDataFrame([(2010, 2000), (2000, 2010), (2010, None)], "a int, b int")
    assert [r[0] for r in df.select(FE.age("a", "b")).collect()] == [10, 0, None]


def test_sums_flags_logs(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0), (-5.0, 0.0)], "a double, b double")
    r = df.select(FE.sum_nullprop(["a", "b"]).alias("s"), FE.sum_zero(["a", "b"], [1.0, 0.5]).alias("z"),
                  FE.presence("b").alias("f"), FE.log1p_floor0("a").alias("l")).collect()
    assert r[0].s is None and r[0].z == 1.0 and r[0].f == 0.0
    assert r[1].s == 5.0 and r[1].z == 3.5 and r[1].f == 1.0
    assert r[2].l == 0.0 and math.isclose(r[1].l, math.log1p(2.0))


@pytest.mark.parametrize("mode,power", [("raw", None), ("log", None), ("power", 0.0),
                                        ("power", 0.2), ("power", 0.5), ("power", 1.0)])
def test_target_round_trip(spark, mode, power):
    df = spark.createDataFrame([(100000.0,), (150000.0,), (250000.0,)], "y double")
    back = df.select(inverse_target(forward_target("y", mode, power), mode, power)).collect()
    assert np.allclose([r[0] for r in back], [100000, 150000, 250000], rtol=1e-5)


def test_metrics_identities(spark):
    df = spark.createDataFrame([(100000.0,), (150000.0,), (250000.0,)], "y double")
    m = regression_metrics(df.withColumn("p", F.col("y")), "y", "p").first()
    assert m.rmse == 0.0 and m.mae == 0.0 and m.r2 == 1.0


def test_constant_target_r2_is_null(spark):
    df = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "y double, p double")
    assert regression_metrics(df, "y", "p").first().r2 is None


def test_skewness_matches_pandas(spark):
    rng = np.random.default_rng(0)
    x = rng.lognormal(size=200)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = df.agg(skew_unbiased("x")).first()[0]
    assert math.isclose(got, pd.Series(x).skew(), rel_tol=1e-9)
    one = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert one.agg(skew_unbiased("x")).first()[0] is None


def test_corr_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "c double, y double")
    assert df.agg(safe_corr("c", "y")).first()[0] is None


@pytest.mark.parametrize("n", [1, 2, 5, 9, 10, 11, 37, 101, 1000])
@pytest.mark.parametrize("q", [4, 7, 10])
def test_bin_formula_equals_qcut_of_ranks(spark, n, q):
    ranks = pd.Series(np.arange(1, n + 1, dtype=float))
    expected = pd.qcut(ranks, q=min(q, n), labels=False, duplicates="drop").to_numpy()
    df = spark.range(1, n + 1).select(F.col("id").alias("r"), F.lit(n).cast("bigint").alias("n"))
    got = [r.b for r in df.select("r", bin_of_rank(F.col("r"), F.col("n"), q).alias("b"))
           .orderBy("r").collect()]
    assert list(expected) == got
