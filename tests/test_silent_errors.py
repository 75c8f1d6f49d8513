"""Inputs on which rows or values used to go missing or wrong without an error."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tabspark.functions.clean import to_number
from tabspark.operators import quality
from tabspark.operators.blend import simplex_weights
from tabspark.operators.infer import apply_output_template, check_template, with_row_index
from tabspark.operators.metrics import regression_metrics
from tabspark.operators.split import quartile_label, stratified_kfold, stratified_split
from tabspark.sources import io
from tabspark.streaming.score import run_to_table, stream_table

NAN = float("nan")


def test_null_stratum_keeps_its_rows(spark):
    d = spark.range(40).select(F.col("id").alias("k"), F.when(F.col("id") % 4 > 0, (F.col("id") % 4).cast("string")).alias("s"))
    for out in (stratified_split(d, "k", "s", 1), stratified_kfold(d, "k", "s", 5, 1)):
        assert out.count() == 40
    split = stratified_split(d, "k", "s", 1).filter("s is null").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in split} == {"test": 2, "dev": 8}


def test_null_has_no_quartile(spark):
    d = spark.createDataFrame([(i, float(i)) for i in range(8)] + [(8, None)], "k long, v double")
    got = {r.k: r.quartile for r in quartile_label(d, "v", "k").collect()}
    assert got[8] is None and got[0] == "Q1" and got[7] == "Q4"


def test_nan_counts_as_missing(spark):
    d = spark.createDataFrame([(i, float(i)) for i in range(1, 10)] + [(10, NAN), (11, None)], "k long, v double")
    assert [tuple(r)[:2] for r in quality.null_profile(d, ["v"]).collect()] == [("v", 2)]
    assert quality.iqr_outliers(d, ["v"], "k").first().n_outliers == 0
    s = quality.describe(d, ["v"], "k").first()
    assert (s["count"], s["mean"], s["max"]) == (9, 5.0, 9.0)
    h = quality.histogram(d, "v", 4).collect()
    assert sum(r.n for r in h) == 9 and (h[0].lower, h[-1].upper) == (1.0, 9.0)


def test_metrics_cover_scored_rows(spark):
    d = spark.createDataFrame([(1.0, 1.5), (3.0, 2.0), (100.0, None), (None, 4.0)], "y double, p double")
    r = regression_metrics(d, "y", "p").first()
    assert r.n == 2 and abs(r.r2 - (1 - 1.25 / 2.0)) < 1e-12


def test_csv_is_read_by_name(spark):
    d = tempfile.mkdtemp(prefix="tabspark-csv-")
    with open(f"{d}/a.csv", "w", newline="") as f:
        f.write('extra,b,a\r\n1,"say ""hi"", ok",7\r\n2,"two\nlines",1d\r\n3,back\\,NA\r\n')
    schema = StructType([StructField("a", DoubleType()), StructField("b", StringType())])
    got = [tuple(r) for r in io.read_csv_table(spark, f"{d}/a.csv", schema, multi_line=True, extra="drop").collect()]
    assert got == [(7.0, 'say "hi", ok'), (None, "two\nlines"), (None, "back\\")]
    with pytest.raises(ValueError, match="absent"):
        io.read_csv_table(spark, f"{d}/a.csv", StructType([StructField("absent", LongType())]))


def test_template_order_and_keys(spark):
    t = with_row_index(spark.range(6).select(F.col("id").alias("Id")).coalesce(1))
    pred = t.select("Id", "row_index", F.lit(1.0).alias("Prediction"))
    assert [r.Id for r in apply_output_template(pred, t).collect()] == list(range(6))
    with pytest.raises(ValueError, match="order"):
        apply_output_template(pred.withColumn("row_index", -F.col("row_index")), t)
    with pytest.raises(ValueError, match="not in the template"):
        apply_output_template(pred.drop("row_index").unionByName(spark.range(99, 100).select(F.col("id").alias("Id"), F.lit(1.0).alias("Prediction"))), t)
    with pytest.raises(ValueError, match="columns"):
        check_template(pred.select("Id", "Prediction", F.lit(1).alias("more"), "row_index"), t, "Id")


def test_row_index_follows_files(spark):
    d = tempfile.mkdtemp(prefix="tabspark-files-")
    at = 0
    for i, n in enumerate((3, 5000, 40)):  # Spark packs the largest file first
        spark.range(at, at + n).coalesce(1).write.parquet(f"{d}/t/part={i}")
        at += n
    rows = with_row_index(spark.read.parquet(f"{d}/t").select("id")).collect()
    assert all(r.id == r.row_index for r in rows) and len(rows) == at


def test_stream_reads_a_folder_of_files(spark):
    d = tempfile.mkdtemp(prefix="tabspark-stream-")
    spark.range(100).repartition(4).write.parquet(f"{d}/events.parquet")
    out = run_to_table(stream_table(spark, d, "events"), lambda s: s.select("id"), out_dir=f"{d}/out")
    assert out.count() == 100


def test_java_literals_are_no_numbers(spark):
    texts = ["1d", "2f", "0x1p3", "1e3", " 2.5 ", "-.5", "5.", "1,5", "", "inf", None]
    d = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r[0] for r in d.select(to_number("s")).collect()] == [None, None, None, 1000.0, 2.5, -0.5, 5.0, None, None, float("inf"), None]


def test_stored_model_that_fails_to_load_is_kept(spark):
    d = tempfile.mkdtemp(prefix="tabspark-model-")
    spark.range(1).write.parquet(io.model_path(d, {"a": 1}))

    def broken(path):
        raise RuntimeError("unreadable")

    with pytest.raises(RuntimeError, match="unreadable"):
        io.load_or_fit(d, {"a": 1}, lambda: pytest.fail("fitted again"), broken)
    assert spark.read.parquet(io.model_path(d, {"a": 1})).count() == 1


@pytest.mark.parametrize("seed", range(6))
def test_simplex_weights_are_optimal(seed):
    rng = np.random.default_rng(seed)
    y = rng.normal(200, 50, 4000)
    common = rng.normal(0, 20, 4000)
    p = np.stack([y + common + rng.normal(0, 1 + 3 * i, 4000) + (i % 2) for i in range(5)], axis=1)
    w = simplex_weights(p.T @ p / len(y), p.T @ y / len(y))
    e = p - y[:, None]
    gram = e.T @ e / len(y)
    best = min(v @ gram @ v for v in rng.dirichlet(np.ones(5) * 0.5, 20000))
    assert abs(w.sum() - 1) < 1e-12 and (w >= 0).all() and w @ gram @ w <= best * (1 + 1e-9)
    grad = gram @ w
    assert grad[w > 1e-9].max() - grad.min() < 1e-6 * np.abs(gram).max()
