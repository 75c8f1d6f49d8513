"""Stored preparation, target scaler and models; typed row text; strict CSV columns."""

import datetime
import tempfile

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tabspark.functions.encode import row_text
from tabspark.functions.features import FeatureSpec
from tabspark.operators import artifacts as A
from tabspark.operators import design, prep
from tabspark.operators.design import PreprocessConfig
from tabspark.operators.models import dense_forward, make_estimator
from tabspark.operators.quality import duplicate_rows
from tabspark.sources import io

SPEC = FeatureSpec(ages={"gap": ("b", "a")}, sums={"ab": (["a", "b"], [1.0, 0.5])}, log_candidates=("a",), nominal=("c",), drop=("junk",))
LEVELS = {"grade": ["low", "mid", "high"]}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, float(i % 17), None if i % 9 == 0 else float(i % 5), ["x", "y", None][i % 3], ["low", "high", "odd", None][i % 4], "j", 50.0 + 3 * (i % 17) + i % 5)
            for i in range(300)]
    return spark.createDataFrame(data, "id long, a double, b double, kind string, grade string, junk string, y double").cache()


def fitted(rows, regressor, mode="raw", power=None):
    config = PreprocessConfig(winsorize=True, encoding="ordinal", min_frequency=2, scaler="robust")
    return Pipeline(stages=[A.Preparation("id", "y", SPEC, config, LEVELS), A.ScaledTarget(regressor, "y", mode, power)]).fit(rows)


def values(df, c="pred"):
    return {r["id"]: r[c] for r in df.collect()}


@pytest.mark.parametrize("kind, mode, power", [("ridge", "raw", None), ("gbt", "log", None), ("rf", "power", 0.5)])
def test_pipelines_score_alike_before_and_after_storing(spark, rows, kind, mode, power):
    model = fitted(rows, make_estimator(kind, seed=1, **({"rounds": 3} if kind == "gbt" else {"trees": 3} if kind == "rf" else {})), mode, power)
    path = tempfile.mkdtemp(prefix="tabspark-store-") + "/m"
    model.write().save(path)
    again = PipelineModel.load(path)
    want, got = values(model.transform(rows)), values(again.transform(rows))
    assert want == got and len(want) == 300 and np.isfinite(list(want.values())).all()
    assert set(again.transform(rows).columns) == {*rows.columns, "features", "pred"}
    unseen = rows.limit(3).withColumn("kind", F.lit("new")).withColumn("grade", F.lit("new"))
    assert values(again.transform(unseen)).keys() == values(model.transform(unseen)).keys()


def test_store_modes_missing_members_and_non_finite(spark, rows):
    root = tempfile.mkdtemp(prefix="tabspark-store-")
    one = fitted(rows, make_estimator("ridge"))
    prepared = one.stages[0]
    two = PipelineModel([prepared, A.ScaledTarget(make_estimator("gbt", seed=3, rounds=2), "y").fit(prepared.transform(rows.filter("id % 2 = 0")))])
    A.save_scorers(root, one, {"a": one, "b": two}, {"seed": 7})
    single, many = (values(A.predict_from_store(spark, root, rows, m), "Prediction") for m in ("single", "ensemble"))
    a, b = values(one.transform(rows)), values(two.transform(rows))
    assert single == {i: max(0.0, v) for i, v in a.items()}
    assert all(abs(many[i] - max(0.0, (a[i] + b[i]) / 2)) < 1e-9 for i in a)
    assert A.load_scorers(spark, root)[1] == {"seed": 7, "members": ["a", "b"]}
    other = spark.newSession()
    loaded = A.predict_from_store(other, root, other.createDataFrame(rows.collect(), rows.schema), "ensemble")
    assert values(loaded, "Prediction") == many
    plan = A.predict_from_store(spark, root, rows, "ensemble")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    with pytest.raises(ValueError):
        A.load_scorers(spark, root, "best")
    A.save_scorers(root, one, {"a": one}, {})
    bad = root + "-bad"
    A.save_scorers(bad, one, {}, {})
    with pytest.raises(FileNotFoundError):
        A.load_scorers(spark, bad, "ensemble")
    spark.createDataFrame([('{"members": ["a", "gone"]}',)], "value string").write.mode("overwrite").text(f"{root}/metadata")
    with pytest.raises(FileNotFoundError, match="gone"):
        A.load_scorers(spark, root, "ensemble")
    broken = A.ScaledTargetModel(one.stages[1].model, center=float("nan"), scale=1.0, mode="raw")
    with pytest.raises(Exception, match="not finite"):
        A.score_with([PipelineModel([prepared, broken])], rows).collect()


def test_dense_net_stage(spark, rows):
    net = A.DenseNet(layers=(8,), activation="tanh", epochs=6, lr=0.05, seed=2)
    model = fitted(rows, net, "log")
    path = tempfile.mkdtemp(prefix="tabspark-store-") + "/m"
    model.write().save(path)
    got = values(PipelineModel.load(path).transform(rows))
    x = {r["id"]: r["features"].toArray() for r in model.stages[0].transform(rows).collect()}
    scaled = model.stages[1]
    import json
    ws = [np.array(w, float) for w in json.loads(scaled.model.getOrDefault("weights"))]
    z = dense_forward(np.array([x[i] for i in sorted(x)]), ws, "tanh")
    want = np.expm1(z * scaled.getOrDefault("scale") + scaled.getOrDefault("center"))
    assert np.allclose([got[i] for i in sorted(got)], want) and net.history[-1]["train_loss"] < net.history[0]["train_loss"]


def test_wide_dictionaries_are_stored_beside_the_metadata(spark, monkeypatch):
    monkeypatch.setattr(prep, "MAX_DENSE_LEVELS", 20)
    df = spark.range(200).select("id", F.concat(F.lit("level"), (F.col("id") % 60).cast("string")).alias("c"), (F.col("id") % 7).cast("double").alias("v"), F.rand(1).alias("y"))
    model = A.Preparation("id", "y", FeatureSpec(), PreprocessConfig(feature_engineering=False, add_log_features=False)).fit(df)
    path = tempfile.mkdtemp(prefix="tabspark-store-") + "/p"
    model.write().save(path)
    again = A.PreparationModel.load(path)
    first = {r["id"]: r["features"] for r in model.transform(df).collect()}
    assert first == {r["id"]: r["features"] for r in again.transform(df).collect()} and first[0].size == 61


# ------------------------------------------------------------------ typed rows

def test_row_text_keeps_values_apart(spark):
    t = datetime.datetime
    rows = [(None, "a"), ("a", None), ("", "a"), ("a", ""), ("-", None), ("1:a", "b"), ("1", ":ab")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(row_text(df).alias("r")).distinct().count() == len(rows)
    stamps = spark.createDataFrame([(t(2024, 1, 1, 0, 0, 0, 1),), (t(2024, 1, 1, 0, 0, 0, 2),)], "ts timestamp")
    assert duplicate_rows(stamps).first().distinct_rows == 2
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (None,)], "v double")
    assert duplicate_rows(zeros).first()[:] == (5, 3, 2)
    nested = spark.createDataFrame([([1, None], {"a": 1.0, "b": 2.0}, bytearray(b"\x01")), ([1, None], {"b": 2.0, "a": 1.0}, bytearray(b"\x01")),
                                    ([None, 1], {"a": 1.0}, None)], "l array<int>, m map<string,double>, b binary")
    assert duplicate_rows(nested).first()[:] == (3, 2, 1)
    a, b = spark.createDataFrame([(None, "a")], "x string, y string"), spark.createDataFrame([("a", None)], "x string, y string")
    assert io.table_digest(a).first() != io.table_digest(b).first()
    assert io.table_digest(a.limit(0)).first()[:] == (0, "0" * 32)
    assert io.table_digest(df).first() == io.table_digest(df.repartition(5)).first() != io.table_digest(df.union(df)).first()


def test_csv_with_columns_that_the_schema_lacks(spark):
    d = tempfile.mkdtemp(prefix="tabspark-csv-")
    with open(f"{d}/a.csv", "w") as f:
        f.write("more,b,a\n1,x,7\nNA,y,8\n")
    schema = StructType([StructField("a", LongType()), StructField("b", StringType())])
    with pytest.raises(ValueError, match="more"):
        io.read_csv_table(spark, f"{d}/a.csv", schema)
    assert [tuple(r) for r in io.read_csv_table(spark, f"{d}/a.csv", schema, extra="drop").collect()] == [(7, "x"), (8, "y")]
    assert [tuple(r) for r in io.read_csv_table(spark, f"{d}/a.csv", schema, extra="keep").collect()] == [(7, "x", "1"), (8, "y", None)]
    big = spark.range(200_000).select("id", F.lit("text").alias("t"))
    big.coalesce(1).write.option("header", True).csv(f"{d}/big")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        read = io.read_csv_table(spark, f"{d}/big", StructType([StructField("id", LongType()), StructField("t", StringType())]))
        assert read.rdd.getNumPartitions() > 4 and read.select("id").distinct().count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
