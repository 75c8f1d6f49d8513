"""Sources/sinks and an end-to-end scoring flow on a small house-style table."""

import csv
import hashlib
import json
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tabspark.functions.clean import clean_frame
from tabspark.functions.features import HOUSE_SPEC
from tabspark.operators.design import PreprocessConfig, fit_preprocessor
from tabspark.operators.infer import apply_output_template, predict_table, with_row_index
from tabspark.operators.models import fit_linear, linear_predict
from tabspark.operators.quality import check_key, check_target, quote_count, schema_check
from tabspark.sources import io

# every numeric column that the feature specification asks for, and one that it doesn't
NUMERIC = sorted(set(HOUSE_SPEC.source_columns()) | {"LotFrontage"})
TEXT = ["ExterQual", "Neighborhood", "Alley"]
FEATURES = ["Id", *NUMERIC, *TEXT]


def _house_csv(path: str, n: int, with_target: bool, seed: int = 0) -> None:
    rng = np.random.default_rng(seed)
    header = FEATURES + (["SalePrice"] if with_target else [])
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        for i in range(n):
            row = {c: str(int(rng.integers(0, 3000))) for c in NUMERIC}
            row.update({"YrSold": str(2006 + i % 5), "YearBuilt": str(1950 + i % 60),
                        "YearRemodAdd": str(1960 + i % 50), "GarageYrBlt": "NA" if i % 7 == 0 else str(1955 + i % 50),
                        "LotFrontage": "" if i % 5 == 0 else str(60 + i % 40),
                        "OverallQual": str(1 + i % 10)})
            row["ExterQual"] = ["'Gd'", " TA ", "Ex", "NA"][i % 4]
            row["Neighborhood"] = ["NAmes", "CollgCr", "OldTown"][i % 3]
            row["Alley"] = "NA" if i % 2 else "Pave"
            row["Id"] = str(i + 1)
            if with_target:
                row["SalePrice"] = str(50000 + 40 * int(row["GrLivArea"]) + 9000 * int(row["OverallQual"]))
            w.writerow([row[c] for c in header])


def _schema(with_target: bool) -> StructType:
    fields = [StructField("Id", LongType())]
    fields += [StructField(c, DoubleType()) for c in NUMERIC]
    fields += [StructField(c, StringType()) for c in TEXT]
    if with_target:
        fields.append(StructField("SalePrice", DoubleType()))
    return StructType(fields)


def test_end_to_end_flow(spark):
    d = tempfile.mkdtemp(prefix="tabspark-flow-")
    _house_csv(f"{d}/train.csv", 120, True)
    _house_csv(f"{d}/test.csv", 30, False, seed=1)
    raw = io.read_csv_table(spark, f"{d}/train.csv", _schema(True))
    schema_check(raw, FEATURES, "SalePrice")
    check_key(raw, "Id")
    check_target(raw, "SalePrice")
    assert quote_count(raw, TEXT).first()[0] == 30
    train = clean_frame(raw)
    assert quote_count(train, TEXT).first()[0] == 0
    assert train.filter(F.col("Alley").isNull()).count() == 0          # absence filled
    assert train.filter(F.col("GarageYrBlt").isNull()).count() == 18   # NA token -> null
    cfg = PreprocessConfig(encoding="ordinal", min_frequency=5)
    fitted = fit_preprocessor(train, "Id", "SalePrice", HOUSE_SPEC, cfg,
                              {"ExterQual": ["Missing", "Po", "Fa", "TA", "Gd", "Ex"]})
    x, names = fitted.transform(train.select("Id", *[c for c in train.columns if c != "Id"]), vector=None)
    assert "HouseAge" in names and "log1p_LotArea" in names and "ExterQual" in names
    xy = x.join(train.select("Id", "SalePrice"), "Id")
    b0, beta = fit_linear(xy, "SalePrice", names, alpha=10.0)

    def score(df):
        t, _ = fitted.transform(df, vector=None)
        return t.select("Id", linear_predict(names, b0, beta).alias("pred"))

    test = clean_frame(io.read_csv_table(spark, f"{d}/test.csv", _schema(False)))
    schema_check(test, FEATURES, "SalePrice", require_target=False)
    template = with_row_index(test.select("Id"))
    pred = predict_table(test, "Id", [score], mode="single")
    out = apply_output_template(pred, template)
    assert out.columns == ["Id", "Prediction"]
    assert [r.Id for r in out.collect()] == list(range(1, 31))
    io.write_predictions_csv(out.join(template, "Id"), f"{d}/pred", single_file=True)
    part = [p for p in os.listdir(f"{d}/pred") if p.endswith(".csv")][0]
    lines = open(f"{d}/pred/{part}").read().splitlines()
    assert lines[0] == "Id,Prediction" and len(lines) == 31
    assert all(len(line.split(",")[1].split(".")[1]) == 6 for line in lines[1:])


def test_missing_column_is_fatal(spark):
    d = tempfile.mkdtemp(prefix="tabspark-flow-")
    _house_csv(f"{d}/train.csv", 5, True)
    raw = io.read_csv_table(spark, f"{d}/train.csv", _schema(True)).drop("PoolArea")
    with pytest.raises(ValueError, match="PoolArea"):
        schema_check(raw, FEATURES, "SalePrice")


def test_json_roundtrip_and_log(spark):
    d = tempfile.mkdtemp(prefix="tabspark-json-")
    rows = spark.createDataFrame([("a", 1.5, 3), ("b", 2.5, 4)], "id string, rmse double, depth int")
    log = io.experiment_log(rows, ["depth"])
    assert json.loads(log.orderBy("id").first().config_json) == {"depth": 3}
    io.write_json(log, f"{d}/log")
    back = spark.read.json(f"{d}/log")
    assert sorted(r.id for r in back.collect()) == ["a", "b"]


def test_digests(spark):
    d = tempfile.mkdtemp(prefix="tabspark-dig-")
    p = f"{d}/x.bin"
    with open(p, "wb") as fh:
        fh.write(b"hello tabspark")
    got = io.file_sha256(spark, p).first().sha256
    assert got == hashlib.sha256(b"hello tabspark").hexdigest()
    t = spark.range(0, 1000).select("id", (F.col("id") % 7).alias("m"))
    assert io.table_digest(t).first() == io.table_digest(t.repartition(5).orderBy(F.rand(1))).first()


def test_audit_record_and_signature(spark):
    scored = spark.createDataFrame([(1, 2.0)], "Id long, Prediction double")
    rec = io.audit_record(spark, scored, "in.csv", "out.csv", "abc", {"rmse": 1.0}).first()
    assert rec.rows == 1 and json.loads(rec.columns) == ["Id", "Prediction"]
    assert io.config_signature({"b": 1, "a": 2}) == io.config_signature({"a": 2, "b": 1})
