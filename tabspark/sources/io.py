"""Sources and sinks.

Readers declare their schema (no inference pass over the data); writers go
through Spark's commit protocol, which gives the atomic "write then rename"
of the original without a driver-side temp file.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructType

from ..functions.clean import na_to_null, to_number
from ..functions.encode import row_text


# ------------------------------------------------------------------ S1 CSV with NA tokens

def read_csv_table(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False,
                   extra: str = "raise") -> DataFrame:
    """Read every column as text, turn NA tokens into null, then coerce to the
    declared type (bad numbers become null).

    Columns are found by the name in the header, in any order; a column that the
    header lacks raises an error naming it, and so does one that the schema lacks
    (V1), unless ``extra`` is ``drop`` or ``keep`` (as text, behind the others).
    Quoted values follow RFC 4180: doubled quotes, commas and, with ``multi_line``,
    line breaks; without it a file is read in splits by many tasks.
    """
    if extra not in ("raise", "drop", "keep"):
        raise ValueError(f"extra must be raise, drop or keep, not {extra!r}")
    rfc = {"header": True, "multiLine": multi_line, "quote": '"', "escape": '"', "emptyValue": "", "mode": "PERMISSIVE"}
    # the header is read from the files themselves; without inference every column is text
    raw = spark.read.options(**rfc).option("inferSchema", False).option("enforceSchema", False).csv(path)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    others = [c for c in raw.columns if c not in schema.names]
    if others and extra == "raise":
        raise ValueError(f"columns of {path} that the schema lacks: {others}")
    cols = []
    for f in schema.fields:
        c = na_to_null(F.col(f"`{f.name}`"))
        if isinstance(f.dataType, NumericType):
            c = to_number(c, f.dataType)
        elif not isinstance(f.dataType, StringType):
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    if extra == "keep":
        cols += [na_to_null(F.col(f"`{c}`")).alias(c) for c in others]
    return raw.select(*cols)


# ------------------------------------------------------------------ S2 / S3 JSON

def read_json(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema else r).json(path)


def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    """S3: JSON lines; ``single_file`` is for small reports only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").json(path)


# ------------------------------------------------------------------ S4 / S5 predictions

def format_predictions(scored: DataFrame, key: str = "Id", pred: str = "Prediction",
                       order: str = "row_index", decimals: int = 6) -> DataFrame:
    """Exact columns, input order, fixed decimals (text, so no float repr drift)."""
    return (scored.orderBy(order)
            .select(F.col(key).alias(key),
                    F.format_string(f"%.{decimals}f", F.col(pred).cast("double")).alias(pred)))


def write_predictions_csv(scored: DataFrame, path: str, key: str = "Id",
                          pred: str = "Prediction", single_file: bool = False) -> None:
    """``Id,Prediction`` CSV in input order.  ``single_file`` funnels the
    already-sorted rows through one writer; leave it off for large outputs."""
    out = format_predictions(scored, key, pred)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_oof(long: DataFrame, path: str, partition_by: Sequence[str] = ("model",)) -> None:
    """OOF / test prediction tables as Parquet, partitioned by model."""
    long.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


# ------------------------------------------------------------------ S6 / S7 logs

def experiment_log(rows: DataFrame, config_cols: Sequence[str], out: str = "config_json") -> DataFrame:
    """Nested config columns flattened to one JSON string column."""
    return rows.withColumn(out, F.to_json(F.struct(*[F.col(c) for c in config_cols]))).drop(*config_cols)


def audit_record(spark: SparkSession, scored: DataFrame, input_path: str, output_path: str,
                 input_digest: str | None = None, metrics: Mapping[str, float] | None = None) -> DataFrame:
    """One row describing a scoring run (time, paths, digest, size, metrics)."""
    n = scored.count()
    rec = {
        "input_path": input_path, "output_path": output_path, "input_sha256": input_digest,
        "rows": n, "columns": json.dumps(scored.columns),
        "metrics": json.dumps(dict(metrics or {})),
    }
    return (spark.createDataFrame([rec])
            .withColumn("created_at", F.current_timestamp())
            .select("created_at", "input_path", "output_path", "input_sha256", "rows", "columns", "metrics"))


# ------------------------------------------------------------------ S8 digests

def file_sha256(spark: SparkSession, path: str) -> DataFrame:
    """Content digest of each input file, computed where the bytes are."""
    return spark.read.format("binaryFile").load(path).select(
        "path", "length", F.sha2("content", 256).alias("sha256"))


def table_digest(df: DataFrame) -> DataFrame:
    """Order-free digest of a table's rows: equal for the same multiset of rows however partitioned.

    A row's digest is the MD5 of its typed, null-marked values; its two halves are summed modulo 2^64
    over all rows and written in hex."""
    row = F.md5(row_text(df).cast("binary"))
    half = lambda at: F.conv(F.substring(row, at, 16), 16, 10).cast("decimal(20,0)")
    wrap = lambda c: F.pmod(F.col(c), F.lit(str(2 ** 64)).cast("decimal(38,0)")).cast("string")
    # decimal(38,0) holds the sum of ~10^18 halves without overflow
    sums = df.select(half(1).alias("_a"), half(17).alias("_b")).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col("_a").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("_a"),
        F.coalesce(F.sum(F.col("_b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("_b"))
    return sums.select("rows", F.lower(F.concat(*[F.lpad(F.conv(wrap(c), 10, 16), 16, "0") for c in ("_a", "_b")])).alias("digest"))


# ------------------------------------------------------------------ S9 / S10 stores

def save_params(tables: Mapping[str, DataFrame], root: str) -> None:
    """Every fitted parameter table as Parquet under ``root/name``."""
    for name, t in tables.items():
        t.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


def config_signature(config: Mapping) -> str:
    """Short hash of a config (sorted JSON), for model reuse."""
    import hashlib
    return hashlib.sha1(json.dumps(config, sort_keys=True).encode()).hexdigest()[:10]


def model_path(root: str, config: Mapping) -> str:
    return f"{root.rstrip('/')}/{config_signature(config)}"


def load_or_fit(root: str, config: Mapping, fit, loader):
    """Reuse a stored model when its config signature matches.

    Fits only where nothing is stored; a stored model that can't be read raises
    its error and stays as it is."""
    path = model_path(root, config)
    if path_exists(path):
        return loader(path)
    model = fit()
    model.write().save(path)
    return model


def path_exists(path: str) -> bool:
    spark = SparkSession.getActiveSession()
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
