"""Query catalogue, part 4: contracts on inputs with gaps (nulls, NaN, CSV text, templates)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.infer import apply_output_template, with_row_index
from ..operators.quality import duplicate_rows, null_profile
from ..operators.split import stratified_split
from ..session import checkpoint_dir
from ..sources.io import read_csv_table
from ..sources.tables import docs, read_table
from .catalogue import query
from .common import SPLIT_SEED, rounded


@query
def nan_audit(spark, sf):
    """A4: NaN and null of a floating column both count as missing."""
    v = F.when(F.col("doc_id") % 7 == 0, F.lit(float("nan"))).when(
        F.col("doc_id") % 11 != 0, F.col("n_chars").cast("double"))
    return rounded(null_profile(read_table(spark, sf, "documents").select("doc_id", v.alias("v")), ["doc_id", "v"]))


@query
def null_strata_split(spark, sf):
    """A null stratum (documents without a label) is split like any other."""
    d = docs(spark, sf).select("doc_id", "quality")
    return stratified_split(d, "doc_id", "quality", SPLIT_SEED).select("doc_id", "split")


@query
def csv_contract(spark, sf):
    """Whole texts with quotes and line breaks through CSV, columns found by name."""
    d = read_table(spark, sf, "documents").select("text", "n_chars", "doc_id")
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    d.write.options(header=True, quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False,
                    ignoreTrailingWhiteSpace=False).csv(path)
    schema = StructType([StructField("doc_id", LongType()), StructField("n_chars", LongType()), StructField("text", StringType())])
    return read_csv_table(spark, path, schema, multi_line=True).select("doc_id", "n_chars", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query
def template_fill(spark, sf):
    """Predictions in the order and columns of a template taken from the scan."""
    template = with_row_index(read_table(spark, sf, "documents").select(F.col("doc_id").alias("Id")))
    pred = read_table(spark, sf, "documents").select(F.col("doc_id").alias("Id"), (F.col("n_chars") / 2.0).alias("Prediction"))
    return apply_output_template(pred, template)


@query
def dup_events(spark, sf):
    """A2: duplicate rows among events, whose timestamps differ in microseconds."""
    e = read_table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    moved = F.when(F.col("event_id") % 20 == 0, F.timestamp_micros(F.unix_micros(ts) + F.col("event_id") % 3)).otherwise(ts)
    return duplicate_rows(e.unionByName(e.filter(F.col("event_id") % 10 == 0).withColumn("ts", moved.cast(e.schema["ts"].dataType))))
