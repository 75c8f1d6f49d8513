"""Scoring on a stream (I1 on ``readStream``).

Fitted parameter tables are inlined as literals and linear models are plain
expressions, so the scoring plan is a stateless projection: it runs
unchanged on a streaming DataFrame.  The sink is a file sink with a
checkpoint location, so a restarted query resumes exactly once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir
from ..sources.tables import read_table


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int = 64) -> DataFrame:
    """A driver table read as a stream (schema taken from the batch reader)."""
    schema = read_table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    table = f"{sf_dir.rstrip('/')}/{name}.parquet"
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return reader.parquet(table)  # a table of many files
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def run_to_table(stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                 out_dir: str | None = None) -> DataFrame:
    """Apply ``transform`` to the stream, write every available row with an
    ``availableNow`` trigger, and return the written rows as a batch table."""
    spark = stream.sparkSession
    root = out_dir or f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    q = (transform(stream).writeStream.format("parquet")
         .option("path", f"{root}/data")
         .option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/data")
