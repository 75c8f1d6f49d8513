"""Driver tables and the three analogue modelling tables built from them.

``docs``  documents LEFT JOIN labels, target ``n_chars`` (right-skewed, real nulls)
``ord``   orders x customer x nation LEFT JOIN per-order lineitem aggregates,
          target ``o_totalprice`` (orders without lines give "absent" nulls)
``ev``    events with ``k`` parsed from the JSON ``props``, target ``value``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text):
    """Maximal runs of non-white-space characters of the whole text."""
    return F.expr(f"regexp_count({text}, '\\\\S+')")


def line_count(text):
    return F.length(F.col(text)) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1


def docs(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels")
    cols = [
        "doc_id", "lang", "source", "n_chars", "quality", "toxic",
        word_count("text").cast("bigint").alias("n_words"),
        line_count("text").cast("bigint").alias("n_lines"),
    ]
    if with_text:
        cols.append("text")
    # Text-derived counts are computed before the join, so only narrow columns shuffle.
    return d.join(lab, "doc_id", "left").select(*cols)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("l_n_lines"),
        F.sum("l_quantity").alias("l_qty"),
        F.sum("l_extendedprice").alias("l_price"),
        F.max("l_discount").alias("l_max_disc"),
        F.max("l_shipdate").alias("l_last_ship"),
    )


def ord_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    lines = order_lines(spark, sf_dir)
    # nation has 25 rows by definition of the schema: a fixed-size broadcast.
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
        .join(lines, o.o_orderkey == lines.l_orderkey, "left")
        .select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
            F.year("o_orderdate").alias("o_year"), F.month("o_orderdate").alias("o_month"),
            "c_acctbal", "c_mktsegment", "n_name", "n_regionkey",
            "l_n_lines", "l_qty", "l_price", "l_max_disc",
            F.year("l_last_ship").alias("l_ship_year"),
            "o_totalprice",
        )
    )


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )
