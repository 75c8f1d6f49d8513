"""Connected components of an edge table, as Spark jobs.

Alternates the two star operations until nothing changes: every node hands the
smallest node it knows to its larger neighbours (large star), then to its
smaller ones (small star).  Each round is aggregations and joins, so a hub with
a third of all edges is combined map-side and its join split by AQE; the edges
are written after each round to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("m", "u").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # large star leaves u > v; the smaller neighbours of u meet at their smallest
    least = _smallest(edges)
    lifted = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lifted.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (columns u, v), root its component's smallest node."""
    now = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        n, mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if n == 0 or (n, mark) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = (n, mark)
        now = stage(_small_star(_large_star(now)), "edges")
