"""Mixing sources to target weights by repetition.

Tokens are summed per source, every source gets a target, and the rate target /
size says how often its documents are taken: floor(rate) copies each, plus one
copy with probability equal to the fraction, drawn from a hash of the seed and
the doc_id, so reruns agree.

Sources in code-point order (null last) weigh 1, 2, 3, repeating.  They share
all tokens by weight; no target passes ``most`` times its source's size, and
the excess is shared by weight among the others until none is above.

Scale: the only exchange over rows carries (source, size) summed per task; a
source holding a third of the rows is one row per task there.  The sharing loop
runs on the table of sources, with three sums per round fetched to the driver.
The order of sources is a distributed rank.  Targets go back by a join that
Spark broadcasts when the staged source table is small and splits when skewed.

Defined results: a null or empty text has size 0; a source without words has
target and rate 0; a null source is a source of its own, apart from any
string.  Repeated rows of one doc_id share their draw, as do rows with a null
doc_id and equal texts.  Extra columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rank import global_row_number
from ..session import stage

WORD = r"[^\x20\x09-\x0D]+"
DRAW_BITS = 52


def size_of(text):
    """Words of a text; null and empty have none."""
    gaps = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    trimmed = F.trim(gaps)
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.char_length(trimmed) - F.char_length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1).cast("long")


def draw(seed: int):
    """Uniform in [0, 1) from the seed and the doc_id (``__mark`` where that is null): 52 bits of an MD5."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null|"), F.col("__mark"))))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, DRAW_BITS // 4), 16, 10).cast("double") / float(2 ** DRAW_BITS)


def mark():
    """The text's digest, where there is no doc_id to draw by."""
    return F.when(F.col("doc_id").isNull(), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("__mark")


def source_targets(sizes: DataFrame, most: int) -> DataFrame:
    """(source, source_size, target) from (source, size)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_row_number(stage(sources, "sources"), [F.col("source").isNull(), F.col("source")], out="rank")
    ranked = stage(ranked.select("source", "source_size", ((F.col("rank") - 1) % 3 + 1).cast("long").alias("weight")), "weights")
    total, weights = ranked.agg(F.sum("source_size"), F.sum(F.when(F.col("source_size") > 0, F.col("weight")))).first()
    free, left, share = total or 0, weights or 0, ranked.filter("source_size > 0")
    while True:  # each round fixes the sources that the last share put above their limit
        over = _share(free, left) > F.col("source_size") * most
        row = share.agg(F.sum(F.when(over, F.col("source_size") * most)), F.sum(F.when(over, F.col("weight"))),
                        F.sum("weight")).first()
        fixed = (row[0] or 0, row[1] or 0)
        if (now := ((total or 0) - fixed[0], (weights or 0) - fixed[1])) == (free, left) or now[1] == 0:
            break
        free, left = now
    target = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(
        F.least(_share(free, left), (F.col("source_size") * most).cast("double")))
    return ranked.withColumn("target", target)


def _share(free: int, left: int):
    return F.lit(float(free)) * F.col("weight").cast("double") / F.lit(float(max(left, 1)))


def mix(docs: DataFrame, most: int = 3, seed: int = 17) -> DataFrame:
    """(row columns of ``sized``) plus source_size, target, copies, taken: one row per row of ``docs``."""
    sized = stage(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), mark()), "sizes")
    return with_copies(sized, source_targets(sized, most), seed).drop("__mark")


def with_copies(rows: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    t = targets.select(F.col("source").alias("__source"), "source_size", "target")
    rate = F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.col("target") / F.col("source_size"))
    copies = (F.floor("__rate") + (draw(seed) < F.col("__rate") - F.floor("__rate")).cast("long")).alias("copies")
    joined = rows.join(t, F.col("source").eqNullSafe(F.col("__source"))).drop("__source").withColumn("__rate", rate)
    return joined.select("*", copies).drop("__rate")


def mixed_documents(docs: DataFrame, most: int = 3, seed: int = 17) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    sized = docs.select("source", size_of(F.col("text")).alias("size"))
    targets = source_targets(stage(sized, "sizes"), most)
    keep = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], "doc_id", "source", mark())
    taken = with_copies(plain, targets, seed).filter("copies > 0")
    return (taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)]))
