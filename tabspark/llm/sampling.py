"""Bounded samples of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def held_out():
    """Rows never learnt from: crc32 of the doc_id as text is 2 modulo 4 (a null id counts as the text 'null')."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % 4 == 2


def sample_per_class(rows: DataFrame, label: str, most: int) -> tuple[list, dict]:
    """About ``most`` rows of each label, chosen by a hash of doc_id, and the rows per label.

    Fetched rows: at most about ``2 * most`` per label, cut to ``most`` in hash order.
    """
    counts = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.coalesce(*[F.when(F.col(label) == k, F.lit(min(1.0, 2.0 * most / n))) for k, n in counts.items()]) if counts else F.lit(0.0)
    picked = rows.withColumn("__draw", draw).filter(F.col("__draw") < share).collect() if counts else []
    kept = []
    for k in sorted(counts):
        kept += sorted((r for r in picked if r[label] == k), key=lambda r: r["__draw"])[:most]
    return kept, counts
