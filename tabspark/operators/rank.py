"""Exact row numbers over a total order without a single-partition window (H1).

``row_number() OVER (PARTITION BY g ORDER BY o)`` puts a whole group into one
task; with few groups (ten target bins) or none (global rank) that is one task
for the whole table.  Instead:

1. range-partition on (g, o) and sort inside each range partition; because
   ``o`` ends with a unique key the bounds can split ties, so a hot value
   cannot pile up in one partition;
2. number rows inside each partition (``monotonically_increasing_id`` is the
   partition index in the upper bits and the position in the lower 33 bits);
3. checkpoint, so later steps see the same partition bounds the counts saw;
4. count rows per (partition, group) segment -- a table of at most
   partitions + groups rows -- and prefix-sum the counts per group;
5. add the offsets back with a join (broadcast when the segment table is
   small, which the count just measured).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_limit_rows, materialize

_LOW_BITS = 33


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def target_partitions(df: DataFrame) -> int:
    """Range partitions for ``df``: its estimated size / target bytes per
    partition (``tabspark.rank.partitionBytes``, default 128 MiB), never
    fewer than ``spark.sql.shuffle.partitions``; unknown sizes use the latter."""
    spark = df.sparkSession
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = int(spark.conf.get("tabspark.rank.partitionBytes", str(128 << 20)))
    def _int(v):
        return v if isinstance(v, int) else int(v.toString())

    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        leaves = plan.collectLeaves()
        scanned = 0
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            # only file scans have trustworthy sizes; checkpoints and other
            # relations may carry estimates of the plan they replaced
            if leaf.getClass().getSimpleName() != "LogicalRelation":
                return default
            scanned += _int(leaf.stats().sizeInBytes())
        # join estimates without cost-based statistics multiply the sides:
        # cap by the scanned inputs (compressed bytes, x4 for decoding)
        size = min(_int(plan.stats().sizeInBytes()), 4 * scanned)
    except Exception:  # noqa: BLE001 -- no statistics available
        return default
    if size <= 0:
        return default
    return max(default, min(size // target + 1, 1 << 17))


def range_layout(df: DataFrame, keys: Sequence[Column], parts: int) -> DataFrame:
    """Steps 1-3: range partitions sorted inside, each row tagged with
    ``_mid`` (partition index << 33 | position) and ``_pid``, written once."""
    return materialize(
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright("_mid", _LOW_BITS))
    )


def grouped_row_number(df: DataFrame, order: Sequence, group: Sequence[str] = (),
                       out: str = "rn", size_col: str | None = None,
                       num_partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Add ``out`` = 1-based row number of each row inside its group.

    ``order`` must be a total order (finish with a unique key column).
    ``size_col`` optionally adds the group size, for free from the same counts.
    ``key`` (unique) lets a wide or expensive frame be ranked through a narrow
    projection (group, order columns, key) that is joined back on the key, so
    the sampling and checkpoint passes never compute the other columns.
    """
    spark = df.sparkSession
    group = list(group)
    if key is not None:
        needed = list(dict.fromkeys([*group, *[c for c in order if isinstance(c, str)], key]))
        if len(needed) < len(df.columns):
            narrow = grouped_row_number(df.select(*needed), order, group, out, size_col,
                                        num_partitions)
            extra = [out] + ([size_col] if size_col else [])
            return df.join(narrow.select(key, *extra), key)
    keys = [_as_col(c) for c in group] + [_as_col(c) for c in order]
    ranged = range_layout(df, keys, num_partitions or target_partitions(df))
    seg = ranged.groupBy("_pid", *group).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_start"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    seg = seg.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    if size_col:
        seg = seg.withColumn(size_col, F.sum("_cnt").over(Window.partitionBy(*group)))
    seg = seg.drop("_cnt")
    # segments = partitions + groups; fetch them when that count is small
    limit = broadcast_limit_rows(spark)
    rows = seg.limit(limit + 1).collect()
    if len(rows) <= limit:
        seg = F.broadcast(spark.createDataFrame(rows, seg.schema))
    else:
        seg = materialize(seg)
    # null-safe: a null group is a group like any other
    for i, g in enumerate(group):
        seg = seg.withColumnRenamed(g, f"_g{i}")
    seg = seg.withColumnRenamed("_pid", "_spid")
    same = F.col("_pid") == F.col("_spid")
    for i, g in enumerate(group):
        same = same & F.col(f"`{g}`").eqNullSafe(F.col(f"_g{i}"))
    return ranged.join(seg, same).withColumn(
        out, (F.col("_mid") - F.col("_start") + F.col("_off") + 1).cast("bigint")
    ).drop("_mid", "_pid", "_spid", "_start", "_off", *[f"_g{i}" for i in range(len(group))])


def global_row_number(df: DataFrame, order: Sequence, out: str = "rn",
                      size_col: str | None = None, key: str | None = None) -> DataFrame:
    return grouped_row_number(df, order, (), out=out, size_col=size_col, key=key)
