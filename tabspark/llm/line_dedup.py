"""Line dedup over levelled sorted runs of line hashes.

The state is a set of runs, each a Parquet table of (hash, n_docs) sorted by
hash.  A batch of documents is reduced to the number of its documents per line
hash; a merge anti-join leaves out the hashes that the runs already condemn
(found in ``min_docs`` documents or more), and the rest becomes a new run of
level 0.  When a level holds ``fanout`` runs they are merged into one run of the
next level, so a hash is rewritten once per level.  At the end every line whose
hash is condemned goes, in all documents.

Scale: the lines themselves never leave the task that splits them: the state
holds 16-byte hashes and counts, counted before every exchange, so a line that
a third of the documents share is one row per task.  What goes back to the
documents are the positions of lines to drop; texts are shuffled once.

Defined results: a null or empty text is one empty line; a key is the line
with ASCII white space stripped at both ends and A-Z lower-cased, and keys of
fewer than ``min_chars`` code points are never dropped.  Every row counts as a
document, also one that repeats another; rows are told apart by doc_id and
text, so repeated rows get equal results.  A null doc_id is an id like any
other.  Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = " \t\n\x0b\x0c\r"


def line_key(line):
    return F.translate(F.trim(line, F.lit(BLANK)), UPPER, LOWER)


def lines_of(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hash(key):
    """128 bits: no two keys of a corpus are expected to meet."""
    return F.unhex(F.md5(key.cast("binary")))


def row_id():
    """Tells rows apart; rows equal in doc_id and text have equal results."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("|"),
                                  F.coalesce(F.col("text"), F.lit(""))).cast("binary")))


class Runs:
    """Levelled runs of (hash, n_docs), each sorted by hash."""

    def __init__(self, min_docs: int, fanout: int = 2):
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = []

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        out = runs[0]
        for r in runs[1:]:
            out = out.unionByName(r)
        return out.groupBy("hash").agg(F.sum("n_docs").alias("n_docs"))

    def totals(self) -> DataFrame | None:
        runs = [r for level in self.levels for r in level]
        return self._merged(runs) if len(runs) > 1 else runs[0] if runs else None

    def condemned(self) -> DataFrame | None:
        totals = self.totals()
        return None if totals is None else totals.filter(F.col("n_docs") >= self.min_docs).select("hash")

    def add(self, counts: DataFrame) -> None:
        """Add a batch's (hash, n_docs), then compact the levels that are full."""
        known = self.condemned()
        if known is not None:
            counts = counts.join(known.hint("merge"), "hash", "left_anti")
        self._put(0, counts)

    def _put(self, level: int, run: DataFrame) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(stage(run.sortWithinPartitions("hash"), f"run{level}"))
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merged(full))


def batch_counts(docs: DataFrame, n_batches: int, min_chars: int) -> DataFrame:
    """(batch, hash, n_docs): documents per line hash in each batch, in one scan."""
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), line_key),
                                     lambda k: F.char_length(k) >= min_chars))
    return (docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(n_batches)).alias("batch"), F.explode(keys).alias("key"))
            .select("batch", line_hash(F.col("key")).alias("hash"))
            .groupBy("batch", "hash").agg(F.count(F.lit(1)).alias("n_docs")))


def condemned_hashes(docs: DataFrame, min_docs: int, min_chars: int, n_batches: int) -> DataFrame:
    counts = stage(batch_counts(docs, n_batches, min_chars), "lines")
    runs = Runs(min_docs)
    for b in range(n_batches):
        runs.add(counts.filter(F.col("batch") == b).select("hash", "n_docs"))
    return stage(runs.condemned(), "condemned")


def drop_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, n_batches: int = 4) -> DataFrame:
    """``docs`` with text freed of its repeated lines, plus n_lines and n_dropped.

    ``n_batches`` is the number of loads the documents are taken in.
    """
    bad = condemned_hashes(docs, min_docs, min_chars, n_batches)
    at = (docs.select(row_id().alias("row"), F.posexplode(F.transform(lines_of(F.col("text")), line_key)))
          .filter(F.char_length("col") >= min_chars)
          .select("row", "pos", line_hash(F.col("col")).alias("hash"))
          .join(bad, "hash")
          .groupBy("row").agg(F.collect_set("pos").alias("__drop")))
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    plain = [f"c{i}" for i in range(len(rest))]
    rows = docs.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(rest, plain)], row_id().alias("__row"),
                       lines_of(F.col("text")).alias("__lines"))
    keep = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drop"))
    kept = F.transform(keep, lambda i: F.get(F.col("__lines"), i))
    return rows.join(at.withColumnRenamed("row", "__row"), "__row", "left").select(
        *plain, F.array_join(F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(kept), "\n").alias("text"),
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("n_dropped")).toDF(*rest, "text", "n_lines", "n_dropped")
