"""Substring dedup by seed and extend over winnowed anchors.

Seeds: of the ``anchor``-word sequences in each window of ``length`` words the
one with the smallest hash is the window's anchor (winnowing), so equal windows
have equal anchors at equal places, and a text has one anchor in several words.
Anchors that documents of different ids share are the seeds.

Extension: a seed's context reaches both ways over all the windows that chose
it.  Occurrences with equal context are one class, and all its windows repeat
in the documents after the class's first.  Classes that share a seed but differ
somewhere are extended to their common part: one text per class gives its
windows, and a window found in a class with a smaller first document repeats.
Repeats that overlap join into maximal ones when their words are removed.

Scale: per anchor 24 bytes are shuffled, counted or combined before the
exchange; only seeds, and of these only one text per class, go further.  No
pairs of documents are formed, so a passage in a third of all documents costs a
row each.  Texts are shuffled by id to meet their removals, in bounded slices.

Defined results: words are runs of other than ASCII white space, unchanged; a
word goes when a window over it also starts in a row with a smaller doc_id.  A
null text has no words; texts below ``length`` words and rows with a null doc_id
(which has no order) lose nothing and give nothing.  Rows repeated under one
doc_id don't remove each other and get equal results.  Other columns stay; an
empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import drop_stages, stage
from .arrow import as_bytes, map_slices, text_bytes, text_slices
from .mph import mix

SLICE = 256 << 10
PIECE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _sums(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=out[1:])
    return out


def word_hashes(flat: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of a byte string, in pieces of bounded size."""
    hashes, starts, at = [], [], 0
    whole = np.frombuffer(flat, np.uint8)
    while at < len(whole):
        to = min(len(whole), at + PIECE)
        while to < len(whole) and not SPACE[whole[to]]:
            to += 1
        buf = whole[at:to]
        gap = SPACE[buf]
        edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        size = end - start
        if len(size):
            # sum of byte value times power of the place in the word, over words laid end to end
            first = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(first, size)
            sums = _sums(BYTE[buf[~gap]] * _powers(BASE, int(size.max()))[place])
            hashes.append(mix(sums[first + size] - sums[first] + size.astype(np.uint64)))
            starts.append(start + at)
        at = to
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


class Occurrences:
    """Anchors of a list of texts: per occurrence its text, hash, context and windows."""

    def __init__(self, texts: list[bytes], length: int, anchor: int):
        begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.zeros(0, np.int64)
        self.word, start = word_hashes(b"\n".join(texts))
        text = np.searchsorted(begin, start, side="right") - 1
        self.words = np.bincount(text, minlength=len(texts))
        self.first_word = np.cumsum(self.words) - self.words
        self.length = length
        n = len(self.word) - length + 1
        window = np.flatnonzero(text[length - 1:] == text[:n]) if n > 0 else np.zeros(0, np.int64)
        if not len(window):
            self.text = self.low = self.many = np.zeros(0, np.int64)
            self.anchor = self.context = np.zeros(0, np.uint64)
            self.sums = self.undo = np.zeros(1, np.uint64)
            return
        seed = np.zeros(len(self.word) - anchor + 1, np.uint64)
        for i in range(anchor):
            seed = seed * BASE + self.word[i:i + len(seed)]
        seed = mix(seed)
        least, at = seed[:n].copy(), np.zeros(n, np.int64)
        for i in range(1, length - anchor + 1):
            here = seed[i:i + n]
            less = here <= least
            np.copyto(least, here, where=less)
            at[less] = i
        place = (np.arange(n) + at)[window]
        new = np.ones(len(window), bool)
        new[1:] = (place[1:] != place[:-1]) | (text[window[1:]] != text[window[:-1]])
        head = np.flatnonzero(new)
        self.low = window[head]
        self.many = np.diff(np.concatenate((head, [len(window)])))
        self.text, self.anchor = text[self.low], seed[place[head]]
        self.sums = _sums(self.word * _powers(BASE, len(self.word)))
        self.undo = _powers(INVERSE, len(self.word) + 1)
        self.context = mix(self.span(self.low, self.low + self.many + length - 1) + (place[head] - self.low).astype(np.uint64))

    def span(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the words from a to b, without b."""
        return mix((self.sums[b] - self.sums[a]) * self.undo[a] + (b - a).astype(np.uint64))

    def windows(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(occurrence, offset, hash) of every window of the chosen occurrences."""
        many = self.many[of]
        owner = np.repeat(of, many)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        a = self.low[owner] + offset
        return owner, offset, self.span(a, a + self.length)

    def key(self) -> np.ndarray:
        return class_key(self.anchor, self.context)


def class_key(anchor: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix(anchor * BASE + context)


def _ids(part: pa.RecordBatch) -> np.ndarray:
    return part.column(part.schema.get_field_index("doc_id")).to_numpy(zero_copy_only=False).astype(np.int64)


def occurrences(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """(anchor, context, doc_id), once per document."""
    def run(batches):
        for part in text_slices(batches, limit=SLICE):
            occ = Occurrences(text_bytes(part), length, anchor)
            ids = _ids(part)[occ.text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(occ.anchor.view(np.int64)), pa.array(occ.context.view(np.int64)), pa.array(ids)],
                names=["anchor", "context", "doc_id"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(
        "doc_id is not null and text is not null").mapInArrow(run, "anchor long, context long, doc_id long")


def class_windows(docs: DataFrame, firsts: DataFrame, length: int, anchor: int) -> DataFrame:
    """(anchor, context, first, offset, window) of classes (anchor, context, first), read from their first document."""
    wanted = firsts.groupBy("first").agg(F.collect_list(F.struct("anchor", "context")).alias("of"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        wanted, F.col("doc_id") == F.col("first")).select(
        "doc_id", "text", F.col("of.anchor").alias("anchors"), F.col("of.context").alias("contexts"))

    def run(batches):
        for part in text_slices(batches, limit=SLICE):
            occ = Occurrences(text_bytes(part), length, anchor)
            asked = []
            for a, c in zip(part.column(2), part.column(3)):
                asked.append(class_key(a.values.to_numpy().view(np.uint64), c.values.to_numpy().view(np.uint64)))
            mine, own = occ.key(), np.zeros(len(occ.text), bool)
            cut = np.searchsorted(occ.text, np.arange(len(asked) + 1))
            for i, keys in enumerate(asked):
                own[cut[i]:cut[i + 1]] = np.isin(mine[cut[i]:cut[i + 1]], keys)
            owner, offset, window = occ.windows(np.flatnonzero(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(occ.anchor[owner].view(np.int64)), pa.array(occ.context[owner].view(np.int64)),
                 pa.array(_ids(part)[occ.text[owner]]), pa.array(offset.astype(np.int32)), pa.array(window.view(np.int64))],
                names=["anchor", "context", "first", "offset", "window"])

    return rows.mapInArrow(run, "anchor long, context long, first long, offset int, window long")


def free_shuffles(spark) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps, which it does on a driver GC."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def removals(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """(doc_id, anchor, context, mask): windows to remove of a document's occurrences, bit i the i-th window.

    The result is written; what led to it is deleted.
    """
    spark = docs.sparkSession
    seeds = stage(occurrences(docs, length, anchor).groupBy("anchor")
                  .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                  .filter("a < b").select("anchor"), "seeds")
    free_shuffles(spark)
    found = stage(occurrences(docs, length, anchor).join(seeds.hint("shuffle_hash"), "anchor"), "occurrences")
    free_shuffles(spark)
    classes = stage(found.groupBy("anchor", "context").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "classes")
    mixed = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    windows = stage(class_windows(docs, classes.join(mixed, "anchor"), length, anchor), "windows")
    free_shuffles(spark)
    earliest = windows.groupBy("anchor", "window").agg(F.min("first").alias("least"))
    part = (windows.join(earliest, ["anchor", "window"]).filter("least < first")
            .groupBy("anchor", "context").agg(F.bit_or(F.expr("shiftleft(1L, offset)")).alias("mask"), F.min("first").alias("first"))
            .select(F.col("first").alias("doc_id"), "anchor", "context", "mask"))
    whole = (found.join(classes.filter("first < last").select("anchor", "context", "first"), ["anchor", "context"])
             .filter("doc_id > first").select("doc_id", "anchor", "context", F.lit(-1).cast("long").alias("mask")))
    gone = stage(whole.unionByName(part), "removals")
    drop_stages(seeds, found, classes, windows)
    free_shuffles(spark)
    return gone


def remove_repeats(docs: DataFrame, length: int = 13, anchor: int = 5) -> DataFrame:
    """``docs`` with text cut to its kept words (joined by one space), plus n_words and n_removed."""
    if not 1 <= anchor <= length <= 63 + anchor:
        raise ValueError("need 1 <= anchor <= length <= anchor + 63")
    gone = removals(docs, length, anchor)
    per_doc = gone.groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_list(F.struct("anchor", "context", "mask")).alias("__of"))
    keep = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    plain = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else f"c{i}") for i, c in enumerate(keep)],
                        F.col("doc_id").cast("long").alias("__id"))
    rows = plain.join(per_doc, "__id", "left").select(
        *plain.columns[:-1], F.col("__of.anchor").alias("anchors"), F.col("__of.context").alias("contexts"), F.col("__of.mask").alias("masks"))

    def run(part, column):
        texts = as_bytes(column)
        lists = [part.column(len(keep) + i) for i in range(3)]
        hit = np.flatnonzero(lists[0].is_valid().to_numpy(zero_copy_only=False))
        occ = Occurrences([texts[i] for i in hit], length, anchor)
        cut = np.searchsorted(occ.text, np.arange(len(hit) + 1))
        masks, mine = np.zeros(len(occ.text), np.int64), occ.key()
        for j, i in enumerate(hit):
            a, c, m = (x[int(i)].values.to_numpy() for x in lists)
            keys = class_key(a.view(np.uint64), c.view(np.uint64))
            order = np.argsort(keys)
            own = mine[cut[j]:cut[j + 1]]
            where = np.minimum(np.searchsorted(keys[order], own), len(keys) - 1)
            masks[cut[j]:cut[j + 1]] = np.where(keys[order][where] == own, m[order][where], 0)
        owner, offset, _ = occ.windows(np.flatnonzero(masks))
        a = (occ.low[owner] + offset)[(masks[owner] >> offset) & 1 == 1]
        level = np.zeros(len(occ.word) + 1, np.int64)
        np.add.at(level, a, 1)
        np.add.at(level, a + length, -1)
        stays = np.cumsum(level[:-1]) == 0
        of = dict(zip(hit.tolist(), range(len(hit))))
        kept, n_words, n_removed = [], [], []
        for i, t in enumerate(texts):
            words = t.split()
            n_words.append(len(words))
            if i in of and len(words):
                b = int(occ.first_word[of[i]])
                words = list(itertools.compress(words, stays[b:b + len(words)].tolist()))
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        return {"text": pa.array(kept, pa.binary()).cast(pa.string()),
                "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}

    out = map_slices(rows, run, StructType().add("n_words", "long").add("n_removed", "long"), SLICE)
    return out.drop("anchors", "contexts", "masks").toDF(*keep, "n_words", "n_removed")
