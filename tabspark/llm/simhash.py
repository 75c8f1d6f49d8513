"""SimHash near-dedup by bit-sliced comparison.

A fingerprint has a bit set when more than half of the XXH64 values (seed 42)
of a text's word shingles have it.  Fingerprints within ``radius`` bits link,
and documents whose fingerprints connect form a group.

Candidates are exact: cut into ``radius + 2`` blocks of bits, two fingerprints
within the radius agree on two blocks at least, so each distinct fingerprint is
put under every choice of two blocks.  In a bucket the fingerprints lie as bit
planes, 64 to a machine word: one query is compared with 64 others at a time,
the distances held in carry-save counters (bit 0, bit 1, ... of 64 counts), and
a word whose 64 counts have all passed the radius is abandoned.

Scale: texts are read once and never shuffled; copies are one fingerprint
before any comparison; buckets of over ``BUCKET`` fingerprints are cut into
pieces compared pairwise by separate tasks.  A task keeps a spanning forest of
the links it finds, so a dense group yields no more rows than it has members.

Defined results: words are runs of other than ASCII white space with A-Z
lower-cased; fewer words than a shingle make one shingle of the whole text; a
null, empty or blank text has fingerprint zero and links like any other.  The
component id is the smallest doc_id reachable (nulls are passed over; null if
no member has one).  Repeated rows get equal results; other columns are left
alone; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import drop_stages, stage
from .arrow import as_bytes, longs, map_slices, text_bytes, text_slices
from .components import components

SEED = 42
BUCKET = 8192
LANES = 1 << 16
ROWS = 1 << 20


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned 64-bit fingerprint of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for a in range(0, n, ROWS):
        raw = b"".join([digest(flat[i:j], SEED) for i, j in zip(starts[a:a + ROWS], ends[a:a + ROWS])])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _prints(texts: list[bytes], shingle: int) -> pa.Array:
    return pa.array(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    def run(batches):
        for part in text_slices(batches):
            yield pa.RecordBatch.from_arrays([longs(part, "doc_id"), _prints(text_bytes(part), shingle)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def block_masks(radius: int) -> list[int]:
    """Bits of each choice of two blocks out of ``radius + 2``."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(n)]
    return [a | b for a, b in itertools.combinations(blocks, 2)]


def _planes(fps: np.ndarray, word: np.ndarray, bit: np.ndarray, words: int) -> np.ndarray:
    """Vertical layout: plane p of word w has bit b set if that fingerprint has bit p."""
    out = np.zeros((64, words), np.uint64)
    place = np.uint64(1) << bit.astype(np.uint64)
    for p in range(64):
        on = (fps >> np.uint64(p)) & np.uint64(1)
        np.bitwise_or.at(out[p], word, on * place)
    return out


def _within(planes: np.ndarray, fps: np.ndarray, query: np.ndarray, word: np.ndarray, start: np.ndarray,
            bits: list[int], radius: int) -> np.ndarray:
    """For every lane (query, word): a word with a bit for each member within the radius.

    ``start`` has the members not to compare; ``bits`` are the planes that can differ.
    """
    levels = max(1, radius.bit_length())
    hit = np.zeros(len(query), np.uint64)
    live = np.arange(len(query))
    count = [np.zeros(len(query), np.uint64) for _ in range(levels)]
    past = start.copy()
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for k in range(0, len(bits), 2):
        q, w = fps[query[live]], word[live]
        pair = []
        for p in bits[k:k + 2]:
            row = np.uint64(0) - ((q >> np.uint64(p)) & np.uint64(1))
            pair.append(planes[p][w] ^ row)
        a, b = pair if len(pair) == 2 else (pair[0], np.zeros_like(pair[0]))
        # carry-save adder: two planes and the low counter make a sum and a carry
        low, half = count[0], a ^ b
        carry = (a & b) | (half & low)
        count[0] = half ^ low
        for i in range(1, levels):
            count[i], carry = count[i] ^ carry, count[i] & carry
        past |= carry
        if k % 8 == 6:  # abandon words in which all counts have passed the radius
            over = past | _above(count, radius)
            on = over != full
            if not on.all():
                live, past = live[on], past[on]
                count = [c[on] for c in count]
                if not len(live):
                    return hit
    hit[live] = ~(past | _above(count, radius))
    return hit


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Bit-sliced comparison count > radius."""
    more, equal = np.zeros_like(count[0]), ~np.zeros_like(count[0])
    for i in range(len(count) - 1, -1, -1):
        if radius >> i & 1:
            equal &= count[i]
        else:
            more |= equal & count[i]
            equal &= ~count[i]
    return more


def bucket_links(fps: np.ndarray, group: np.ndarray, side: np.ndarray, mask: int, radius: int) -> np.ndarray:
    """Spanning forest (pairs of positions) of the links inside each group.

    Rows are sorted by group.  ``side`` is 0 and 1 for the two pieces of a cut
    bucket, between which alone is compared, and 2 for an uncut one.
    """
    n = len(fps)
    if n == 0:
        return np.zeros((0, 2), np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1))
    size = np.diff(np.concatenate((first, [n])))
    rank = np.arange(n) - np.repeat(first, size)
    words_of = -(-size // 64)
    base = np.concatenate(([0], np.cumsum(words_of)[:-1]))
    word = np.repeat(base, size) + rank // 64
    bit = rank % 64
    total = int(words_of.sum())
    planes = _planes(fps, word, bit, total)
    valid, ones = np.zeros(total, np.uint64), np.zeros(total, np.uint64)
    place = np.uint64(1) << bit.astype(np.uint64)
    np.bitwise_or.at(valid, word, place)
    np.bitwise_or.at(ones, word[side == 1], place[side == 1])
    bits = [p for p in range(64) if not mask >> p & 1]
    # one lane for each query and each word of its group from its own word on
    many = np.repeat(base + words_of, size) - word
    many[(np.repeat(size, size) == 1)] = 0
    ends = np.cumsum(many)
    found, parent = [], np.arange(n)
    begin = np.searchsorted(ends, np.arange(0, int(ends[-1]), LANES), side="right") if ends[-1] else []
    for a, b in zip(begin, [*begin[1:], n]):
        query = np.repeat(np.arange(a, b), many[a:b])
        if not len(query):
            continue
        to = word[query] + (np.arange(len(query)) - np.repeat(np.concatenate(([0], np.cumsum(many[a:b])[:-1])), many[a:b]))
        shut = ~valid[to]
        own = to == word[query]  # in its own word a query meets only what comes after it
        shut[own] |= (place[query[own]] << np.uint64(1)) - np.uint64(1)
        cut = side[query] != 2
        shut[cut] |= np.where(side[query[cut]] == 0, ~ones[to[cut]], ones[to[cut]])
        hit = _within(planes, fps, query, to, shut, bits, radius)
        for lane in np.flatnonzero(hit):
            h, q = int(hit[lane]), int(query[lane])
            at = int(first[np.searchsorted(first, q, side="right") - 1]) + (int(to[lane]) - int(base[np.searchsorted(first, q, side="right") - 1])) * 64
            while h:
                low = h & -h
                m = at + low.bit_length() - 1
                x, y = _root(parent, q), _root(parent, m)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((q, m))
                h ^= low
    return np.array(found, np.int64).reshape(-1, 2)


def _root(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = int(parent[x])
    return x


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) between fingerprints that connect the same as all links do."""
    masks = block_masks(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])).alias("k")
    ).select("fp", "k.t", "k.key")
    size = stage(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    pieces = F.ceil(F.col("n") / BUCKET).cast("int")
    piece = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    other = F.sequence(F.lit(0), F.col("pieces") - 1)
    rows = (keyed.join(size, ["t", "key"]).withColumn("pieces", pieces).withColumn("piece", piece)
            .withColumn("other", F.explode(other))
            .select("t", "key", "fp", F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j"),
                    F.when(F.col("piece") == F.col("other"), F.lit(2))
                    .when(F.col("piece") < F.col("other"), F.lit(0)).otherwise(F.lit(1)).alias("side")))
    order = ["t", "key", "i", "j"]
    dealt = rows.repartition(*order).sortWithinPartitions(*order)
    flush = LANES * 4

    def compare(batches):
        kept, n = [], 0

        def run(table):
            t = table.column("t").to_numpy()
            cols = [table.column(c).to_numpy() for c in order]
            new = np.zeros(len(t), bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            group = np.cumsum(new)
            fps = np.ascontiguousarray(table.column("fp").to_numpy()).view(np.uint64)
            side = table.column("side").to_numpy()
            for i in np.unique(t):
                at = np.flatnonzero(t == i)
                pairs = bucket_links(fps[at], group[at], side[at], masks[i], radius)
                own = fps[at].view(np.int64)
                if len(pairs):
                    yield pa.RecordBatch.from_arrays([pa.array(own[pairs[:, 0]]), pa.array(own[pairs[:, 1]])], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch)
            n += batch.num_rows
            if n >= flush:  # hand over all but the last group, which may go on
                table = pa.Table.from_batches(kept)
                cols = [table.column(c).to_numpy() for c in order]
                last = np.ones(n, bool)
                for c in cols:
                    last &= c == c[-1]
                cut = int(np.argmax(last))
                yield from run(table.slice(0, cut))
                kept, n = table.slice(cut).combine_chunks().to_batches(), n - cut
        if n:
            yield from run(pa.Table.from_batches(kept))

    return dealt.mapInArrow(compare, "u long, v long")


def _decided(docs: DataFrame, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Staged (doc_id, fp) of every row, and (fp, root, component_id) of every fingerprint."""
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct, radius))
    rooted = stage(distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    least = stage(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    decisions = stage(rooted.join(least, "root").select("fp", "root", "component_id"), "decisions")
    drop_stages(distinct, rooted, least)
    return rows, decisions


def near_groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): one row per document."""
    rows, decisions = _decided(docs, shingle, radius)
    return rows.join(decisions, "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs`` of each group: that with the smallest doc_id.

    Rows that a doc_id doesn't tell apart (null or repeated ids) are looked at again by fingerprint: of
    several with the group's smallest doc_id, or of a group without any, the one whose text has the
    smallest hash stays.
    """
    rows, decisions = _decided(docs, shingle, radius)
    shared = stage(rows.groupBy("doc_id").count().filter("doc_id is null or count > 1").select(F.col("doc_id").alias("__shared")), "shared-ids")
    keep = rows.join(decisions, "fp").filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("__keep"))
    keep = keep.join(shared, F.col("__keep") == F.col("__shared"), "left_anti")
    out = docs.join(keep, docs["doc_id"] == keep["__keep"], "left_semi")
    if shared.limit(1).count() == 0:
        return out
    again = docs.join(shared, docs["doc_id"].eqNullSafe(shared["__shared"]), "left_semi")
    plain = again.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    marked = map_slices(plain, lambda _, texts: [_prints(as_bytes(texts), shingle)], StructType().add("fp", "long"))
    chosen = marked.join(decisions, "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min_by("row", F.xxhash64("text")).alias("row")).select("row.*")
    return out.unionByName(chosen)
