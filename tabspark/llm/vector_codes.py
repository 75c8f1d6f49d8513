"""Vector code compression: product codebooks by member-resident Lloyd rounds.

A vector's components become integers floor(scale * x) and are cut into equal
consecutive parts.  Each part position has a codebook; a Lloyd round assigns
every part to its position's nearest entry and moves each entry to the floor of
its members' mean.

Members live with their owners: parts are partitioned by (position, entry,
salt), the salt a hash of the row, and stay in that task's persisted block.  An
owner sums its resident members, the codebooks (positions x entries vectors)
are gathered, and every owner assigns its residents anew.  Only parts whose
entry changes travel in the next shuffle; each block is then what stayed plus
what arrived, joined partition by partition without moving the rest.  After the
last round residents are assigned in place and only (row, entry, distance)
leaves the owners.

Scale: rows are salted into ceil(rows / ``MEMBERS``) owners per entry, so an
entry that holds every row is many blocks, and a block holds about ``MEMBERS``
parts.  The driver sees sums of positions x entries vectors and the first rows.
Blocks are recomputed from the staged input and shuffle files when an executor
is lost: rounds are few, and a part's place depends on nothing but its data.

Defined results: a row whose vector is null or holds a null or non-finite
component gives no row.  Vectors of one length share codebooks; another length
has its own, begun from its own first rows (one small job per length).  Where
the length is no multiple of the number of parts, part i ends at component
floor(length * (i + 1) / parts); an empty vector has code 00... and error 0.
The first rows are the smallest vec_id (null last), ties by components; fewer
rows than entries give a shorter codebook.  Ties in distance go to the lower
entry.  Integers are held to +-2^30 / sqrt(length), so that errors fit a long.
Repeated rows get equal results.  Only vec_id, embedding and label are read, so
other columns can't clash; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_stages, stage
from .mph import mix

MEMBERS = 1 << 16
SLICE = 1 << 12  # rows of one matrix product
FLUSH = 1 << 21  # parts gathered in a task before they are handed to the shuffle

Codebooks = dict  # length -> list over positions of int64 arrays (entries, width)


def integer_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """(rid, vec_id, label, d, x): kept rows with integer components; rid is unique once written."""
    v = F.col("embedding").cast("array<double>")
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # the length is read off the column itself: inside the lambda a cast would be made anew for every component
    d = F.size("embedding")
    bound = F.floor(F.lit(float(1 << 30)) / F.sqrt(F.greatest(d, F.lit(1))))
    kept = rows.filter(fine).select("vec_id", "label", "embedding", d.alias("d"), bound.alias("bound"))
    x = F.transform(v, lambda c: F.greatest(F.least(F.floor(c * float(scale)), F.col("bound")), -F.col("bound")))
    return kept.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "d", x.alias("x"))


def cuts(d: int, parts: int) -> list[tuple[int, int]]:
    """First and end component of every part of a vector of d components."""
    return [(d * i // parts, d * (i + 1) // parts) for i in range(parts)]


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry (lowest of the nearest) and squared distance of every row of x, exact.

    Integers whose squared distances stay below 2^52 are exact in doubles however they are added, so distances
    come from matrix products of slices; larger ones are summed as integers."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(book).max(initial=0)))
    entry, least = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    if x.shape[1] * (2 * top) ** 2 < 1 << 52:
        b = book.astype(np.float64)
        own = (b * b).sum(axis=1)
        for at in range(0, len(x), SLICE):
            v = x[at:at + SLICE].astype(np.float64)
            far = v @ (-2.0 * b.T) + own  # less the row's own square, alike for all entries
            entry[at:at + SLICE] = low = far.argmin(axis=1)
            least[at:at + SLICE] = far[np.arange(len(v)), low] + np.einsum("ij,ij->i", v, v)
        return entry, least
    least = ((x - book[0]) ** 2).sum(axis=1)
    for e in range(1, len(book)):
        far = ((x - book[e]) ** 2).sum(axis=1)
        closer = far < least
        entry[closer] = e
        least[closer] = far[closer]
    return entry, least


def first_codebooks(items: DataFrame, parts: int, entries: int) -> tuple[Codebooks, int]:
    """The first rows' parts as entries, by vector length, and the number of rows."""
    sizes = {r["d"]: r["count"] for r in items.groupBy("d").count().collect()}
    books = {}
    for d in sorted(sizes):
        first = items.filter(F.col("d") == d).orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(entries).collect()
        whole = np.array([r["x"] for r in first], np.int64).reshape(len(first), d)
        books[d] = [whole[:, a:b].copy() for a, b in cuts(d, parts)]
    return books, sum(sizes.values())


def _matrix(column: pa.Array, rows: np.ndarray, d: int) -> np.ndarray:
    """The lists at ``rows``, all of d elements, as a matrix."""
    return column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(rows), d)


class Owners:
    """Who owns a part: the block of its (length, position, entry, salt)."""

    def __init__(self, lengths: list[int], parts: int, entries: int, salts: int):
        self.index = {d: i for i, d in enumerate(lengths)}
        self.parts, self.entries, self.salts = parts, entries, salts

    def of(self, d: int, p: int, entry: np.ndarray, rid: np.ndarray) -> np.ndarray:
        salt = (mix(rid.astype(np.uint64)) % np.uint64(self.salts)).astype(np.int64)
        return ((self.index[d] * self.parts + p) * self.entries + entry) * self.salts + salt

    def handed(self, d: int, p: int, entry: np.ndarray, rid: np.ndarray, x: np.ndarray):
        """(owner, ((d, p, entry), rids, parts)) for every owner among the parts."""
        owner = self.of(d, p, entry, rid)
        order = np.argsort(owner, kind="stable")
        owner, entry, rid, x = owner[order], entry[order], rid[order], x[order]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else []
        for a, b in zip(starts, [*starts[1:], len(owner)]):
            yield int(owner[a]), ((d, p, int(entry[a])), rid[a:b], x[a:b])


def _spread(owner: int) -> int:
    return owner * 0x9E3779B97F4A7C15 >> 17 & 0x7FFFFFFF


def _gather(items) -> dict:
    """One block of members by (d, p, entry)."""
    found: dict = {}
    for key, rid, x in items:
        found.setdefault(key, []).append((rid, x))
    return {key: (np.concatenate([r for r, _ in some]), np.concatenate([x for _, x in some])) for key, some in found.items()}


def _joined(both) -> dict:
    stayed, arrived = both
    return _gather((key, *members) for block in (stayed, arrived) for key, members in block.items())


def _seed(items: DataFrame, books, owners: Owners, parts: int):
    """(owner, members) of all parts, each task's parts grouped in memory up to ``FLUSH`` of them."""
    def scan(rows):
        held: dict = {}
        n = 0
        for batch in rows:
            for d, p, entry, rid, x in _assigned(batch, books.value, parts):
                held.setdefault((d, p), []).append((entry, rid, x))
                n += len(rid)
            if n >= FLUSH:
                yield from _emit(held, owners)
                held, n = {}, 0
        yield from _emit(held, owners)
    return scan


def _assigned(batch: pa.RecordBatch, books: Codebooks, parts: int):
    rid, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    length = np.asarray(batch.column(2).to_numpy(zero_copy_only=False))
    for d in np.unique(length).tolist():
        at = np.flatnonzero(length == d)
        whole = _matrix(lists, at, d)
        for p, (a, b) in enumerate(cuts(d, parts)):
            x = whole[:, a:b]
            yield d, p, nearest(x, books[d][p])[0], rid[at], x


def _emit(held: dict, owners: Owners):
    for (d, p), some in held.items():
        yield from owners.handed(d, p, *[np.concatenate([s[i] for s in some]) for i in range(3)])


def _updated(books: Codebooks, sums: dict) -> Codebooks:
    new = {d: [b.copy() for b in book] for d, book in books.items()}
    for (d, p, e), (total, n) in sums.items():
        new[d][p][e] = total // n
    return new


def lloyd(items: DataFrame, parts: int, entries: int, rounds: int):
    """Final codebooks and a table (rid, p, entry, distance) of every part, from staged integer vectors."""
    spark = items.sparkSession
    sc = spark.sparkContext
    books, n = first_codebooks(items, parts, entries)
    if n == 0:
        return books, None
    owners = Owners(sorted(books), parts, entries, -(-n // MEMBERS))
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * parts // MEMBERS))
    now = sc.broadcast(books)

    scan = _seed(items, now, owners, parts)
    # Arrow carries rows to Python; the grouped members go on as one binary value each
    def packed(batches):
        import pickle
        for owner, members in scan(batches):
            yield pa.RecordBatch.from_arrays([pa.array([owner], pa.int64()), pa.array([pickle.dumps(members, 5)], pa.binary())], names=["owner", "members"])

    def unpacked(row):
        import pickle
        return row[0], pickle.loads(row[1])

    def arrivals(moving):
        return moving.partitionBy(blocks, _spread).mapPartitions(lambda it: [_gather(m for _, m in it)])

    def sums(block):
        return [(key, (x.sum(axis=0), len(x))) for key, (_, x) in block.items() if len(x)]

    def totals(resident):
        return resident.flatMap(sums).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), min(blocks, 64)).collectAsMap()

    def step(resident, now):
        def assign(block):
            for (d, p, e), (rid, x) in block.items():
                yield (d, p, e), rid, x, nearest(x, now.value[d][p])[0]

        def stay(block):
            return {key: (rid[to == key[2]], x[to == key[2]]) for key, rid, x, to in assign(block)}

        def move(block):
            for (d, p, e), rid, x, to in assign(block):
                go = to != e
                yield from owners.handed(d, p, to[go], rid[go], x[go])

        return resident.map(stay).zip(arrivals(resident.flatMap(move))).map(_joined)

    seeded = items.select("rid", "x", "d").mapInArrow(packed, "owner long, members binary").rdd.map(unpacked)
    resident = arrivals(seeded).persist(StorageLevel.MEMORY_AND_DISK)
    books = _updated(books, totals(resident))
    for _ in range(rounds - 1):
        now = sc.broadcast(books)
        before, resident = resident, step(resident, now).persist(StorageLevel.MEMORY_AND_DISK)
        books = _updated(books, totals(resident))
        before.unpersist()
    now = sc.broadcast(books)

    def final(block):
        for (d, p, _), (rid, x) in block.items():
            if len(rid):
                entry, far = nearest(x, now.value[d][p])
                yield p, bytearray(entry.astype(np.int32).tobytes()), bytearray(rid.astype(np.int64).tobytes()), bytearray(far.tobytes())

    def rows(batches):
        for batch in batches:
            for p, entry, rid, far in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                entry, rid, far = np.frombuffer(entry, np.int32), np.frombuffer(rid, np.int64), np.frombuffer(far, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(rid), pa.array(np.full(len(rid), p, np.int32)), pa.array(entry), pa.array(far)],
                                                 names=["rid", "p", "entry", "distance"])

    packs = spark.createDataFrame(resident.flatMap(final), "p int, entry binary, rid binary, far binary", verifySchema=False)
    return books, packs.mapInArrow(rows, "rid long, p int, entry int, distance long")


def codebooks_sha256(book: list[np.ndarray]) -> str:
    """Digest of the decimal components by part, entry and position within the part."""
    return hashlib.sha256(",".join(str(c) for part in book for entry in part.tolist() for c in entry).encode()).hexdigest()


def vector_codes(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row with a finite vector."""
    if not (0 < entries <= 256 and parts > 0 and rounds > 0):
        raise ValueError("1 to 256 entries, one part and one round at least")
    items = stage(integer_vectors(rows, scale), "vectors")
    books, placed = lloyd(items, parts, entries, rounds)
    if placed is None:
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))]
        return items.select("vec_id", *nothing)
    digits = F.transform(F.array_sort(F.collect_list(F.struct("p", "entry"))), lambda s: F.lower(F.lpad(F.hex(s["entry"].cast("long")), 2, "0")))
    whole = stage(placed.groupBy("rid").agg(F.array_join(digits, "").alias("code"), F.sum("distance").alias("error")), "codes")
    digest = F.create_map(*[F.lit(v) for d, book in books.items() for v in (d, codebooks_sha256(book))])
    coded = stage(items.select("rid", "vec_id", "label", "d").join(whole, "rid").select(
        "vec_id", "label", "code", "error", F.element_at(digest, F.col("d")).alias("codebooks_sha256")), "coded")
    drop_stages(items, whole)
    by_label = coded.groupBy(F.col("label").alias("same_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("same_label"))).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")
