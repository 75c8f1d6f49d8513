"""Exact dedup against a history kept as sharded minimal perfect hashes.

The store is a table with one row per shard: the displacements of a minimal
perfect hash over the shard's distinct SHA-256 digests, and for every slot the
full digest, the winner's doc_id (its locator) and the group's size.  A batch is
reduced to its distinct digests, each is looked up in its shard and compared
byte for byte with the slot's digest.  Members are repeats of the history, the
others form groups of their own.

Scale: only (doc_id, digest) pairs are shuffled, never texts; digests are
aggregated before every exchange, so a text held by a third of the rows is one
digest.  A shard holds about ``SHARD_KEYS`` digests however many there are.

Defined results: a null text equals the empty text; texts are not changed
before comparing; of equal texts the largest doc_id stays.  Rows repeated under
one doc_id stand or fall together in the decision table (``exact_dedup`` keeps
one of them); a null doc_id loses to any other and, where a group has no other,
stays.  Other columns are not looked at.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from . import mph

SHARD_KEYS = 16_384

STORE = "shard long, n long, seeds binary, digests binary, winners binary, holds binary, sizes binary"


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): SHA-256 of every whole text, null as empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of(F.col("text")).alias("digest"))


def digest_of(text):
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _groups(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("size"))


def _words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit words of 32-byte digests (n x 32)."""
    w = np.ascontiguousarray(raw).view(np.uint64).reshape(len(raw), 4)
    return w[:, 1], w[:, 2]


def _raw(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), 32)


def build_shard(shard: int, digest: pd.Series, winner: pd.Series, size: pd.Series) -> dict:
    """One store row from a shard's distinct digests."""
    raw = _raw(digest)
    n = len(raw)
    first, second = _words(raw)
    seeds = mph.build(first, second)
    at = np.argsort(mph.lookup(first, second, seeds, n))
    held = winner.notna().to_numpy()
    return {"shard": shard, "n": n, "seeds": seeds.tobytes(), "digests": raw[at].tobytes(),
            "winners": winner.fillna(0).to_numpy(np.int64)[at].tobytes(), "holds": held[at].tobytes(),
            "sizes": size.to_numpy(np.int64)[at].tobytes()}


def _shard(n_shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(n_shards)).alias("shard")


def build_store(groups: DataFrame, n_shards: int) -> DataFrame:
    """Store of distinct historical digests (digest, winner, size)."""
    def build(key, frame):
        return pd.DataFrame([build_shard(int(key[0]), frame["digest"], frame["winner"], frame["size"])])

    return groups.select(_shard(n_shards), "digest", "winner", "size").groupBy("shard").applyInPandas(build, STORE)


def look_up(store: DataFrame, groups: DataFrame, n_shards: int) -> DataFrame:
    """Decision per digest of store and batch: (digest, keep_id, group_size, repeat).

    Members update their slot (larger locator, added size); a nonmember keeps
    its own group.  Every slot of the store appears once in the result.
    """
    def probe(slots, batch):
        parts = []
        raw = _raw(batch["digest"]) if len(batch) else np.zeros((0, 32), np.uint8)
        wins = batch["winner"].astype("Int64") if len(batch) else pd.Series([], dtype="Int64")
        member = np.zeros(len(batch), bool)
        if len(slots):
            row = slots.iloc[0]
            n = int(row["n"])
            own = np.frombuffer(row["digests"], np.uint8).reshape(n, 32)
            winners = np.frombuffer(row["winners"], np.int64).copy()
            holds = np.frombuffer(row["holds"], bool).copy()
            sizes = np.frombuffer(row["sizes"], np.int64).copy()
            hits = np.zeros(n, bool)
            if len(batch):
                at = mph.lookup(*_words(raw), np.frombuffer(row["seeds"], np.int64), n)
                member = (own[at] == raw).all(axis=1)
                slot = at[member]
                has = wins.notna().to_numpy()[member]
                new = wins.fillna(0).to_numpy(np.int64)[member]
                better = has & (~holds[slot] | (new > winners[slot]))
                winners[slot[better]] = new[better]
                holds[slot[has]] = True
                sizes[slot] += batch["size"].to_numpy(np.int64)[member]
                hits[slot] = True
            parts.append(pd.DataFrame({
                "digest": [x.tobytes() for x in own], "keep_id": pd.array(np.where(holds, winners, 0), "Int64"),
                "group_size": sizes, "repeat": hits}))
            parts[0].loc[~holds, "keep_id"] = pd.NA
        if not member.all():
            rest = ~member
            parts.append(pd.DataFrame({"digest": batch["digest"][rest].tolist(), "keep_id": wins[rest].to_list(),
                                       "group_size": batch["size"][rest].to_numpy(np.int64), "repeat": False})
                         .astype({"keep_id": "Int64"}))
        return pd.concat(parts) if parts else pd.DataFrame(
            {"digest": [], "keep_id": [], "group_size": [], "repeat": []})

    probes = groups.select(_shard(n_shards), "digest", "winner", "size")
    return store.groupBy("shard").cogroup(probes.groupBy("shard")).applyInPandas(
        probe, "digest binary, keep_id long, group_size long, repeat boolean")


def decide(docs: DataFrame, historical=None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest) of all rows, and the decision per distinct digest.

    ``historical`` marks the rows whose digests make up the store; the others
    are the batch.  By default half of the ids, chosen by hash, are history.
    """
    if historical is None:
        historical = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    pairs = stage(digests(docs).withColumn("historical", F.coalesce(historical, F.lit(False))), "digests")
    old = stage(_groups(pairs.filter("historical")), "history")
    new = stage(_groups(pairs.filter("not historical")), "batch")
    n_shards = max(1, -(-max(old.count(), new.count()) // SHARD_KEYS))
    store = stage(build_store(old, n_shards), "store")
    return pairs.select("doc_id", "digest"), stage(look_up(store, new, n_shards), "decisions")


def exact_groups(docs: DataFrame, historical=None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    pairs, decisions = decide(docs, historical)
    return pairs.join(decisions.select("digest", "keep_id", "group_size"), "digest").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, historical=None) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns only."""
    _, decisions = decide(docs, historical)
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    d, i, r = "__digest", "__id", "__row"
    keep = decisions.select(F.col("digest").alias(d), text_of("keep_id").alias(i))
    rows = docs.withColumn(d, digest_of(F.col("text"))).withColumn(i, text_of("doc_id")).join(keep, [d, i], "left_semi")
    one = Window.partitionBy(d, i).orderBy(F.lit(1))
    return rows.withColumn(r, F.row_number().over(one)).filter(F.col(r) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
