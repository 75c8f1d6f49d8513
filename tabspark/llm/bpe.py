"""Byte-level BPE encoding and decoding with a two-tier lookup.

Pre-tokens (matches of the pattern) that are whole vocabulary entries are found
through a minimal perfect hash over the vocabulary and checked byte for byte.
The others are merged pair by pair: a heap holds the ranks of adjacent pairs of
a doubly linked list of bytes, the lowest rank and then the leftmost pair first.
A worker encodes a distinct pre-token once while it stays in its memo of two
generations of about ``MEMO`` entries each; the older one is dropped when the
younger is full, which changes no result.

Scale: rows stay where they were read, nothing is shuffled, and texts are taken
in slices of bounded size.  The vocabulary (a file of the user's choice, tens of
thousands of entries) is broadcast once.

Defined results: a null or empty text has no ids and decodes to an empty
text; no special tokens are added or recognised.  Rows are treated one by one,
so repeated rows get equal results; other columns stay, and an empty table gives
an empty result.  Ids outside the vocabulary raise an error on decoding.
"""

from __future__ import annotations

import array
import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import mph
from .arrow import map_slices

MEMO = 400_000
SLICE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a line has a token in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _words(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = b"".join([hashlib.blake2b(t, digest_size=16).digest() for t in tokens])
    both = np.frombuffer(raw, np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


class Codec:
    """Encoder and decoder for a table of mergeable ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.pattern = pattern
        tokens = list(ranks)
        first, second = _words(tokens)
        self.seeds = mph.build(first, second)
        at = mph.lookup(first, second, self.seeds, len(tokens))
        self.slots: list = [None] * len(tokens)
        for t, s in zip(tokens, at.tolist()):
            self.slots[s] = (t, np.uint32(ranks[t]).tobytes())
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.width = max(ranks.values()) + 1
        # rank of each pair of tokens that make a token
        self.pairs = {ranks[t[:i]] * self.width + ranks[t[i:]]: r for t, r in ranks.items()
                      for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.find = None

    def __getstate__(self):
        return self.__dict__ | {"find": None, "memo": {}, "older": {}}

    def merge(self, token: bytes) -> bytes:
        """Ids (little-endian uint32) of a pre-token, by a heap over its linked bytes."""
        ids = [self.single[b] for b in token]
        n, width, pairs = len(ids), self.width, self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [rank << 32 | i for i in range(n - 1) if (rank := pairs.get(ids[i] * width + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            i, rank = top & 0xFFFFFFFF, top >> 32
            j = after[i]
            if j >= n or ids[i] < 0 or pairs.get(ids[i] * width + ids[j]) != rank:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := pairs.get(rank * width + ids[k])) is not None:
                    heapq.heappush(heap, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := pairs.get(ids[h] * width + rank)) is not None:
                heapq.heappush(heap, r << 32 | h)
        return array.array("I", [x for x in ids if x >= 0]).tobytes()

    def learn(self, tokens: list[str]) -> None:
        """Put distinct pre-tokens into the memo: whole entries by the hash, the rest by merging."""
        if not tokens:
            return
        raw = [t.encode() for t in tokens]
        at = mph.lookup(*_words(raw), self.seeds, len(self.slots)).tolist()
        for t, b, s in zip(tokens, raw, at):
            entry, ids = self.slots[s]
            self.memo[t] = ids if entry == b else self.merge(b)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as little-endian uint32."""
        if self.find is None:
            self.find = regex.compile(self.pattern).findall
        cut = [self.find(t) if t else [] for t in texts]
        distinct = set().union(*cut)
        if len(self.memo) > MEMO:
            self.older, self.memo = self.memo, {}
        if new := [t for t in distinct if t not in self.memo]:
            self.memo.update((t, self.older[t]) for t in new if t in self.older)
            self.learn([t for t in new if t not in self.older])
        get = self.memo.__getitem__
        return [b"".join(map(get, tokens)) for tokens in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, vocabulary: str, pattern: str, verify: bool = False) -> DataFrame:
    """``docs`` plus n_tokens and ids (binary: little-endian uint32), from the text column.

    With ``verify`` the ids are decoded in the same pass: round_trip says whether they give the text.
    """
    spark = docs.sparkSession
    codec = spark.sparkContext.broadcast(Codec(read_ranks(vocabulary), pattern))
    added = StructType().add("n_tokens", "long").add("ids", "binary")
    if verify:
        added = added.add("round_trip", "boolean")

    def run(part, column):
        texts = column.to_pylist()
        ids = codec.value.encode(texts)
        out = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
        if verify:
            out.append(pa.array([codec.value.decode(x) == (t or "").encode() for x, t in zip(ids, texts)], pa.bool_()))
        return out

    return map_slices(docs, run, added, SLICE)


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``encoded`` plus decoded: the bytes that its ids stand for."""
    codec = encoded.sparkSession.sparkContext.broadcast(Codec(read_ranks(vocabulary), pattern))
    keep = [c for c in encoded.columns if c != "decoded"]
    rows = encoded.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])
    at = keep.index("ids")
    schema = StructType(list(rows.schema.fields)).add("decoded", "binary")

    def run(batches):
        for part in batches:
            for i in range(0, part.num_rows, 256):
                few = part.slice(i, 256)
                raw = [codec.value.decode(x) if x else b"" for x in few.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*few.columns, pa.array(raw, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema).toDF(*keep, "decoded")
