"""Token ids as length-delimited binary records with a separate offset index.

A shard is two files.  The record file frames every sequence as

    length (uint64) | masked CRC-32 of the length (uint32) | payload | masked CRC-32 of the payload (uint32)

all little-endian; a masked checksum is the CRC-32 rotated right by 15 bits plus
0xa282ead8, so that a checksum stored in data that is checksummed again is no
fixed point.  The payload is a flag byte (1: has a document id, 2: ids of four
bytes in place of two), the document id (int64) and the ids as one Zstandard frame.  The index file has
one entry of three uint64 per record: byte offset, payload length, and the ids of
the shard before it, so a reader may fetch any record in any order.

Documents lie in ascending doc_id order over the shards.  Every attempt at a
task writes files of its own name; the manifest, a written table, names those of
the attempts that counted, so a lost or repeated task leaves no second copy.
Reading takes the manifest's shards, a few megabytes of records at a time, and
checks every frame against both checksums and the index.

Texts are encoded by the tokenizers library.  The pattern that splits text ahead
of the merges never joins across the start of white space, nor (where its own
splitter says so) a letter or digit with the punctuation behind it, so a text is
cut there, each distinct piece is encoded by the library once while it stays in a
memo of two generations of ``MEMO`` pieces, and the ids are joined.  Arrow cuts a slice of texts, numbers its
distinct pieces and gathers their ids; only distinct pieces are Python strings.

Scale: texts are encoded where they are read and only ids are sorted, by range
partitions of (doc_id, hash of ids, row), so a repeated doc_id is no hot key.  A
shard's records are written one by one.  The manifest has a row per shard, from
which the ids before each shard are summed.

Defined results: a null or empty text has the end id alone.  Null doc_ids come
first; rows of one doc_id stand in the order of a hash of their ids.  Strings of special
tokens in a text are ordinary text.  An empty table gives no rows.  Columns are
read by name, so extra ones can't clash.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rank import target_partitions
from ..session import checkpoint_dir, drop_stages, stage
from .arrow import file_system, map_slices

MEMO = 500_000
LONGEST = 64  # characters of a piece that is kept in the memo
TOGETHER = 256  # pieces in a joined text
CALL = 64  # joined texts in a call of the library
SLICE = 8 << 20
READ = 4 << 20
LENGTH, CHECK, HEAD, ENTRY = "<Q", "<I", "<Bq", "<QQQ"  # layouts of struct
HEAD_BYTES = 9
# a piece begins at white space behind other characters; what only some engines call white space begins none
PIECES = re.compile(r"\s*\S+(?:[^\S \t\n\r]+\S*)*|\s+")
# white space as in PIECES; a slice of texts without a space before it or the end is cut at every space
WHITE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD = rf" (?:[{WHITE}]|\z)"
RUNS = rf"([^{WHITE}])( )"  # another slice at every space behind other characters
# and where ASCII punctuation (no apostrophe) or a line's end follows what any engine calls a letter or digit
BEHIND = r"([0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{2af}\x{400}-\x{481}\x{4e00}-\x{9fa5}])([!-&(-/:-@\[-`{-~\n])"
CUT = "\x00"  # texts that have it are cut by PIECES


class Encoder:
    """Ids of texts by a tokenizers file, through memos of pieces."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.source = f.read()
        self.library = None

    def __getstate__(self):
        return {"source": self.source, "library": None}

    def start(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(self.source)
        self.library.encode_special_tokens = True
        self.width = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        # a byte-level token has a character per byte
        self.bytes_of = np.zeros(self.library.get_vocab_size(), np.int64)
        for token, i in self.library.get_vocab().items():
            self.bytes_of[i] = len(token)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.behind = self._cuts_behind()

    def _cuts_behind(self) -> bool:
        """Whether the tokenizer splits text at the places of ``BEHIND``."""
        split = self.library.pre_tokenizer
        if split is None or not all(t.special for t in self.library.get_added_tokens_decoder().values()):
            return False
        ends = [c for c in map(chr, range(128)) if re.match(r"[!-&(-/:-@\[-`{-~\n]", c)]
        return all(split.pre_tokenize_str(f"{a}{a}{c}{a}")[0][1][1] == 2 for a in "a7\u00e9\u0436\u4e2d" for c in ends)

    def _each(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.width).tobytes() for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]

    def _joined(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of one space and what follows: joined texts are encoded and their ids cut at the pieces' ends."""
        out = []
        for i in range(0, len(pieces), CALL * TOGETHER):
            own = pieces[i:i + CALL * TOGETHER]
            texts = ["".join(own[k:k + TOGETHER]) for k in range(0, len(own), TOGETHER)]
            ids = np.concatenate([np.array(e.ids, self.width) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)])
            ends, want = np.cumsum(self.bytes_of[ids]), np.cumsum(pc.binary_length(pa.array(own, pa.large_string())).to_numpy())
            at = np.searchsorted(ends, want)
            if not (at < len(ends)).all() or (ends[at] != want).any():
                raise ValueError("the tokenizer joins tokens across the start of white space")
            out += _cut(pa.py_buffer(ids), np.append(0, at + 1) * ids.itemsize)
        return out

    def _coded(self, pieces: list[str]) -> list[bytes]:
        spaced = [p[:1] == " " and p[1:2].strip() != "" for p in pieces]
        joined = iter(self._joined([*compress(pieces, spaced)]))
        each = iter(self._each([p for p, s in zip(pieces, spaced) if not s]))
        return [next(joined if s else each) for s in spaced]

    def _known(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, from the memo where it has them."""
        if len(self.memo) > MEMO:
            self.memo, self.older = {}, self.memo
        found = [*map(self.memo.get, pieces)]
        new = [p for p, ids in zip(pieces, found) if ids is None]
        if not new:
            return found
        ids = [*map(self.older.get, new)]
        missing = iter(self._coded([p for p, x in zip(new, ids) if x is None]))
        ids = [next(missing) if x is None else x for x in ids]
        self.memo.update(zip(new, ids))
        for p in [p for p in new if len(p) > LONGEST]:  # for these texts alone
            del self.memo[p]
        rest = iter(ids)
        return [next(rest) if x is None else x for x in found]

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of each text, each of ``width``."""
        if self.library is None:
            self.start()
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        odd = pc.match_substring(texts, CUT).fill_null(False)
        cut = [PIECES.findall(t) for t in texts.filter(odd).to_pylist()]
        pieces = [*set().union(*cut)]
        ids = dict(zip(pieces, self._known(pieces)))
        own = iter([b"".join(map(ids.__getitem__, c)) for c in cut])
        others = iter(self._marked(texts.filter(pc.invert(odd))))
        return [next(own if o else others) for o in odd.to_pylist()]

    def _marked(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts cut at marks: their distinct pieces are looked up and the ids gathered by number."""
        if pc.any(pc.match_substring_regex(texts, ODD)).as_py():
            marked = pc.replace_substring_regex(texts, RUNS, rf"\1{CUT}\2")
        else:
            marked = pc.replace_substring(texts, " ", f"{CUT} ")
        if self.behind:
            marked = pc.replace_substring_regex(marked, BEHIND, rf"\1{CUT}\2")
        parts = pc.split_pattern(marked, CUT)
        ends = np.append(0, np.cumsum(parts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)))
        pieces = parts.flatten().dictionary_encode()
        ids = pa.array(self._known(pieces.dictionary.to_pylist()), pa.large_binary())
        _, at, data = ids.take(pieces.indices).buffers()
        return _cut(data, np.frombuffer(at, np.int64)[ends] if ends[-1] else ends)


def _cut(data: pa.Buffer | None, at: np.ndarray) -> list[bytes]:
    """The data between every two of the places."""
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), data or pa.py_buffer(b"")]).to_pylist()


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """The payload between its length and its checksum."""
    length = struct.pack(LENGTH, len(payload))
    return b"".join([length, struct.pack(CHECK, masked(length)), payload, struct.pack(CHECK, masked(payload))])


def unframe(data: memoryview | bytes, at: int) -> tuple[bytes, int]:
    """The payload framed at ``at`` and where the next frame begins; a wrong checksum raises an error."""
    length = bytes(data[at:at + 8])
    if len(length) < 8 or struct.unpack_from(CHECK, data, at + 8)[0] != masked(length):
        raise ValueError("the checksum of a record's length is wrong")
    end = at + 12 + struct.unpack(LENGTH, length)[0]
    payload = bytes(data[at + 12:end])
    if end + 4 > len(data) or struct.unpack_from(CHECK, data, end)[0] != masked(payload):
        raise ValueError("the checksum of a record is wrong")
    return payload, end + 4


def _expander():
    import zstandard

    return zstandard.ZstdDecompressor().decompress


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """Payload of compressed ids of ``width`` bytes each."""
    return struct.pack(HEAD, (doc_id is not None) | (width == 4) << 1, doc_id or 0) + ids


def unpack(payload: bytes, expand=None) -> tuple[int | None, np.ndarray]:
    """Document id and ids (uint32) of a payload; ``expand`` decompresses where a caller has many."""
    flags, doc_id = struct.unpack_from(HEAD, payload)
    ids = (expand or _expander())(payload[HEAD_BYTES:])
    return doc_id if flags & 1 else None, np.frombuffer(ids, "<u4" if flags & 2 else "<u2").astype("<u4")


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(rid, doc_id, width, n, ids) of every document: n ids, the end id last, compressed; rid is unique once written."""
    coder = docs.sparkSession.sparkContext.broadcast(Encoder(tokenizer))
    from pyspark.sql.types import StructType

    def run(part, column):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        raw = coder.value.encode(column)
        width = coder.value.width
        end = np.array([end_id], width).tobytes()
        size = np.dtype(width).itemsize
        return [pa.array([size] * len(raw), pa.int32()), pa.array([len(r) // size + 1 for r in raw], pa.int64()),
                pa.array([squeeze(r + end) for r in raw], pa.binary())]

    rows = map_slices(docs.select("doc_id", "text"), run, StructType().add("width", "integer").add("n", "long").add("ids", "binary"), SLICE)
    return rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "width", "n", "ids")


def write_records(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shards below ``folder``; returns the manifest.

    The manifest has shard, records_file, index_file, records, tokens, bytes and before (ids in the
    shards before it).
    """
    spark = docs.sparkSession
    folder = (folder or f"{checkpoint_dir(spark).rstrip('/')}/records-{uuid.uuid4().hex}").rstrip("/")
    rows = stage(encoded(docs, tokenizer, end_id), "token-ids")
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), F.col("rid")]
    ordered = rows.repartitionByRange(target_partitions(rows), *keys).sortWithinPartitions(*keys).select(
        F.spark_partition_id().alias("shard"), "doc_id", "width", "n", "ids")

    def write(batches):
        out = None
        for batch in batches:
            shard, doc_id, width, n, ids = [c.to_pylist() for c in batch.columns]
            if not shard:
                continue
            if out is None:
                name = f"{folder}/shard-{shard[0]:06d}-{uuid.uuid4().hex}"
                system, path = file_system(name)
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                out, index = system.open_output_stream(path + ".rec"), system.open_output_stream(path + ".idx")
                records = tokens = at = 0
            for d, w, many, raw in zip(doc_id, width, n, ids):
                framed = frame(pack(d, raw, w))
                out.write(framed)
                index.write(struct.pack(ENTRY, at, len(framed) - 16, tokens))
                records, tokens, at = records + 1, tokens + many, at + len(framed)
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard[0]], pa.int32()), pa.array([name + ".rec"]), pa.array([name + ".idx"]),
                 *[pa.array([n], pa.int64()) for n in (records, tokens, at)]],
                names=["shard", "records_file", "index_file", "records", "tokens", "bytes"])

    written = stage(ordered.mapInArrow(write, "shard int, records_file string, index_file string, records long, tokens long, bytes long"), "shards")
    drop_stages(rows)
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    return stage(written.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))), "manifest")


def _entries(index_file: str) -> np.ndarray:
    """Offset, payload length and ids before of every record of a shard."""
    system, path = file_system(index_file)
    with system.open_input_stream(path) as f:
        return np.frombuffer(f.read(), "<u8").reshape(-1, 3).astype(np.int64)


def _read(records_file: str, entries: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """(payload, ids before) of records that lie one after the other, about ``READ`` bytes at a time."""
    system, path = file_system(records_file)
    with system.open_input_file(path) as f:
        i = 0
        while i < len(entries):
            begin = int(entries[i, 0])
            j = max(i + 1, int(np.searchsorted(entries[:, 0], begin + READ)))
            last = entries[j - 1]
            data, at = memoryview(f.read_at(int(last[0] + last[1]) + 16 - begin, begin)), 0
            for offset, length, before in entries[i:j].tolist():
                if at != offset - begin:
                    raise ValueError("the index doesn't fit the records")
                payload, at = unframe(data, at)
                if len(payload) != length:
                    raise ValueError("the index doesn't fit the records")
                yield payload, before
            i = j


ROWS = "doc_id long, start long, ids binary"


def _batches(rows: Iterator[tuple], limit: int = READ) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= limit or len(held) >= 10_000:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(held: list[tuple]) -> pa.RecordBatch:
    d, s, i = zip(*held)
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(s, pa.int64()), pa.array(i, pa.binary())], names=["doc_id", "start", "ids"])


def read_records(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of all records in file order; ids as little-endian uint32, start from the index."""
    tasks = manifest.select("shard", "records_file", "index_file", "before").repartition(
        max(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), manifest.count()), "shard")

    def run(batches):
        expand = _expander()
        for batch in batches:
            for _, records, index, before in zip(*[c.to_pylist() for c in batch.columns]):
                yield from _batches((doc_id, before + earlier, ids.tobytes()) for (doc_id, ids), earlier in (
                    (unpack(payload, expand), earlier) for payload, earlier in _read(records, _entries(index))))

    return tasks.mapInArrow(run, ROWS)


def shuffled_records(manifest: DataFrame, seed: int, epoch: int = 0) -> DataFrame:
    """(doc_id, start, ids) of every record once, dealt over tasks and ordered in them by a hash of seed, epoch and place.

    Only index entries are shuffled; each task then fetches its records by offset.
    """
    def entries(batches):
        for batch in batches:
            for records, index, before in zip(*[c.to_pylist() for c in batch.columns]):
                e = _entries(index)
                for i in range(0, len(e), 10_000):
                    some = e[i:i + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([records] * len(some)), *[pa.array(some[:, k].copy()) for k in (0, 1)], pa.array(some[:, 2] + before)],
                        names=["file", "offset", "length", "start"])

    def fetch(batches):
        def rows():
            opened, expand = {}, _expander()
            for batch in batches:
                for file, offset, length, start in zip(*[c.to_pylist() for c in batch.columns]):
                    if file not in opened:
                        if len(opened) >= 64:
                            opened.pop(next(iter(opened))).close()
                        system, path = file_system(file)
                        opened[file] = system.open_input_file(path)
                    doc_id, ids = unpack(unframe(opened[file].read_at(length + 16, offset), 0)[0], expand)
                    yield doc_id, start, ids.tobytes()
        yield from _batches(rows())

    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = manifest.select("records_file", "index_file", "before").mapInArrow(entries, "file string, offset long, length long, start long")
    drawn = places.withColumn("draw", F.xxhash64(F.lit(seed), F.lit(epoch), "file", "offset"))
    return drawn.repartition(parts, "draw").sortWithinPartitions("draw").drop("draw").mapInArrow(fetch, ROWS)
