"""Vector codes, the Merkle manifest and token records against plain versions, and their edge cases."""

import hashlib
import json
import random
import struct
import zlib
from itertools import groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabspark.llm import merkle, queries, token_records, vector_codes

SF = "/root/testdata/sf0.001"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
VECTORS = "vec_id long, embedding array<float>, label int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["rid", "d", "x", "g", "lo", "hi", "n", "digest", "at", "bucket", "levels", "members", "path", "leaf", "ids", "width", "shard", "label2", "a.b"]


# ---------------------------------------------------------------- vector codes

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, digest) of vectors of one length; rows are (vec_id, vector, label)."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = [[int(np.floor(4096 * np.float64(np.float32(c)))) for c in r[1]] for r in rows]
    d = len(x[0])
    cut = [(d * i // parts, d * (i + 1) // parts) for i in range(parts)]
    books = [[list(v[a:b]) for v in x[:entries]] for a, b in cut]

    def best(v, p):
        a, b = cut[p]
        return min((sum((c - e) ** 2 for c, e in zip(v[a:b], entry)), i) for i, entry in enumerate(books[p]))

    for _ in range(rounds):
        placed = [[best(v, p)[1] for p in range(parts)] for v in x]
        for p, (a, b) in enumerate(cut):
            for e in range(len(books[p])):
                if mine := [v[a:b] for v, at in zip(x, placed) if at[p] == e]:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    final = [[best(v, p) for p in range(parts)] for v in x]
    errors = [sum(far for far, _ in f) for f in final]
    total = {}
    for r, e in zip(rows, errors):
        total[r[2]] = total.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(c) for part in books for entry in part for c in entry).encode()).hexdigest()
    return [(r[0], "".join(f"{i:02x}" for _, i in f), e, total[r[2]], digest) for r, f, e in zip(rows, final, errors)]


def some_vectors(n, d, seed):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 0.2) for _ in range(d)], rng.choice([None, 1, 2])) for i in range(n)]


def order(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("top, width", [(3, 1), (4096, 8), (1 << 24, 8), ((1 << 25) - 1, 1), (1 << 25, 1), (1 << 29, 4), (0, 0)])
def test_nearest_entries_are_exact_at_every_size(top, width):
    rng = np.random.default_rng(top + width)
    x, book = rng.integers(-top, top + 1, (9000, width)), rng.integers(-top, top + 1, (16, width))
    x[:3], book[5], book[9] = top, book[2], -top
    far = ((x.astype(object)[:, None, :] - book.astype(object)[None]) ** 2).sum(axis=2) if width else np.zeros((9000, 16), object)
    entry, least = vector_codes.nearest(x, book)
    assert entry.tolist() == [row.index(min(row)) for row in far.tolist()] and least.tolist() == far.min(axis=1).tolist()
    assert [v.tolist() for v in vector_codes.nearest(x[:0], book)] == [[], []]


@pytest.mark.parametrize("n, d, members", [(120, 16, 7), (40, 19, 1000), (5, 8, 2)])
def test_codes_against_plain_rounds(spark, monkeypatch, n, d, members):
    monkeypatch.setattr(vector_codes, "MEMBERS", members)  # many salts
    rows = some_vectors(n, d, n)
    got = vector_codes.vector_codes(spark.createDataFrame(rows, VECTORS)).collect()
    assert order(got) == order(plain_codes(rows))


def test_codes_of_bad_repeated_and_clashing_rows(spark):
    good = some_vectors(30, 8, 1) + [(3, [0.5] * 8, None)] * 2 + [(None, [0.25] * 8, 1)] + [(50 + i, [0.1] * 8, 1) for i in range(40)]
    bad = [(70, None, 1), (71, [None] + [0.1] * 7, 1), (72, [float("nan")] * 8, 1), (73, [float("inf")] + [0.0] * 7, 1)]
    rows = spark.createDataFrame(good + bad, VECTORS).select("*", *[F.lit("own").alias(c) for c in EXTRA])
    assert order(vector_codes.vector_codes(rows).collect()) == order(plain_codes(good))


def test_codes_of_empty_tables_other_lengths_and_huge_components(spark):
    assert vector_codes.vector_codes(spark.createDataFrame([], VECTORS)).collect() == []
    two = some_vectors(20, 16, 2), [(100 + i, v, None) for i, v, _ in some_vectors(20, 8, 3)]
    got = vector_codes.vector_codes(spark.createDataFrame([*two[0], *two[1]], VECTORS).select("vec_id", "embedding", F.lit(1).alias("label")))
    want = [r[:3] + r[4:] for part in two for r in plain_codes(part)]
    assert order((r.vec_id, r.code, r.error, r.codebooks_sha256) for r in got.collect()) == order(want)
    odd = [(1, [], 1), (2, [3e38] * 8, 1), (3, [-3e38] * 8, 1)]
    rows = {r.vec_id: r for r in vector_codes.vector_codes(spark.createDataFrame(odd, VECTORS)).collect()}
    assert rows[1].code == "00" * 8 and rows[1].error == 0 and rows[2].code != rows[3].code


# ------------------------------------------------------------- Merkle manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])


def plain_tree(nodes, fanout):
    """Root of a list of digests and, for each, its path of (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + fanout] for i in range(0, len(nodes), fanout)]
        for leaf, i in enumerate(at):
            run, k = runs[i // fanout], i % fanout
            paths[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
        nodes, at = [sha(*run) for run in runs], [i // fanout for i in at]
    return nodes[0], paths


def plain_manifest(rows, fanout=2):
    """(doc_id, leaf, subroot, root, path) of rows in the order of FIELDS."""
    key = lambda r: (r[2] is not None, (r[2] or "").encode())
    groups = [sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r))) for _, g in groupby(sorted(rows, key=key), key=key)]
    trees = [plain_tree([plain_leaf(r) for r in g], fanout) for g in groups]
    root, above = plain_tree([t[0] for t in trees], fanout)
    return [(r[0], plain_leaf(r), sub, root, path + up) for g, (sub, paths), up in zip(groups, trees, above) for r, path in zip(g, paths)]


def made(docs, fanout=2):
    m = merkle.merkle_manifest(docs, FIELDS, "lang", "doc_id", fanout=fanout)
    return m.root, [(r.doc_id, r.leaf, r.subroot, m.root, [(s.left, s.right) for s in r.path]) for r in m.rows.collect()]


@pytest.mark.parametrize("fanout", [2, 3, 32])
def test_manifest_against_a_plain_tree(spark, fanout):
    rng = random.Random(fanout)
    sizes = {None: 1, "": 2, "a": 33, "é": 64, "b": 65, "zz": 1300}
    rows = [(i, rng.choice(["s", None, ""]), g, rng.choice([None, i]), f"text {i} é" if i % 5 else None) for i, g in enumerate(
        g for g, n in sizes.items() for _ in range(n))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    root, got = made(docs.select("*", *[F.lit("own").alias(c) for c in EXTRA]), fanout)
    assert order(got) == order(plain_manifest(rows, fanout))


def test_manifest_of_nulls_repeats_one_row_and_none(spark):
    rows = [(None, None, None, None, None)] * 3 + [(7, "s", "en", 1, "x" * 300_000)] * 4 + [(7, "s", "en", 1, ""), (None, "s", "en", 2, None)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert order(made(spark.createDataFrame(rows, schema))[1]) == order(plain_manifest(rows))
    assert order(made(spark.createDataFrame(rows[:1], schema))[1]) == order(plain_manifest(rows[:1]))
    assert made(spark.createDataFrame([], schema)) == (None, [])


def test_tampering_shows(spark):
    rows = queries.op12_merkle_manifest(spark, SF).collect()
    for r in rows:
        bad = zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        assert r.verified != bad and (r.folded_root == r.root) == r.verified
    assert len({r.root for r in rows}) == 1


# ---------------------------------------------------------------- token records

def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTE_BPE)
    t.encode_special_tokens = True
    return t


def plain_records(rows, t):
    """(doc_id, start, n_tokens, crc) of rows (doc_id, text) in file order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_records_of_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    assert order(queries.op13_token_records(spark, SF).collect()) == order(plain_records(docs, library()))


def test_pieces_encode_like_whole_texts():
    rng, t = random.Random(5), library()
    coder = token_records.Encoder(BYTE_BPE)
    alphabet = [" ", " ", "  ", "\n", "\r\n", "\t", "a", "don't", "'s", "12", "!?", "é", "中文", " ", " ", "　", "\x1c", "\x1f", "\x85",
                "​", "﻿", "\x00", "\U0001f600", "é", "<|endoftext|>", "x" * 70, "A", " b", " c", " d,", " don't", " "]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 14))) for _ in range(4000)] + ["", " ", "\n\n", "word " * 50_000, "y" * 200_000]
    for text, raw in zip(texts, coder.encode(texts)):
        assert np.frombuffer(raw, coder.width).tolist() == t.encode(text, add_special_tokens=False).ids, text[:80]


def test_memo_generations_change_nothing(monkeypatch):
    monkeypatch.setattr(token_records, "MEMO", 5)
    coder, t = token_records.Encoder(BYTE_BPE), library()
    for i in range(30):
        text = " ".join(f"w{j}" for j in range(i % 7 * 3))
        assert np.frombuffer(coder.encode([text])[0], coder.width).tolist() == t.encode(text, add_special_tokens=False).ids


def test_slices_of_texts_cut_at_punctuation_and_lines():
    rng, t = random.Random(11), library()
    alphabet = [" ", " ", " ", "a", "Zb", "7", "\u00c0", "\u00df", "\u00d7", "\u0436", "\u0483", "\u4e2d", "\u1f600", "\u2160", "\u00b2", "_", ".", ",", ");", "-", "'s", "'", "'re.",
                "\n", "\n", "\n\n", "\r\n", "\t", "  ", " \n", "\x00", "\x0b", "\x1c", "\u0085", "\u00a0", "\u2028", "\u3000", "\u200b", "\u0301", "\U0001f600"]
    texts = [None if rng.random() < 0.05 else "".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(20_000)]
    column, coder = pa.array(texts), token_records.Encoder(BYTE_BPE)
    for at, many in [(at, 700) for at in range(0, 10_000, 700)] + [(at, 3) for at in range(10_000, len(texts), 3)]:  # small ones often have no odd space
        for text, raw in zip(texts[at:at + many], coder.encode(column.slice(at, many))):
            assert np.frombuffer(raw, coder.width).tolist() == t.encode(text or "", add_special_tokens=False).ids, text
    assert coder.encode(pa.array([None, "", None], pa.string())) == [b"", b"", b""] and coder.encode([]) == []


def test_a_tokenizer_that_joins_words_and_punctuation(tmp_path):
    plan = json.loads(open(BYTE_BPE, encoding="utf-8").read())
    plan["model"]["vocab"]["a."] = max(plan["model"]["vocab"].values()) + 1
    plan["model"]["merges"].insert(0, ["a", "."] if isinstance(plan["model"]["merges"][0], list) else "a .")
    plan["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"String": " "}, "behavior": "MergedWithNext", "invert": False},
                                                                  {**plan["pre_tokenizer"], "use_regex": False}]}
    (tmp_path / "own.json").write_text(json.dumps(plan), encoding="utf-8")
    coder, t = token_records.Encoder(str(tmp_path / "own.json")), Tokenizer.from_file(str(tmp_path / "own.json"))
    text = "a. b a.a, c7. a."
    ids = t.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(coder.encode([text])[0], coder.width).tolist() == ids and plan["model"]["vocab"]["a."] in ids


def test_runs_of_spaces_are_not_encoded_alone():
    coder, t = token_records.Encoder(BYTE_BPE), library()
    coder.encode([" ".join(["x", *[f"wort{i:03d}" for i in range(600)]])])
    coder._each = lambda pieces, each=coder._each: each(pieces) if len(pieces) < 20 else pytest.fail("words encoded one by one")
    texts = [" ".join(f"neu{k}{i:03d}" for i in range(600)) + end for k, end in enumerate([" ", "   ", "  z", " \n", "\n  y"])]
    for text, raw in zip(texts, coder.encode(texts)):
        assert np.frombuffer(raw, coder.width).tolist() == t.encode(text, add_special_tokens=False).ids


def test_known_words_are_not_encoded_again_behind_other_punctuation():
    class Counted:
        def __init__(self, library):
            self.library, self.characters = library, 0

        def encode_batch_fast(self, texts, **how):
            self.characters += sum(map(len, texts))
            return self.library.encode_batch_fast(texts, **how)

    words = [f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    coder = token_records.Encoder(BYTE_BPE)
    coder.encode([" ".join(words)])
    coder.library = counted = Counted(coder.library)
    texts = [" ".join(["x", *[w + end for w in words]]) for end in (".", ",", ";", "?", "!")]
    coder.encode(texts)
    assert counted.characters < 100 < len(words)


def test_records_of_null_repeated_and_clashing_rows(spark):
    rows = [(None, "null id"), (3, None), (3, ""), (3, "three"), (3, "three"), (-5, "minus"), (2 ** 62, "<|endoftext|> large"), (9, "long " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("own").alias(c) for c in EXTRA])
    manifest = token_records.write_records(docs, BYTE_BPE, end_id=2)
    got = sorted(((r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in token_records.read_records(manifest).collect()), key=lambda r: r[1])
    texts = {zlib.crc32(np.array([*library().encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()): t for _, t in rows}
    filed = [(r[0], texts[r[3]]) for r in got]
    assert got == plain_records(filed, library()) and order(filed) == order((i, t or "" if t is None else t) for i, t in [(a, b or "") for a, b in rows])
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    shuffled = [token_records.shuffled_records(manifest, seed=1, epoch=e).collect() for e in (0, 0, 1)]
    assert shuffled[0] == shuffled[1] and len(shuffled[0]) == len(rows)
    assert all(order((r.doc_id, r.start, len(r.ids)) for r in s) == order((a, b, 4 * n) for a, b, n, _ in got) for s in shuffled)
    assert order(spark.createDataFrame([], docs.schema).transform(lambda d: token_records.read_records(token_records.write_records(d, BYTE_BPE, 2))).collect()) == []


def test_frames_and_damage(spark, tmp_path):
    framed = token_records.frame(b"payload")
    crc = zlib.crc32(b"payload")
    assert framed[:8] == struct.pack("<Q", 7) and struct.unpack("<I", framed[-4:])[0] == ((crc >> 15 | crc << 17) + 0xA282EAD8) % 2 ** 32
    assert token_records.unframe(framed, 0) == (b"payload", len(framed))
    for at in range(len(framed)):
        broken = bytearray(framed)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            token_records.unframe(bytes(broken), 0)
    with pytest.raises(ValueError):
        token_records.unframe(framed[:-1], 0)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    manifest = token_records.write_records(docs, BYTE_BPE, end_id=2, folder=str(tmp_path / "records"))
    file = manifest.orderBy("shard").first().records_file
    data = bytearray(open(file, "rb").read())
    data[20] ^= 1
    open(file, "wb").write(data)
    with pytest.raises(Exception, match="checksum"):
        token_records.read_records(manifest).collect()
