"""Queries without SQL, and the cores of the operators, against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabspark.llm import components, embedding_dedup, language_id, mph, pii, queries, simhash, toxicity

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def held_out(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_minimal_perfect_hash():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 100, 5000):
        a, b = rng.integers(0, 2 ** 63, (2, n), dtype=np.uint64)
        seeds = mph.build(a, b)
        assert sorted(mph.lookup(a, b, seeds, n)) == list(range(n))
    with pytest.raises(ValueError):
        mph.MAX_DISPLACEMENT, old = 2000, mph.MAX_DISPLACEMENT
        try:
            mph.build(np.zeros(2, np.uint64), np.zeros(2, np.uint64))
        finally:
            mph.MAX_DISPLACEMENT = old


def test_components(spark):
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    loose = [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)]
    edges = path + star + loose + path[:5] + [(5000, 5000)]
    sets = brute.Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.join(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {x: sets.root(x) for e in edges for x in e if e[0] != e[1]}
    assert got == want
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_op8(spark, docs):
    want = brute.simhash_groups([(i, r.text) for i, r in docs.items()])
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in queries.op8_simhash_near_dedup(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_bit_sliced_links(spark, radius, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 40)  # cut buckets are compared piece by piece
    rng = random.Random(radius)
    fps = set()
    for _ in range(6):
        c = rng.getrandbits(64)
        fps |= {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, radius + 2))) for _ in range(60)}
    fps = sorted(fps)
    sets = brute.Sets(fps)
    for n, a in enumerate(fps):
        for b in fps[n + 1:]:
            if (a ^ b).bit_count() <= radius:
                sets.join(a, b)
    signed = [f - 2 ** 64 if f >> 63 else f for f in fps]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), radius).collect()
    mine = brute.Sets(fps)
    for r in links:
        a, b = r.u % 2 ** 64, r.v % 2 ** 64
        assert (a ^ b).bit_count() <= radius
        mine.join(a, b)
    assert [mine.root(f) for f in fps] == [sets.root(f) for f in fps]


def test_tiles(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 12))
    rows = [(i, (centres[i % 8] + rng.normal(scale=0.25, size=12)).tolist(), i % 2) for i in range(240)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(df, 0.93).collect()}
    want = brute.vector_groups(rows, 0.93)
    assert got == want and sum(n for n, _ in want.values()) > 100


def test_cross_parsing():
    rng = random.Random(3)
    text = lambda n: bytes(rng.choice(b"ab cd") for _ in range(n))
    train = {"x": text(400), "y": text(300)}
    model = language_id.Model(train, ["x", "y"])
    texts = [text(n) for n in (1, 2, 50, 900, language_id.BLOCK)]
    flat, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    got = model.phrases(flat, ends)
    assert got.tolist() == [[brute.phrases(train[x], t) for t in texts] for x in ("x", "y")]
    long = text(3 * language_id.BLOCK + 5)  # blocks are parsed one by one
    blocks = [long[i:i + language_id.BLOCK] for i in range(0, len(long), language_id.BLOCK)]
    got = model.phrases(np.frombuffer(long, np.uint8), np.array([len(long)]))
    assert got[0, 0] == sum(brute.phrases(train["x"], b) for b in blocks)


def test_op3_held_out_accuracy(spark, docs):
    rows = queries.op3_language_id(spark, SF).collect()
    assert len(rows) == len(docs) and all(r.held_out == held_out(r.doc_id) for r in rows)
    own = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in own]) >= 0.97


def kernel(a, b):
    """The string kernel by enumeration, over words with a space at both ends."""
    def features(w):
        w = " " + w + " "
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + toxicity.SPAN)):
                    out[w[i] + w[j] + w[k]] = out.get(w[i] + w[j] + w[k], 0) + toxicity.DECAY ** (k - i - 2)
        return out
    fa, fb = features(a), features(b)
    return sum(v * fb.get(u, 0) for u, v in fa.items())


def test_string_kernel():
    words = ["moron", "mooron", "idiot", "a", "losers", "serlos"]
    codes, starts, _ = toxicity.encode_words([" ".join(words)])
    raw = [bytes(codes[a + 1:b]) for a, b in zip(starts, [*starts[1:], len(codes) - toxicity.SPAN])]
    x, _ = toxicity._embed(raw)
    norm = toxicity._self(np.array([len(w) for w in words]))
    want = np.array([[kernel(a, b) for b in words] for a in words]) / norm[:, None] / norm[None, :]
    assert np.allclose(x @ x.T, want, atol=1e-5)


def test_toxicity_gapped_and_inserted(spark):
    rng = random.Random(4)
    clean = ["the", "house", "green", "river", "walks", "morning", "stone", "idea", "table", "lost"]
    bad = ["moron", "idiot", "stupid", "loser"]
    texts, y = [], []
    for i in range(400):
        words = rng.choices(clean, k=rng.randrange(5, 40))
        y.append(i % 4 == 0)
        if y[-1]:
            words[rng.randrange(len(words))] = rng.choice(bad)
        texts.append(" ".join(words) + ".")
    model = toxicity.train(texts, np.array(y, int))
    ask = ["you moron", "an i.d.i.o.t", "s t u p i d", "mo-ron", "stuupid", "the green house", "morning idea", "", None, "!!"]
    score = model.scores(ask)
    assert (score[:5] >= 0.3).all() and (score[5:] < 0.3).all()


def test_op5_held_out(spark):
    rows = queries.op5_toxicity(spark, "/root/testdata/sf0.1").collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    own = [(r.score, r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert all(0 <= s <= 1 and p == (s >= 0.3) for s, p, _ in own)
    # in these tables some clean texts use the same stems as the toxic ones
    assert np.mean([p for _, p, y in own if y == 0]) <= 0.05
    assert np.mean([p for _, p, y in own if y == 1]) >= 0.8


def feistel(text, key, tag):
    import hashlib
    def shift(a, b, r):
        out = ""
        for i, c in enumerate(a):
            move = int(hashlib.md5(f"{key}|{tag}|{r}|{i}|{b}".encode()).hexdigest()[:7], 16)
            for base, n in (("0", 10), ("a", 26), ("A", 26)):
                if ord(base) <= ord(c) < ord(base) + n:
                    c = chr(ord(base) + (ord(c) - ord(base) + move) % n)
                    break
            out += c
        return out
    h = len(text) // 2
    for r in range(pii.ROUNDS):
        a, b = text[:h], text[h:]
        text = shift(a, b, r) + b if r % 2 == 0 else a + shift(b, a, r)
    return text


def test_feistel(spark):
    values = ["0", "12", "abc.DEF-99", "4047054433953", "", "é1"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(pii.feistel_chars(F.col("s"), "k", "t")).collect()]
    assert got == [feistel(v, "k", "t") for v in values]


@pytest.mark.parametrize("make,size", [
    (lambda i: pii._ssn(F.concat_ws("-", F.lpad((i % 898 + 1 + (i % 898 >= 665).cast("int")).cast("string"), 3, "0"), F.lit("07"), F.lpad((i + 1).cast("string"), 4, "0")), "k"), 5000),
    (lambda i: pii._ipv4(F.concat_ws(".", F.lit("10.1"), F.floor(i / 256).cast("string"), (i % 256).cast("string")), "k"), 5000),
    (lambda i: pii._date(F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), i.cast("int")), "MM/dd/yyyy"), "k"), 20000),
    (lambda i: pii._phone(F.concat(F.lit("(212) 555-"), F.lpad(i.cast("string"), 4, "0")), "k"), 5000),
])
def test_pseudonyms_stay_valid_and_distinct(spark, make, size):
    out = spark.range(size).select(make(F.col("id")).alias("p"))
    kinds = out.select("p", pii.kind_of(F.col("p")).alias("kind"))
    assert kinds.agg(F.countDistinct("p"), F.count("kind")).first()[:] == (size, size)


def test_pii_links_values_across_documents(spark):
    rows = [(1, "card 4047054433953522, call +1 (877) 555-1855 on 2024-02-29"), (2, "4047 0544 3395 3522 / 877-555-1855 / 29.02.2024"),
            (3, "bad 4047054433953521 300.1.1.1 2023-02-29 666-12-1234 000-12-1234")]
    out = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    digits = lambda s: "".join(c for c in s if c.isdigit())
    assert out[1].found == ["card", "phone", "date"] == out[2].found
    assert digits(out[1].text)[:16] == digits(out[2].text)[:16] != "4047054433953522"
    assert out[3].text == rows[2][1] and out[3].n_found == 0
    assert "4047" not in out[1].text and "555-1855" not in out[1].text + out[2].text and "2024-02-29" not in out[1].text


def test_op9_leaves_no_raw_value(spark, docs):
    import re
    out = {r.doc_id: r for r in queries.op9_pii(spark, SF).collect()}
    assert out.keys() == docs.keys()
    find = re.compile(r"[a-z]+\.\d+@mail\d\.example\.com|(?<!\d)4\d{15}(?!\d)|\+1 \(\d{3}\) \d{3}-\d{4}")
    seen = 0
    for i, r in docs.items():
        for value in find.findall(r.text):
            seen += 1
            assert value not in out[i].text
    assert seen > 0 and sum(r.n_found for r in out.values()) >= seen


def test_op10(spark, docs):
    import hashlib

    import public_tokenizers as p
    import tiktoken
    from tabspark.llm import bpe
    codec = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=bpe.read_ranks(p.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    for r in queries.op10_byte_bpe(spark, SF).collect():
        ids = codec.encode_ordinary(docs[r.doc_id].text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id].text or "").encode()).hexdigest()


def test_pipeline(spark, docs):
    """Every stage by its plain version; the language stage rejects texts without a letter."""
    import public_tokenizers as p
    import tiktoken
    from tabspark.llm import bpe
    left = {i: r for i, r in docs.items() if r.text and any(c.isalpha() for c in r.text)}
    newest = {}
    for i, r in left.items():
        newest[r.text] = max(i, newest.get(r.text, i))
    left = {i: left[i] for i in newest.values()}
    groups = brute.simhash_groups([(i, r.text) for i, r in left.items()])
    left = {i: r for i, r in left.items() if groups[i][1] == i}
    size = {i: len(brute.WORD.findall(r.text)) for i, r in left.items()}
    total = {}
    for i, r in left.items():
        total[r.source] = total.get(r.source, 0) + size[i]
    weight = {s: k % 3 + 1 for k, s in enumerate(sorted(total))}
    free, open_, target = sum(total.values()), set(total), {}
    while True:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if free * weight[s] / w > 3 * total[s]}
        if not over:
            break
        target |= {s: 3 * total[s] for s in over}
        free -= sum(3 * total[s] for s in over)
        open_ -= over
    target |= {s: free * weight[s] / w for s in open_}
    import hashlib
    codec = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=bpe.read_ranks(p.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = []
    for i, r in left.items():
        rate = target[r.source] / total[r.source]
        draw = int(hashlib.md5(f"17|{i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        want += [(i, tuple(codec.encode_ordinary(r.text)))] * (int(rate) + (draw < rate - int(rate)))
    out = corpus_pipeline.run(spark, SF).collect()
    assert all(r.round_trip for r in out)
    assert sorted((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in out) == sorted(want)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup", "mixing sources", "byte-level BPE"]
