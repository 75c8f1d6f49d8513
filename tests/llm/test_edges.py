"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tabspark.llm import bpe, language_id, pii, toxicity
from tabspark.llm.embedding_dedup import near_vectors
from tabspark.llm.exact_dedup import exact_dedup, exact_groups
from tabspark.llm.line_dedup import drop_lines
from tabspark.llm.mixing import mix, mixed_documents
from tabspark.llm.pii import pseudonymise
from tabspark.llm.simhash import near_dedup, near_groups
from tabspark.llm.substring_dedup import remove_repeats

from . import brute

LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = " ".join(f"p{i}" for i in range(40))
ROWS = [
    (1, "same text here", "en", "a", 1), (2, "same text here", "en", "a", 1), (2, "same text here", "en", "a", 1),
    (3, None, "en", "a", 0), (4, "", None, None, 0), (5, " \t ", "fr", "b", 2), (None, "same text here", "fr", None, 3),
    (6, LONG, "en", "b", len(LONG)), (7, LONG + " tail", "en", "b", 0), (8, "12 34 !", None, "b", 7),
    (9, "x " + PASSAGE + " y", "en", "c", 1), (10, PASSAGE + "\nline\nLINE \n", "en", "c", 1), (11, "line\n" * 3, "en", "c", 1),
    (12, "Çédille ñandú straße 中文 \U0001f600", "de", "c", 1),
]
WORDS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
CLASH = ["digest", "kept", "key", "fp", "of", "anchor", "hash", "row", "pos", "size", "target", "copies", "rate", "label",
         "score", "ids", "n_tokens", "n_words", "n_removed", "n_lines", "n_dropped", "lang_pred", "predicted", "decoded",
         "__drop", "col", "found", "n_found", "a.b", "node", "root", "component_id", "least", "historical", "batch", "u", "v"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def wide(docs):
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASH])


def model(spark, docs):
    return language_id.fit(docs)


def whole(name, spark, docs):
    """The operators that return the rows of their input with its columns."""
    return {
        "exact": lambda: exact_dedup(docs), "near": lambda: near_dedup(docs), "mix": lambda: mixed_documents(docs),
        "lines": lambda: drop_lines(docs, min_docs=2), "substring": lambda: remove_repeats(docs),
        "bpe": lambda: bpe.encode(docs, *WORDS), "lang": lambda: language_id.identify(docs, model(spark, docs)),
        "toxic": lambda: toxicity.score(docs, toxicity.train(["you moron", "good day"] * 3, [1, 0] * 3)), "pii": lambda: pseudonymise(docs, "k"),
    }[name]()


NAMES = ["exact", "near", "mix", "lines", "substring", "bpe", "lang", "toxic", "pii"]
REPLACED = {"lines": {"n_lines", "n_dropped"}, "substring": {"n_words", "n_removed"}, "bpe": {"ids", "n_tokens"},
            "lang": {"lang_pred", "score"}, "toxic": {"score", "predicted"}, "pii": {"found", "n_found"}}


@pytest.mark.parametrize("name", NAMES)
def test_clashing_columns_stay(spark, wide, name):
    out = whole(name, spark, wide)
    rows = out.collect()
    assert rows
    for c in wide.columns:
        assert c in out.columns
        if c in CLASH and c not in REPLACED.get(name, set()):
            assert {r[c] for r in rows} == {f"own {c}"}


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, docs, name):
    assert whole(name, spark, docs.limit(0)).collect() == []


def test_exact(spark, docs):
    out = exact_groups(docs).collect()
    assert len(out) == len(ROWS)
    by = {(r.doc_id, r.text_sha256): r for r in out}
    same = hashlib.sha256(b"same text here").hexdigest()
    assert {(r.keep_id, r.group_size) for r in out if r.text_sha256 == same} == {(2, 4)}
    assert not by[1, same].kept and by[2, same].kept and not by[None, same].kept
    empty = hashlib.sha256(b"").hexdigest()
    assert by[3, empty].keep_id == 4 and by[4, empty].kept and not by[3, empty].kept
    kept = exact_dedup(docs).collect()
    assert sorted(r.doc_id for r in kept) == [2, 4, 5, 6, 7, 8, 9, 10, 11, 12]  # the repeated row stays once
    lone = spark.createDataFrame([(None, "x"), (None, "x"), (None, "y")], "doc_id long, text string")
    assert all(r.kept and r.keep_id is None for r in exact_groups(lone).collect())


@pytest.mark.parametrize("history", ["true", "false", "doc_id < 6", "cast(null as boolean)"])
def test_exact_is_the_same_for_any_history(docs, history):
    key = lambda r: (r.text_sha256, str(r.doc_id))
    assert sorted(map(tuple, exact_groups(docs, F.expr(history)).collect()), key=str) == sorted(map(tuple, exact_groups(docs).collect()), key=str)


def test_substring(docs):
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in remove_repeats(docs).collect()), key=str)
    assert got == sorted(brute.without_repeats([r[:2] for r in ROWS]), key=str)


def test_lines(docs):
    for least in (1, 2, 3):
        got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in drop_lines(docs, min_docs=least).collect()), key=str)
        assert got == sorted(brute.without_lines([r[:2] for r in ROWS], least), key=str)


def test_simhash(docs):
    rows = near_groups(docs).collect()
    assert len(rows) == len(ROWS)
    want = brute.simhash_groups({(r[0] if r[0] is not None else 10 ** 6): r[1] for r in ROWS}.items())
    for r in rows:
        i = r.doc_id if r.doc_id is not None else 10 ** 6
        assert (r.fp % 2 ** 64, r.component_id) == want[i]
    assert {r.component_id for r in rows if r.doc_id in (3, 4, 5)} == {3}  # no words: fingerprint zero


def test_mixing(docs):
    rows = mix(docs).collect()
    assert len(rows) == len(ROWS)
    size = {3: 0, 4: 0, 5: 0, 1: 3, 8: 3}
    for r in rows:
        assert r.size == size.get(r.doc_id, r.size)
        assert 0 <= r.copies <= 3 and r.target <= 3 * r.source_size + 1e-9
    again = mix(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert {r.target for r in rows if r.source is None} != set()
    assert mixed_documents(docs).count() == sum(r.copies for r in rows)


def test_bpe(docs):
    import tiktoken
    codec = tiktoken.Encoding("own", pat_str=WORDS[1], mergeable_ranks=bpe.read_ranks(WORDS[0]), special_tokens={})
    rows = bpe.decode(bpe.encode(docs, *WORDS, verify=True), *WORDS).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        want = codec.encode_ordinary(r.text or "")
        assert r.n_tokens == len(want) and bytes(r.ids) == b"".join(x.to_bytes(4, "little") for x in want)
        assert bytes(r.decoded) == (r.text or "").encode() and r.round_trip


def test_language(spark, docs):
    out = language_id.identify(docs, model(spark, docs)).collect()
    for r in out:
        none = r.text is None or not any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == none and 0 <= r.score <= 1
    blank = language_id.identify(docs, language_id.fit(docs.filter("lang = 'xx'"))).collect()
    assert {r.lang_pred for r in blank} == {"und"}


def test_toxicity_constant_without_both_labels(spark, docs):
    for labels, want in (([], 0.0), ([(1, 1)], 1.0), ([(1, 0), (9, 0)], 0.0), ([(1, None), (None, 1)], 0.0)):
        m = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {r.score for r in toxicity.score(docs, m).collect()} == {want}


def test_pii_edges(docs):
    rows = pseudonymise(docs, "k").collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in rows) == sorted((str(r[0]), str(r[1])) for r in ROWS)
    assert {r.n_found for r in rows} == {0}


def test_vectors(spark):
    a, b = [1.0, 0.0, 0.2], [1.0, 0.01, 0.2]
    rows = [(1, a, 1), (2, b, 1), (3, b, 2), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 0.0], 1),
            (8, [float("nan"), 1.0, 0.0], 1), (9, [float("inf"), 1.0, 0.0], 1), (10, a, None), (11, [1.0, 0.0], 1), (12, a, 1),
            (13, [-1.0, 0.0, -0.2], 1), (14, [1e-30, 0.0, 2e-31], 1), (15, [1e30, 0.0, 2e29], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df).collect()}
    assert got == brute.vector_groups([(r.vec_id, r.embedding, r.label) for r in df.collect()], 0.93)
    twice = near_vectors(df.union(df.filter("vec_id = 1"))).collect()
    assert sorted(r.n_links for r in twice if r.vec_id == 1) == [got[1][0] + 1] * 2
    none = spark.createDataFrame([(None, a, 1), (None, a, 1)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in near_vectors(none).collect()] == [(None, 1, None, True)] * 2
    assert near_vectors(df.limit(0)).collect() == []


def card_texts(spark, texts):
    rows = pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").collect()
    return {texts[r.doc_id]: r for r in rows}


def test_pii_cards_beside_other_numbers(spark):
    want = {
        "4111111111111111 5500000000000004": 2, "4111 1111 1111 1111 12/27": 1, "4111111111111111 123": 1,
        "qty 3 4111 1111 1111 1111": 1, "1000 2000 3000 4111 1111 1111 1111 2027": 1, "4111-1111-1111-1111 5500-0000-0000-0004": 2,
        "3782 822463 10005 123": 1, "x 17 4222222222222 9": 1, "4111 1111 1111 1111 123 2027": 1,
        "6304 0000 0000 0000 000 12/27": 1, "40470 54433 95352 2": 1, "4111111111111112 4111111111111113": 0,
    }
    for text, r in card_texts(spark, list(want)).items():
        assert (r.found, len(r.text)) == (["card"] * want[text], len(text)), text
        for raw in ("4111", "5500", "3782", "4222222222222", "6304 0000", "40470 54433") if want[text] else ():
            assert raw not in r.text


def test_pii_card_marks_of_the_text_stay(spark):
    text = "﷐ ﷐4111111111111112﷑ ﷐﷒ me4111111111111111@a.example"
    r = card_texts(spark, [text])[text]
    assert r.found == ["email"] and r.text.startswith("﷐ ﷐4111111111111112﷑ ﷐﷒ ") and r.text.endswith("@a.example")
    assert card_texts(spark, ["﷐"])["﷐"].text == "﷐"


def test_pii_dates_beside_numbers_and_day_first(spark):
    want = {
        "2024-01-05 2024-01-06": ["date"] * 2, "2024-01-05 123456": ["date"], "123456 2024-01-05": ["date"],
        "7 8 2024-01-05 99 25.12.2024 1": ["date"] * 2, "12345678901 25/12/2024": ["date"],
        "1234 5678 9012 2024-01-05": ["date"], "123456 877-555-1855 77": ["phone"],
        "25/12/2024 and 12/25/2024": ["date"] * 2, "4111111111111111 25/12/2024": ["card", "date"], "31/02/2024 13/13/2024": [],
    }
    for text, r in card_texts(spark, list(want)).items():
        assert (r.found, len(r.text)) == (want[text], len(text)), text
        for raw in ("2024-01-0", "25.12.2024", "25/12/2024", "12/25/2024", "555-1855", "4111"):
            assert raw not in r.text, text


def test_pii_day_first_dates_stay_apart(spark):
    days = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))
    one = spark.range(3000).select(F.date_format(days, "MM/dd/yyyy").alias("m"))
    two = spark.range(3000).filter(F.dayofmonth(days) > 12).select(F.date_format(days, "dd/MM/yyyy").alias("m"))
    both = one.union(two)
    out = both.select("m", pii._date(F.col("m"), "k").alias("p")).collect()
    assert len({r.p for r in out}) == len({r.m for r in out}) == len(out)
    assert all((int(r.p[:2]) > 12) == (int(r.m[:2]) > 12) for r in out)


@pytest.mark.parametrize("bad,words,space", [
    (["白痴", "混蛋"], "今天 天气 很好 我们 一起 去 公园 散步 看书 喝茶 朋友 学习 工作 音乐 电影 早上 晚上 吃饭 回家 老师", ""),
    (["바보새끼", "멍청이"], "오늘 날씨 좋아요 우리 함께 공원 산책 책을 읽고 차를 마셔요 친구 공부 일하고 음악 영화 아침 저녁 식사 집으로", " "),
])
def test_toxicity_learns_scripts_from_u3000_up(bad, words, space):
    import random
    rng, words = random.Random(3), words.split()
    def text(toxic):
        w = [rng.choice(words) for _ in range(12)]
        if toxic:
            w[rng.randrange(12)] = rng.choice(bad)
        return "。".join(space.join(w[i:i + 4]) for i in range(0, 12, 4)) + "。"
    labels = [i % 2 for i in range(240)]
    model = toxicity.train([text(k) for k in labels], labels)
    m = model.margins([text(k) for k in labels])
    above = [m[i] > m[j] for i in range(1, 240, 2) for j in range(0, 240, 2)]
    assert sum(above) / len(above) > 0.95  # 0.5: no better than chance


def test_toxicity_breaks_and_widths():
    one = lambda t: [x.tolist() for x in toxicity.encode_words([t])]
    assert one("ｉｄｉｏｔ　９") == one("idiot 9")
    assert one("白痴。好、人") != one("白痴好人") and len(one("白痴。好、人")[1]) == 3
    assert one("白痴") != one("好人") and len(one("白痴")[0]) == 1 + 4 + toxicity.SPAN
