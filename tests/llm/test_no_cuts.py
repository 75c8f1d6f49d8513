"""Samples over whole texts, checked near copies in the fit, and rows without an id."""

import random

import numpy as np
from pyspark.sql import functions as F

from tabspark.llm import language_id, mixing, simhash, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, letters, n):
    return " ".join("".join(rng.choices(letters, k=rng.randint(3, 7))) for _ in range(n))


def test_language_fit_reads_behind_a_shared_header(spark):
    rng = random.Random(3)
    header = "shared boilerplate header of every document " * 80  # longer than the sample of a text
    rows = [(i, header + words(rng, letters, 1200), lang, "s", 0) for i in range(60) for lang, letters in [[("xx", "aeiklm"), ("yy", "ouprst")][i % 2]]]
    model = language_id.fit(spark.createDataFrame(rows, DOCS))
    tests = [words(rng, letters, 40) for letters in ("aeiklm", "ouprst") for _ in range(20)]
    assert model.predict(tests)[0] == ["xx"] * 20 + ["yy"] * 20


def test_even_shares():
    assert language_id.even_shares([10, 3, 100, 100], 90) == [10, 3, 38, 39]
    assert language_id.even_shares([5, 5], 90) == [5, 5] and language_id.even_shares([], 9) == []
    assert sum(language_id.even_shares([50] * 7, 100)) == 100


def test_only_near_copies_leave_the_toxicity_fit():
    rng = random.Random(4)
    phrase = "with one common phrase of seven words"
    apart = [f"{words(rng, 'abcdefg', 60)} {phrase} {words(rng, 'hijklm', 60)}" for _ in range(200)]
    copies = [t.replace(" ", " ", 1) + " end" for t in apart[:20]]
    assert toxicity._distinct(apart + copies, np.zeros(220, np.int64)) == list(range(200))
    both = np.array([0] * 200 + [1] * 20)
    assert toxicity._distinct(apart + copies, both) == list(range(220))
    assert toxicity._distinct(["", "", "a", "a b c"], np.zeros(4, np.int64)) == [0, 2, 3]


def test_near_dedup_of_rows_without_or_with_repeated_ids(spark):
    rng = random.Random(9)
    base = words(rng, "abcdefghij", 400)
    near, other, third = base + " tail", words(rng, "klmnopq", 300), words(rng, "rstuvw", 300)
    rows = [(1, base), (None, near), (None, base), (None, other), (None, other), (None, other + " x"), (5, third), (5, third), (5, words(rng, "xyzab", 200)), (9, third)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    fps = [simhash.fingerprint((t or "").encode(), 3) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if bin(fps[i] ^ fps[j]).count("1") <= 2:
                    root[i] = root[j] = min(root[i], root[j])
    kept = simhash.near_dedup(docs, shingle=3, radius=2).collect()
    assert len(kept) == len(set(root))
    groups = {}
    for (i, t), r in zip(rows, root):
        groups.setdefault(r, []).append((i, t))
    for own in groups.values():
        least = min((i for i, _ in own if i is not None), default=None)
        assert sum((k.doc_id, k.text) in own for k in kept) == 1 and any(k.doc_id == least and (least, k.text) in own for k in kept)


def test_rows_without_id_are_drawn_by_text(spark):
    rows = [(None, f"text number {i} of four", "en", "big", 0) for i in range(400)] + [(i, "one two", "en", "a", 0) for i in range(30)]
    out = mixing.mix(spark.createDataFrame(rows, DOCS)).groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.countDistinct("copies").alias("kinds")).collect()
    big = next(r for r in out if r.source == "big")
    assert big.kinds == 2 and abs(big.taken - big.target) < 0.15 * big.target
