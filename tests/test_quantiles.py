"""Quantiles from sketches and counts against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import quantiles

PROBS = [0.0, 0.005, 0.25, 0.5, 0.75, 0.995, 1.0]


def check(rows, df, cols, by=()):
    got = {(tuple(r[b] for b in by), r["column"], r.p): r.value for r in quantiles.column_quantiles(df, cols, PROBS, "k", by).collect()}
    want = {}
    for g in {tuple(r[b] for b in by) for r in rows}:
        for c in cols:
            v = [r[c] for r in rows if tuple(r[b] for b in by) == g and r[c] is not None and not np.isnan(r[c])]
            if v:
                want.update({(g, c, p): float(np.quantile(np.array(v), p)) for p in PROBS})
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12, abs=1e-12), k


def data(n, seed):
    rng = random.Random(seed)
    return [{"k": i, "g": rng.choice([None, 1, 2]), "x": rng.gauss(0, 1), "tied": float(rng.choice([1, 1, 1, 2, 5])),
             "gaps": rng.choice([None, float("nan"), rng.random()]), "steep": 10.0 ** rng.uniform(-200, 200) * rng.choice([1, -1]),
             "none": None, "zero": rng.choice([0.0, -0.0])} for i in range(n)]


SCHEMA = "k long, g int, x double, tied double, gaps double, steep double, none double, zero double"
COLS = ["x", "tied", "gaps", "steep", "none", "zero"]


@pytest.mark.parametrize("n, inside", [(1, 200_000), (2, 200_000), (7, 200_000), (5000, 200_000), (5000, 300)])
def test_quantiles(spark, monkeypatch, n, inside):
    monkeypatch.setattr(quantiles, "MAX_INSIDE", inside)  # brackets are sketched again above it
    monkeypatch.setattr(quantiles, "MIN_INSIDE", 10)
    rows = data(n, n)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(5).cache()
    check(rows, df, COLS)
    if n > 2:
        check(rows, df, COLS[:3], ["g"])


def test_missed_brackets_are_widened(spark, monkeypatch):
    rows = data(4000, 3)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).cache()
    real = quantiles._sketches
    # a sketch whose ranks are wrong: every bracket misses at first
    monkeypatch.setattr(quantiles, "_sketches", lambda *a: {k: (n, np.sort(q * 0.2 + 1.5)) for k, (n, q) in real(*a).items()})
    check(rows, df, ["x"])


def test_no_row_is_shuffled_and_many_groups_are_ranked(spark, monkeypatch):
    rows = data(300, 5)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).cache()
    with monkeypatch.context() as m:
        m.setattr(quantiles, "grouped_row_number", None)
        check(rows, df, ["x"])
    monkeypatch.setattr(quantiles, "MAX_GROUPS", 2)
    check(rows, df, ["x"], ["g"])
    assert quantiles.column_quantiles(df.limit(0), ["x"], PROBS, "k").collect() == []
