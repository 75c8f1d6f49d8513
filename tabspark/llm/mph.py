"""Minimal perfect hash (hash and displace) over a bounded set of keys.

Keys come as two independent 64-bit words each.  The first word picks a
bucket; buckets are placed from the largest to the smallest, each with the
first displacement that sends its keys to free slots.  ``n`` keys fill exactly
the slots ``0 .. n-1``; a key outside the set lands on some slot, so a caller
always compares the slot's full key.
"""

from __future__ import annotations

import numpy as np

KEYS_PER_BUCKET = 3
MAX_DISPLACEMENT = 1 << 24


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on uint64 (wraps modulo 2^64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _slot(word: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(word + d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)


def build(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Displacement of every bucket; keys must be distinct."""
    n = len(first)
    if n == 0:
        return np.zeros(0, np.int64)
    buckets = max(1, n // KEYS_PER_BUCKET)
    bucket = (first % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    counts = np.bincount(bucket, minlength=buckets)
    ends = np.cumsum(counts)
    seeds, taken = np.zeros(buckets, np.int64), np.zeros(n, bool)
    for b in np.argsort(-counts, kind="stable"):
        size = int(counts[b])
        if size == 0:
            break
        keys = second[order[ends[b] - size:ends[b]]]
        d, step = 0, 16
        while True:
            tries = np.arange(d, d + step, dtype=np.int64)
            slots = _slot(keys[None, :], tries[:, None], n)
            ok = ~taken[slots].any(axis=1)
            if size > 1:
                s = np.sort(slots, axis=1)
                ok &= (s[:, 1:] != s[:, :-1]).all(axis=1)
            hit = np.flatnonzero(ok)
            if len(hit):
                seeds[b] = tries[hit[0]]
                taken[slots[hit[0]]] = True
                break
            d, step = d + step, min(4096, step * 4)
            if d > MAX_DISPLACEMENT:
                raise ValueError("no displacement found: keys are not distinct")
    return seeds


def lookup(first: np.ndarray, second: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """Slot of each key (any slot for a key outside the set); needs ``n > 0``."""
    return _slot(second, seeds[(first % np.uint64(len(seeds))).astype(np.int64)], n)
