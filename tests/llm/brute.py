"""Plain versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def simhash(text, shingle=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash_groups(docs, radius=2):
    """{doc_id: (fingerprint, smallest reachable doc_id)} of (doc_id, text) pairs with distinct ids."""
    fp = {i: simhash(t) for i, t in docs}
    sets, ids = Sets(fp), sorted(fp)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (fp[a] ^ fp[b]).bit_count() <= radius:
                sets.join(a, b)
    return {i: (fp[i], sets.root(i)) for i in ids}


def without_repeats(docs, length=13):
    """[(doc_id, n_words, n_removed, kept text)] in the order given."""
    first = {}
    cut = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in cut:
        for s in range(len(w) - length + 1):
            if i is not None:
                k = tuple(w[s:s + length])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in cut:
        gone = set()
        for s in range(len(w) - length + 1):
            if i is not None and first[tuple(w[s:s + length])] < i:
                gone |= set(range(s, s + length))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(w) - len(kept), " ".join(kept)))
    return out


def without_lines(docs, min_docs, min_chars=1):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    lines = [(i, (t or "").split("\n")) for i, t in docs]
    count = {}
    for _, own in lines:
        for k in {key(x) for x in own}:
            count[k] = count.get(k, 0) + 1
    bad = {k for k, n in count.items() if n >= min_docs and len(k) >= min_chars}
    return [(i, len(own), sum(key(x) in bad for x in own), "\n".join(x for x in own if key(x) not in bad)) for i, own in lines]


def vector_groups(rows, threshold):
    """{vec_id: (links, smallest reachable vec_id)} of (vec_id, vector, label) with distinct ids."""
    ok = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = (np.array(v, float), label)
    links, sets = dict.fromkeys([r[0] for r in rows], 0), Sets([r[0] for r in rows])
    ids = sorted(ok)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            (x, p), (y, q) = ok[a], ok[b]
            if p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[a] += 1
                links[b] += 1
                sets.join(a, b)
    return {i: (links[i], sets.root(i)) for i in links}


def phrases(train: bytes, text: bytes) -> int:
    """Greedy longest phrases of ``text`` that occur in ``train``."""
    n = at = 0
    while at < len(text):
        k = 1
        while at + k < len(text) and text[at:at + k + 1] in train:
            k += 1
        at += k
        n += 1
    return n
