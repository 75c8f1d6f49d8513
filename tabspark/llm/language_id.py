"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text accepts exactly the
substrings of that text.  A new text is cut greedily into the longest phrases
that occur there; the phrases, normalised by the logarithm of the labelled
text's length over the length of the parsed text, estimate the cross entropy,
and the language that needs the fewest wins.

The automata are dense transition tables over the bytes seen in training.  A
missing transition holds the root's transition with a flag that ends a phrase,
so a step is one table look-up; all blocks of a slice of documents step
together.  Texts are parsed whole, in blocks of ``BLOCK`` bytes.

Scale: rows stay where they were read; nothing is shuffled but the counts per
label.  The model is bounded by ``docs_per_language`` x ``chars_per_doc``
labelled characters (parameters), taken from places all over the sampled texts
and shared evenly over them up to ``train_bytes`` a language.

Defined results: a null text or one without a letter is ``und`` with score 0.
Other texts get the learnt language with the fewest normalised phrases, ties
going to the language with more labelled rows, then to the first by name; the
score is the logistic of the lead over the next language in phrases (1 with a
single language).  Without labelled rows every text is ``und``.  Repeated rows
get equal results, other columns stay, an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .arrow import map_slices
from .sampling import sample_per_class

UND = "und"
BLOCK = 1024
PIECES = 8
SLICE = 2 << 20
FLAG = -(1 << 31)
LETTER = regex.compile(r"\p{L}")


def _fold_table() -> np.ndarray:
    """Bytes of lower-case text: ASCII letters and multi-byte characters stay, the rest is a space."""
    fold = np.full(256, 32, np.uint8)
    fold[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    fold[128:] = np.arange(128, 256)
    return fold


FOLD = _fold_table()


def normalise(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends): each text lower-cased, with single spaces around and between its words."""
    raw = [b" " + t.lower().encode() + b" " for t in texts]
    flat = FOLD[np.frombuffer(b"".join(raw), np.uint8)]
    ends = np.cumsum([len(r) for r in raw])
    space = flat == 32
    keep = np.ones(len(flat), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    keep[begins] = True  # a text's first space stays beside the last one of the text before
    return flat[keep], np.cumsum(keep)[ends - 1] if len(ends) else ends


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings; state 0 is the root."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return go


class Model:
    """Languages with their automata as tables; row offsets are premultiplied by the number of classes."""

    def __init__(self, texts: dict[str, bytes], rank: list[str]):
        self.langs = [x for x in rank if texts.get(x)]
        seen = sorted(set(b"".join(texts[x] for x in self.langs)))
        self.classes = np.zeros(256, np.int32)  # class 0: bytes no language has
        self.classes[seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 1
        self.tables, self.bits = [], []
        for lang in self.langs:
            go = suffix_automaton(texts[lang])
            root = np.full(width, FLAG, np.int32)
            for c, s in go[0].items():
                root[self.classes[c]] = s * width | FLAG
            table = np.tile(root, (len(go), 1))
            for i, step in enumerate(go):
                for c, s in step.items():
                    table[i, self.classes[c]] = s * width
            self.tables.append(table.ravel())
            self.bits.append(np.log2(len(texts[lang]) + 1))

    def phrases(self, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(languages x texts): phrases in each text."""
        begins = np.concatenate(([0], ends[:-1]))
        many = -(-(ends - begins) // BLOCK)
        owner = np.repeat(np.arange(len(ends)), many)
        at = begins[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)) * BLOCK
        size = np.minimum(ends[owner] - at, BLOCK)
        order = np.argsort(-size, kind="stable")
        owner, at, size = owner[order], at[order], size[order]
        live = np.searchsorted(-size, -np.arange(BLOCK), side="left")  # blocks longer than the step
        codes = self.classes[flat]
        steps = int(size[0]) if len(size) else 0
        grid = codes[np.minimum(at[None, :] + np.arange(steps)[:, None], max(len(codes) - 1, 0))] if steps else None
        out = np.zeros((len(self.langs), len(ends)), np.int64)
        for i, table in enumerate(self.tables):
            state, count = np.zeros(len(size), np.int32), np.ones(len(size), np.int32)
            for t in range(steps):
                n = int(live[t])
                got = table[state[:n] + grid[t, :n]]
                count[:n] -= got >> 31
                np.bitwise_and(got, 0x7FFFFFFF, out=state[:n])
            out[i] = np.bincount(owner, count, len(ends)).astype(np.int64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UND] * len(texts), [0.0] * len(texts)
        of = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if self.langs else []
        if of:
            flat, ends = normalise([texts[i] for i in of])
            weight = np.array(self.bits) / max(self.bits)
            need = self.phrases(flat, ends) * weight[:, None]
            best = need.argmin(axis=0)
            low = np.sort(need, axis=0)
            lead = low[1] - low[0] if len(self.langs) > 1 else np.full(len(of), np.inf)
            sure = 1 / (1 + np.exp(-np.minimum(lead, 700)))
            for j, i in enumerate(of):
                langs[i], scores[i] = self.langs[best[j]], float(sure[j])
        return langs, scores


def _inner(piece: str, whole: bool) -> str:
    """A piece without the words that its ends may have cut."""
    words = piece.split(" ")
    return piece if whole or len(words) < 3 else " ".join(words[1:-1])


def even_shares(sizes: list[int], total: int) -> list[int]:
    """``total`` shared evenly over the sizes; what a size leaves goes to the others."""
    out, left = [0] * len(sizes), total
    for k, i in enumerate(sorted(range(len(sizes)), key=lambda i: (sizes[i], i))):
        out[i] = min(sizes[i], left // (len(sizes) - k))
        left -= out[i]
    return out


def fit(docs: DataFrame, docs_per_language: int = 40, chars_per_doc: int = 2000, train_bytes: int = 32_768) -> Model:
    """Learn from rows with text and lang (a bounded sample, see the parameters).

    Of a sampled text above ``chars_per_doc`` characters, ``PIECES`` pieces at places drawn by hash from
    all of it are taken; a language's ``train_bytes`` are shared evenly over its sampled texts.
    """
    each = max(1, chars_per_doc // PIECES)
    length, text = F.char_length("text"), F.col("text")
    place = lambda j: F.pmod(F.xxhash64(F.col("doc_id"), j), length - each + 1).cast("int") + 1
    drawn = F.when(length <= chars_per_doc, F.array(text)).otherwise(
        F.transform(F.sequence(F.lit(1), F.lit(PIECES)), lambda j: F.substr(text, place(j), F.lit(each))))
    rows = docs.filter("lang is not null and text is not null").select("doc_id", "lang", drawn.alias("pieces"))
    sample, counts = sample_per_class(rows, "lang", docs_per_language)
    raw: dict[str, list[bytes]] = {}
    for r in sample:
        flat, _ = normalise([" ".join(_inner(p, len(r["pieces"]) == 1) for p in r["pieces"])])
        raw.setdefault(r["lang"], []).append(flat.tobytes())
    texts = {lang: b"".join(x[:n] for x, n in zip(own, even_shares([len(x) for x in own], train_bytes))) for lang, own in raw.items()}
    return Model(texts, sorted(counts, key=lambda k: (-counts[k], k)))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus lang_pred and score, from the text column alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    def run(part, column):
        langs, scores = shared.value.predict(column.to_pylist())
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return map_slices(docs, run, StructType().add("lang_pred", "string").add("score", "double"), SLICE)
