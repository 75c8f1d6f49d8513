"""Toxicity by a subsequence string kernel SVM with Nystroem landmarks.

The kernel of two words sums, over all subsequences of three characters
(word ends count as a character), the products of their weights in both words;
a subsequence that spans more characters weighs less, and spans go up to
``SPAN``, so gaps and inserted characters cost weight but not the match.  It is
normalised by word length.  Punctuation inside a word and single spaces between
single letters are passed over.  A character from U+3000 up (Chinese, Japanese,
Korean, emoji) counts as two characters of a hash of it; punctuation there ends
a word like a space, and full-width letters and digits are read as ASCII ones.

Training takes labelled sentences: a sentence of a toxic text is a bag of words
of which some carry the label.  Words start with the log-odds of their
subsequences; then a squared-hinge SVM on the Nystroem features of the
landmarks and the choice of the words that carry the label take turns.  As the kernel is an
explicit sum, the SVM's landmark expansion folds into one weight for each
subsequence, and scoring a text is a table look-up for each gap pattern.  A
text's margin is that of its worst word, so long texts aren't diluted; a
logistic fitted on texts outside the SVM's half of the sample makes it a score.

Scale: texts are scored in the task that reads them; the sample is drawn from ids
and labels, and only its texts are fetched.  The fit sees at most ``per_class`` labelled texts of each
label of up to ``max_chars`` characters (parameters); texts are scored whole.

Defined results: a null or empty text, or one without words, scores like the
least toxic margin; without rows of both labels all scores are the share of
label 1 (0 if there is none).  Repeated rows get equal results, other columns
stay, an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .arrow import map_slices
from .sampling import sample_per_class

CLASSES = 64
SPAN = 5
DECAY = 0.5
SLICE = 1 << 20
GAPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
SENTENCE = regex.compile(r"[^.!?\n。！？｡]*[^.!?\n\s。！？｡][^.!?\n。！？｡]*")
PAIR, FIRST, RADIX = 28, 28, 35  # class of characters that become two; those two are of the classes 28 to 62


def _class_table() -> np.ndarray:
    """Class of each code point below 0x10000: 0 space, 1-26 letters, 27 digits, 63 left out, others by hash or (from 0x3000) PAIR."""
    table = (29 + np.arange(0x10000) * 40503 // 16 % 33).astype(np.uint8)
    table[0x3000:] = PAIR
    table[:128] = 63
    table[ord("a"):ord("z") + 1] = np.arange(1, 27)
    table[ord("0"):ord("9") + 1] = 27
    table[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x2028, 0x2029]] = 0
    table[0x2000:0x200B] = 0
    for a, b in ((0x3000, 0x3005), (0x3008, 0x3021), (0x3030, 0x3031), (0x303D, 0x3040), (0x30FB, 0x30FC), (0xFE10, 0xFE20), (0xFE30, 0xFE70),
                 (0xFF00, 0xFF66)):
        table[a:b] = 0
    table[0xFE00:0xFE10] = 63
    for a, b in ((0x30, 0x3A), (0x61, 0x7B)):
        table[a + 0xFEE0:b + 0xFEE0] = table[a:b]
    return table


CLASS = _class_table()


def encode_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, starts, text): classes of all words, each after one 0; index of a word's 0; its text.

    The codes end with SPAN zeros.
    """
    points = np.frombuffer("\n".join([(t or "").lower() for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.full(len(points), PAIR, np.uint8)
    low = points < len(CLASS)
    codes[low] = CLASS[points[low]]
    breaks = np.flatnonzero(points == 10)
    lens = np.array([(t or "").count("\n") for t in texts], np.int64)
    # the joining line breaks are the ones after each text's own
    joints = breaks[np.cumsum(lens + 1)[:-1] - 1] if len(texts) > 1 else np.zeros(0, np.int64)
    space = codes == 0
    # a space between single characters is passed over: "i d i o t"
    left = np.concatenate(([True, True], space))[:len(space)]
    right = np.concatenate((space, [True, True]))[2:2 + len(space)]
    lone = space.copy()
    lone &= left & right
    lone[joints] = False
    lone &= points == 32
    keep = (codes != 63) & ~lone
    owner = np.zeros(len(points), np.int64)
    owner[joints] = 1
    owner = np.cumsum(owner)[keep]
    points, codes = points[keep], codes[keep]
    pair = codes == PAIR
    if pair.any():
        hashed = ((points[pair].astype(np.uint64) * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)) >> np.uint64(12)) % np.uint64(RADIX * RADIX)
        codes[pair] = FIRST + hashed // RADIX
        times = 1 + pair
        codes, owner = np.repeat(codes, times), np.repeat(owner, times)
        codes[np.cumsum(times)[pair] - 1] = FIRST + hashed % RADIX
    solid = codes != 0
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    # one 0 before each word: keep solids, and put in zeros
    place = np.cumsum(solid) - 1 + np.cumsum(first)
    out = np.zeros(int(solid.sum()) + int(first.sum()) + SPAN, np.uint8)
    out[place[solid]] = codes[solid]
    return out, place[first] - 1, owner[first]


def _grams(codes: np.ndarray):
    """For each gap pattern: (weight, positions where it stays in one word, subsequence ids there)."""
    n = len(codes) - SPAN
    zero = np.flatnonzero(codes == 0)
    begin = np.arange(n)
    room = zero[np.searchsorted(zero, begin, side="right")] - begin  # distance to the word's end
    wide = codes.astype(np.int32)
    for i, j in GAPS:
        ids = wide[:n] * (CLASSES * CLASSES) + wide[i:n + i] * CLASSES + wide[j:n + j]
        yield DECAY ** (j - 2), room >= j, ids


def _self(size: np.ndarray) -> np.ndarray:
    """Norm of a word of so many characters: the root of its squared weights."""
    total = sum((j - 1) * DECAY ** (2 * (j - 2)) * np.maximum(size + 2 - j, 0) for j in range(2, SPAN))
    return np.sqrt(np.maximum(total, 1))


def _sizes(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate((starts, [len(codes) - SPAN]))) - 1


def word_values(codes: np.ndarray, starts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Normalised sum of the subsequence weights of each word."""
    if not len(starts):
        return np.zeros(0)
    values = np.zeros(len(codes) - SPAN)
    for w, inside, ids in _grams(codes):
        values += np.where(inside, w * weight[ids], 0)
    return np.add.reduceat(values, starts) / _self(_sizes(codes, starts))


class Model:
    """Weight of each subsequence, intercept and the logistic of the margin; ``flat`` is a constant score."""

    def __init__(self, weight, bias: float, slope: float, shift: float, flat: float | None = None):
        self.weight, self.bias, self.slope, self.shift, self.flat = weight, bias, slope, shift, flat

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """Margin of the worst word; without words the least margin."""
        codes, starts, owner = encode_words(texts)
        out = np.full(len(texts), -np.inf)
        if len(starts):
            values = word_values(codes, starts, self.weight) + self.bias
            head = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            out[owner[head]] = np.maximum.reduceat(values, head)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(texts), self.flat)
        return 1 / (1 + np.exp(-np.clip(self.slope * np.maximum(self.margins(texts), -1e3) + self.shift, -30, 30)))


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM by Newton steps on the rows inside the margin."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    reg = np.full(a.shape[1], ridge)
    reg[-1] = 1e-6
    for _ in range(50):
        active = y * (a @ w) < 1
        part = a[active]
        h = (part * cost[active, None]).T @ part + np.diag(reg)
        new = np.linalg.solve(h, (part * cost[active, None]).T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], float(w[-1])


def _logistic(m: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Platt's logistic of the margins, with his smoothed targets; row i counts ``times[i]``."""
    pos, neg = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g = np.array([(times * (p - t) * m).sum() + 1e-3 * a, (times * (p - t)).sum()])
        s = times * np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(s * m * m).sum() + 1e-3, (s * m).sum()], [(s * m).sum(), s.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(b)


def _bar(value: np.ndarray, held: list[np.ndarray], n: list[int], ratio: float = 20.0) -> float:
    """Lowest value above which words are ``ratio`` times as frequent in toxic texts as in clean ones."""
    order = np.argsort(-value, kind="stable")
    t, c = np.cumsum(held[1][order]) / n[1], (np.cumsum(held[0][order]) + 1) / n[0]
    good = np.flatnonzero(t >= ratio * c)
    return float(value[order[good[-1]]]) if len(good) else float(value.max())


def _most(at: np.ndarray, count: np.ndarray) -> np.ndarray:
    return at[np.argsort(-count[at], kind="stable")]


def _distinct(texts: list[str], toxic: np.ndarray, words: int = 5, similarity: float = 0.8) -> list[int]:
    """Positions without near copies of earlier texts of the label.

    Texts with a common minimum of hashed shingles are candidates; a text goes only where the Jaccard
    similarity of its shingles with a kept one's reaches ``similarity``.
    """
    holders: dict[tuple[int, int, int], list[int]] = {}
    shingles: dict[int, np.ndarray] = {}
    for i, (t, k) in enumerate(zip(texts, toxic)):
        w = t.lower().split()
        h = np.unique(np.array([zlib.crc32(" ".join(w[j:j + words]).encode()) for j in range(max(1, len(w) - words + 1))], np.uint32))
        marks = [(int(k), a, int((h * np.uint64(a) & np.uint64(0xFFFFFFFF)).min())) for a in (1, 2654435761, 40503001, 97643519)]
        for j in {j for m in marks for j in holders.get(m, ())}:
            both = len(np.intersect1d(h, shingles[j], assume_unique=True))
            if both >= similarity * (len(h) + len(shingles[j]) - both):
                break
        else:
            shingles[i] = h
            for m in marks:
                holders.setdefault(m, []).append(i)
    return list(shingles)


def train(texts: list[str], toxic: np.ndarray, landmarks: int = 300, rounds: int = 4, seed: int = 5,
          totals: tuple[int, int] | None = None) -> Model:
    """Fit on labelled texts (a bounded sample); ``totals``: the rows of label 0 and 1 that they stand for."""
    toxic = np.asarray(toxic, np.int64)
    if len(texts) == 0 or toxic.min() == toxic.max():
        return Model(None, 0, 0, 0, flat=float(toxic.mean()) if len(texts) else 0.0)
    own = _distinct(texts, toxic)
    texts, toxic = [texts[i] for i in own], toxic[own]
    stands = np.ones(2) if totals is None else np.array(totals) / np.maximum(np.bincount(toxic, minlength=2), 1)
    rng = np.random.default_rng(seed)
    part = np.ones(len(texts), bool)
    if min(np.bincount(toxic)) >= 40:
        part[::2] = False
        for k in (0, 1):  # a half of each label for the SVM, the other for the logistic
            at = np.flatnonzero(toxic == k)
            part[at] = np.arange(len(at)) % 2 == 0
    # distinct words of the labelled sentences, the texts that hold them, and texts of each label by subsequence
    names: dict[bytes, int] = {}
    count = [np.zeros(CLASSES ** 3, np.int64) for _ in (0, 1)]
    pairs = []
    for i in np.flatnonzero(part):
        codes, starts, _ = encode_words(SENTENCE.findall(texts[i]))
        if len(starts):
            raw, ends = codes.tobytes(), np.append(starts[1:], len(codes) - SPAN).tolist()
            own = np.unique([names.setdefault(raw[a + 1:b], len(names)) for a, b in zip(starts.tolist(), ends)])
            pairs.append((own.astype(np.int32), np.full(len(own), toxic[i], np.int8)))
            count[toxic[i]][np.unique(np.concatenate([ids[inside] for _, inside, ids in _grams(codes)]))] += 1
    n = [max(1, int(np.sum((toxic == k) & part))) for k in (0, 1)]
    if not names:
        return Model(None, 0, 0, 0, flat=float(toxic.mean()))
    word, label = (np.concatenate(x) for x in zip(*pairs))
    held = [np.bincount(word[label == k], minlength=len(names)) for k in (0, 1)]
    words = list(names)
    # how far a subsequence's share of the toxic texts lies above that of the clean ones, in standard errors
    both = (count[0] + count[1] + 1) / (n[0] + n[1] + 2)
    z = (count[1] / n[1] - count[0] / n[0]) / np.sqrt(both * (1 - np.minimum(both, 0.999)) * (1 / n[0] + 1 / n[1]))
    weight = np.sign(z) * np.maximum(np.abs(z) - 2, 0)
    value = _values(words, weight)
    telling = (held[1] > 0) & (held[1] * n[0] >= 10 * held[0] * n[1])
    clean = np.flatnonzero(held[0] > 0)
    # so many toxic texts and no clean one are no chance
    enough = max(2.0, np.log(1e-5) / np.log(n[1] / (n[0] + n[1])))
    other = rng.choice(clean, min(8000, len(clean)), replace=False)
    bias, hard, first = 0.0, np.zeros(0, np.int64), np.zeros(len(words), bool)
    for step in range(rounds):
        if step == 0:
            carries = (value > _bar(value, held, n)) & (held[1] >= n[1] / 500) | (held[1] >= enough) & (
                (held[0] == 0) | (value > np.quantile(value[clean], 0.99)))
        else:
            carries = first | (held[1] >= enough) & (value > 0)
        first = carries & telling
        if not first.any():
            first[np.argsort(-np.where(telling, value, -np.inf))[:50]] = True
        pos = _most(np.flatnonzero(first), held[1])[:6000]
        # clean words closest to the label-carrying ones join those of the rounds before
        near = clean[np.argsort(-value[clean])[:3000]]
        hard = np.union1d(hard, near)
        neg = np.setdiff1d(np.union1d(hard, other), pos)
        if not len(neg):
            break
        land = [*pos[:landmarks // 2], *np.setdiff1d(_most(near, held[0]), pos)[:landmarks // 4]]
        land += [w for w in rng.permutation(neg) if w not in set(land)][:landmarks - len(land)]
        of = lambda at: [words[i] for i in at]
        weight, bias = _nystroem(of(pos), np.sqrt(held[1][pos].astype(np.float64)), of(neg), of(land))
        value = _values(words, weight) + bias
    model = Model(weight, bias, 1.0, 0.0)
    rest = np.flatnonzero(~part) if not part.all() else np.arange(len(texts))
    m = np.concatenate([model.margins([texts[i] for i in rest[k:k + 100]]) for k in range(0, len(rest), 100)])
    use = np.isfinite(m)
    model.slope, model.shift = _logistic(m[use], toxic[rest][use], stands[toxic[rest][use]])
    return model


def _laid_out(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, starts) of words given as classes, as encode_words lays them out."""
    codes = np.frombuffer(b"".join(b"\0" + w for w in words) + b"\0" * SPAN, np.uint8)
    return codes, np.flatnonzero(codes[:len(codes) - SPAN] == 0)


def _values(words: list[bytes], weight: np.ndarray, block: int = 50_000) -> np.ndarray:
    return np.concatenate([word_values(*_laid_out(words[i:i + block]), weight) for i in range(0, len(words), block)])


def _embed(words: list[bytes], seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(normalised feature vectors, subsequences they stand for); with ``seen``, of those subsequences alone."""
    codes, starts = _laid_out(words)
    size = _sizes(codes, starts)
    row = np.repeat(np.arange(len(words)), size + 1)
    used = [(w, row[inside], ids[inside]) for w, inside, ids in _grams(codes)]
    if seen is None:
        seen = np.unique(np.concatenate([ids for _, _, ids in used]))
    out = np.zeros((len(words), len(seen)), np.float32)
    for w, r, ids in used:
        at = np.minimum(np.searchsorted(seen, ids), len(seen) - 1)
        known = seen[at] == ids
        np.add.at(out, (r[known], at[known]), np.float32(w))
    return out / _self(size)[:, None].astype(np.float32), seen


def _nystroem(pos: list[bytes], times: np.ndarray, neg: list[bytes], z: list[bytes]) -> tuple[np.ndarray, float]:
    """SVM on k(x, Z) K(Z, Z)^-1/2, folded back into one weight for each subsequence."""
    land, seen = _embed(z)
    kzz = (land @ land.T).astype(np.float64)
    val, vec = np.linalg.eigh(kzz)
    root = vec * np.where(val > 1e-6 * val.max(), 1 / np.sqrt(np.maximum(val, 1e-12)), 0)  # K^-1/2 up to rotation
    feats = []
    for group in (pos, neg):
        rows = []
        for i in range(0, len(group), 500):
            rows.append(_embed(group[i:i + 500], seen)[0] @ land.T)
        feats.append(np.vstack(rows).astype(np.float64) @ root)
    x = np.vstack(feats)
    y = np.concatenate((np.ones(len(pos)), -np.ones(len(neg))))
    # words carried by many texts cost more; the label-carrying words together as much as the others
    cost = 5.0 * np.concatenate((times * max(1.0, len(neg) / times.sum()), np.ones(len(neg))))
    w, bias = _svm(x, y, cost)
    weight = np.zeros(CLASSES ** 3)
    weight[seen] = (root @ w) @ land
    return weight, bias


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 5000, max_chars: int = 20_000) -> Model:
    """Learn from the texts that ``labels`` marks (toxic 0 or 1); a bounded sample, see the parameters."""
    marked = labels.filter("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    rows = docs.filter(F.char_length("text") <= max_chars).select("doc_id").join(marked, "doc_id")
    sample, counts = sample_per_class(rows, "toxic", per_class)
    # the sampled ids are bounded by the parameter; texts are fetched for them alone, without a shuffle
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"]) for r in sample], "doc_id long, toxic int")
    picked = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").orderBy("doc_id").collect()
    return train([r["text"] for r in picked], np.array([r["toxic"] for r in picked], np.int64),
                 totals=(counts.get(0, 0), counts.get(1, 0)))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``docs`` plus score and predicted, from the text column alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    def run(part, column):
        s = shared.value.scores(column.to_pylist())
        return [pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))]

    return map_slices(docs, run, StructType().add("score", "double").add("predicted", "integer"), SLICE)
