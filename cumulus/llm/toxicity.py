"""Toxicity by a subsequence string-kernel support vector machine.

Kernel. Two strings are compared by their common subsequences of three
characters within a window of six; a subsequence that spans s characters
weighs DECAY ** (s - 3), and the kernel is normalised to 1 for equal
strings. So "idxiot", "id-iot" and "i d i o t" stay close to "idiot".
Strings are the words of a sentence with their ends marked; digits and signs
that stand for letters are read as these, other signs inside a word are
dropped, a run of four or more single characters is read as one word, and so
are two neighbours, unless both are words of clean documents ("id iot").

Model. Nyström: the kernel to a fixed number of landmark words, whitened by
the landmarks' own kernel matrix, gives the features of a linear SVM with
squared hinge loss. A sentence is toxic if one of its words is (the witness),
so sentences of toxic documents name their witness by the current model
and clean sentences give the negatives, joined neighbours included, hardest
first, in several rounds. A witness is a word whose toxic documents are too
many for chance, given how many words could have been. As the kernel is a dot product over gapped
trigrams, the trained machine folds into one weight per trigram, and a word
is scored without visiting the landmarks.

A document's probability comes from a logistic fit on its three highest
sentence margins. Only the bounded sample of labelled rows used for the
fit is gathered; scoring covers every word of every text.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nlargest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPAN = 6
COMMON = 0.05  # share of toxic documents from which a witness is also learnt with a character put in
DECAY = 0.7
JOINED = 14  # characters of a word that a blank may split
PIECE = 64  # longer words are scored in overlapping pieces of this length
CACHE = 300_000  # words whose scores a worker remembers
BLOCK = 4000  # words scored together
DOCS = 256  # texts scored together
MAX_LABELLED = 3000  # bound of the labelled sample: rows with the smallest hash of their id
FAVOUR = 4  # weight of all witnesses against that of all negatives: joined parts make negatives many
LANDMARKS = 256
NEGATIVES = 4000
THRESHOLD = 0.3
SURE = 3.0  # log-odds from which a word of several toxic documents may witness for them
CHANCE = 1.0  # words that chance alone may make witnesses: bound of their expected number
FLOOR = -1.5  # margin of a text without words

#: Signs read as letters.
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"})
SPACED = re.compile(r"(?<!\S)\w(?:[^\S\n]+\w(?!\S)){3,}")
SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n+")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def normal(word: str) -> str:
    """A lower-case word as the kernel sees it; may be empty."""
    w = word.strip(_EDGE)
    if w.isalpha():
        return w
    return "".join(filter(str.isalpha, w.translate(SIGNS)))


def tokens(text: str, known: frozenset[str] | None = None) -> set[str]:
    """Distinct raw lower-case words of a text or sentence, spaced-out words joined.

    With ``known``, also the words that a single blank may have split.
    """
    low = text.lower()
    found = set(low.split())
    if known is not None:
        found |= joined(low, known)
    for m in SPACED.finditer(low):
        found.add("".join(m.group().split()))
    return found


def pieces(word: str) -> list[str]:
    """Overlapping pieces of a long word; the word itself if it is short."""
    return [word[at:at + PIECE] for at in range(0, max(1, len(word) - 8), PIECE - 8)]


def joined(text: str, known: frozenset[str]) -> set[str]:
    """Neighbouring parts of a lower-case sentence read as one word, unless both are ``known`` words.

    So "id iot" stays close to "idiot", whereas prose isn't read twice.
    Signs between two parts hold them apart.
    """
    words = text.split()
    fit = [1 < len(w) < JOINED - 1 for w in words]
    new = [w not in known for w in words]
    return {a + b for a, b, f, g, x, y in zip(words, words[1:], fit, fit[1:], new, new[1:])
            if f and g and (x or y) and len(a) + len(b) <= JOINED and a[-1].isalnum() and b[0].isalnum()}


def _codes(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    return np.where((c >= 97) & (c <= 122), c - 96, np.where(c == 94, 27, np.where(c == 36, 28, 29 + c % 35)))


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Marked words as one row of characters: (word position, code, characters from here to the word's end), and lengths."""
    marked = [f"^{w}$" if w else "" for w in words]
    n = np.fromiter(map(len, marked), np.int64, len(marked))
    code = _codes("".join(marked))
    return np.repeat(np.arange(len(words)), n), code, np.repeat(np.cumsum(n), n) - np.arange(len(code)), n


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised gapped trigrams: (word position, trigram, value), sorted by word."""
    own, code, left, _ = _letters(words)
    keys, values = [np.empty(0, np.int64)], [np.empty(0)]
    for b in range(2, SPAN):
        at = np.flatnonzero(left > b)
        for a in range(1, b):
            keys.append(own[at] << 18 | code[at] << 12 | code[at + a] << 6 | code[at + b])
            values.append(np.full(len(at), DECAY ** (b - 2)))
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    value = np.bincount(back, np.concatenate(values), len(key))
    own, gram = key >> 18, key & 0x3FFFF
    norm = np.sqrt(np.bincount(own, value ** 2, len(words)))
    return own, gram, value / norm[own]


@dataclass
class Model:
    weights: np.ndarray  # one per gapped trigram
    bias: float
    top: np.ndarray  # logistic weights of the three highest margins, and the intercept
    known: frozenset[str] = frozenset()  # words of several clean documents, which are no parts of a split word

    def margins(self, words: list[str]) -> np.ndarray:
        """SVM margin of each normal word."""
        parts, owner = [], []
        for i, w in enumerate(words):
            for part in pieces(w):
                parts.append(part)
                owner.append(i)
        out = np.full(len(words), FLOOR)
        own, gram, value = trigrams(parts)
        f = np.bincount(own, value * self.weights[gram], len(parts)) + self.bias
        f[np.fromiter(map(len, parts), np.int64, len(parts)) == 0] = FLOOR
        np.maximum.at(out, np.array(owner, np.int64), f)
        return out

    def positive(self, words: list[str]) -> dict[str, float]:
        """Margins of the short normal words whose margin is positive.

        Occurrences not yet summed per trigram give a norm that is too small
        and so a bound that is too high; only words that pass it are sorted out.
        """
        own, code, left, n = _letters(words)
        dot, low = np.zeros(len(words)), np.zeros(len(words))
        for b in range(2, SPAN):
            at = np.flatnonzero(left > b)
            ends = code[at] << 12 | code[at + b]
            sums = sum(self.weights[ends | code[at + a] << 6] for a in range(1, b))
            dot += DECAY ** (b - 2) * np.bincount(own[at], sums, len(words))
            low += DECAY ** (2 * b - 4) * (b - 1) * np.maximum(n - b, 0)
        bound = dot / np.sqrt(np.maximum(low, 1e-9)) + self.bias
        likely = [words[i] for i in np.flatnonzero(bound > -1e-6)]
        return {w: m for w, m in zip(likely, self.margins(likely).tolist()) if m > 0} if likely else {}

    def probability(self, tops: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(tops @ self.top[:3] + self.top[3], -30, 30)))


class Scorer:
    """Scores texts with a bounded memory of words already seen."""

    def __init__(self, model: Model):
        self.model, self.seen, self.known = model, {}, {}

    def tops(self, texts: list[str]) -> np.ndarray:
        """The three highest word margins of each text."""
        sets = [tokens(t) for t in texts]
        if len(self.seen) > CACHE:  # raw words, and normal words below
            self.seen.clear()
            self.known.clear()
        seen, known = self.seen, self.known
        new = {w: normal(w) for s in sets for w in s if w not in seen}
        missing = list({n for n in new.values() if n not in known})
        for at in range(0, len(missing), BLOCK):
            part = missing[at:at + BLOCK]
            known.update(zip(part, self.model.margins(part).tolist()))
        seen.update((w, known[n]) for w, n in new.items())
        # neighbours read as one word count where they are toxic; they are rarely the same, so none is remembered
        pairs = [joined(t.lower(), self.model.known) for t in texts]
        each = {w: normal(w) for p in pairs for w in p}
        forms, toxic = list(set(each.values())), {}
        for at in range(0, len(forms), BLOCK):
            toxic.update(self.model.positive(forms[at:at + BLOCK]))
        tops = np.full((len(texts), 3), FLOOR)
        for i, s in enumerate(sets):
            best = nlargest(3, [*map(seen.__getitem__, s), *(toxic[each[w]] for w in pairs[i] if each[w] in toxic)])
            if best and best[0] > 0 and (len(best) < 2 or best[1] < 0):  # one toxic word: it may repeat
                word = max(s, key=seen.__getitem__)
                often = texts[i].lower().count(word) if seen[word] == best[0] else 1
                best = sorted([best[0]] * min(3, max(1, often)) + best[1:], reverse=True)[:3]
            tops[i, :len(best)] = best
        return np.minimum(tops, 3.)  # so that no single word decides by how far it lies beyond the margin

    def __call__(self, texts: list[str]) -> np.ndarray:
        return self.model.probability(self.tops(texts))


# ---------------------------------------------------------------- training


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Squared-hinge SVM in the primal by Newton steps."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w, eye = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    eye[-1, -1] = 1e-6
    for _ in range(30):
        sv = y * (x @ w) < 1
        a = x[sv] * weight[sv, None]
        new = np.linalg.solve(eye + a.T @ x[sv], a.T @ y[sv])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + (ridge + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _nystrom(landmarks: list[str], words: list[str], y: np.ndarray, weight: np.ndarray,
             ridge: float) -> tuple[np.ndarray, float]:
    """Folded trigram weights and bias of the SVM on Nyström features."""
    own, gram, value = trigrams(landmarks)
    used, col = np.unique(gram, return_inverse=True)
    phi = np.zeros((len(landmarks), len(used)))
    phi[own, col] = value
    lam, vec = np.linalg.eigh(phi @ phi.T)
    keep = lam > 1e-8 * lam.max()
    half = vec[:, keep] / np.sqrt(lam[keep])
    column = np.full(1 << 18, -1, np.int64)
    column[used] = np.arange(len(used))
    z = np.zeros((len(words), int(keep.sum())))
    for at in range(0, len(words), 500):
        own, gram, value = trigrams(words[at:at + 500])
        c = column[gram]
        x = np.zeros((len(words[at:at + 500]), len(used)))
        x[own[c >= 0], c[c >= 0]] = value[c >= 0]
        z[at:at + 500] = x @ phi.T @ half
    beta, bias = _svm(z, y, weight, ridge)
    weights = np.zeros(1 << 18)
    weights[used] = phi.T @ (half @ beta)
    return weights, bias


def _sure(df: list[Counter], nt: int, nc: int) -> dict[str, float]:
    """Words of high log-odds whose toxic documents are too many for chance, and how likely chance is.

    By chance a word of n documents has a or more toxic ones with the
    binomial tail at ``share``; times the words of n or more documents this
    bounds how many such words chance would make.
    """
    total = Counter(df[0][w] + df[1][w] for w in {*df[0], *df[1]})
    share = nt / (nt + nc)
    upto, rarer = 0, {}
    for n in sorted(total, reverse=True):
        upto += total[n]
        rarer[n] = upto
    out, tails = {}, {}
    for w, a in df[1].items():
        n = a + df[0][w]
        if a < 2 or math.log((a + .5) / nt) - math.log((df[0][w] + .5) / nc) <= SURE:
            continue
        if (a, n) not in tails:
            tails[a, n] = sum(math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                                       + k * math.log(share) + (n - k) * math.log1p(-share)) for k in range(a, n + 1))
        if tails[a, n] * rarer[n] < CHANCE:
            out[w] = tails[a, n]
    return out


def fit(texts: list[str], labels: list[int], rounds: int = 4, ridge: float = 0.004) -> Model | None:
    """Model from labelled texts; None without both labels or
    without a word that tells them apart. Same rows, same model."""
    toxic = np.array(labels, bool)
    if toxic.all() or not toxic.any():
        return None
    sentences = [SENTENCE.split(t) for t in texts]
    plain = Counter(w for found, t in zip(sentences, toxic) if not t for w in {w for x in found for w in x.lower().split()})
    known = frozenset(w for w, n in plain.items() if n > 1)
    bags: list[list[str]] = []  # a document's normal words and joined parts, sentence by sentence
    for found in sentences:
        bag = {part for x in found for w in tokens(x, known) for part in pieces(normal(w))}
        bag.discard("")
        bags.append(sorted(map(sys.intern, bag)))
    df = [Counter(), Counter()]
    for bag, t in zip(bags, toxic):
        df[int(t)].update(bag)
    nt, nc = toxic.sum() + 1, (~toxic).sum() + 1
    whole = {part for found in sentences for x in found for w in tokens(x) for part in pieces(normal(w))}
    sure = {w: p for w, p in _sure(df, nt, nc).items() if w in whole}  # joined parts give negatives only
    clean = sorted(df[0], key=lambda w: (-df[0][w], w))
    step = max(1, len(clean) // NEGATIVES)
    base = clean[:NEGATIVES // 4] + clean[NEGATIVES // 4::step]
    every = sorted({*df[0], *df[1]})
    place = {w: i for i, w in enumerate(every)}
    f = None
    model = None
    hard: Counter = Counter()
    for _ in range(rounds):
        positive: Counter = Counter()
        for bag, t in zip(bags, toxic):
            if not bag:
                continue
            if f is None:
                if t:
                    positive.update(nlargest(3, sure.keys() & set(bag), key=lambda w: (-sure[w], w)))
            elif t:
                best = nlargest(5, bag, key=lambda w: f[place[w]])
                positive.update(w for w in best if f[place[w]] > 0 and w in sure)
            else:
                hard.update(w for w in nlargest(4, bag, key=lambda w: f[place[w]]) if f[place[w]] > -1)
        for w in [w for w in positive if df[1][w] >= COMMON * nt and len(w) >= 4]:
            for i in range(1, len(w)):  # the same insult with one character put in
                for step in (7, 12):
                    positive.setdefault(w[:i] + chr(97 + (step * i + len(w)) % 26) + w[i:], positive[w] // len(w))
        negative = sorted(({*base} | {*hard}) - {*positive})
        pos = sorted(positive)
        if not pos:
            return None
        words = pos + negative
        y = np.array([1.] * len(pos) + [-1.] * len(negative))
        weight = np.array([float(np.sqrt(positive[w])) for w in pos] + [1. + hard[w] ** .5 for w in negative])
        weight[:len(pos)] *= FAVOUR * weight[len(pos):].sum() / weight[:len(pos)].sum()
        lead = [w for w, _ in sorted(positive.items(), key=lambda x: (-x[1], x[0]))][:LANDMARKS * 2 // 3]
        landmarks = lead + negative[::max(1, len(negative) // (LANDMARKS - len(lead)))][:LANDMARKS - len(lead)]
        weights, bias = _nystrom(landmarks, words, y, weight / weight.mean(), ridge)
        model = Model(weights, bias, np.zeros(4), known)
        f = np.concatenate([model.margins(every[at:at + BLOCK]) for at in range(0, len(every), BLOCK)])
    score = Scorer(model)
    tops = np.vstack([score.tops(texts[at:at + DOCS]) for at in range(0, len(texts), DOCS)])
    alone = tops[toxic & (tops[:, 0] > 1)] * [1, 0, 0] + [0, FLOOR, FLOOR]  # one clear witness is enough
    tops, toxic = np.vstack([tops, alone]), np.concatenate([toxic, np.ones(len(alone), bool)])
    use = np.ones(3, bool)  # a higher margin never lowers the probability
    while (top := _logistic(tops * use, toxic.astype(float)))[:3].min() < -1e-9:
        use &= top[:3] > 0
    model.top = top
    model.weights = model.weights.astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, usable, max_labelled: int = MAX_LABELLED) -> Model | None:
    """Fit on at most ``max_labelled`` labelled rows for which ``usable`` holds (smallest hash of doc_id first)."""
    rows = (labels.filter(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
            .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
            .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_labelled))
    got = (rows.join(docs.select("doc_id", "text"), "doc_id").filter("text is not null")
           .select("doc_id", "toxic", "text").toLocalIterator())
    got = sorted((r["doc_id"], r["toxic"], r["text"]) for r in got)
    return fit([t for _, _, t in got], [int(x > 0) for _, x, _ in got])


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` as (doc_id, score, predicted), one row for each of its rows.

    Null and empty texts score as a text without toxic words; without a
    model (no labelled rows, or of one label only) every score is 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for b in batches:
            for at in range(0, b.num_rows, DOCS):
                part = b.slice(at, DOCS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                p = scorer(texts) if scorer else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(p, pa.float64()),
                     pa.array((p >= threshold).astype(np.int32), pa.int32())], ["doc_id", "score", "predicted"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` below ``threshold``, with all their columns (whatever their names)."""
    schema, place = docs.schema, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for b in batches:
            for at in range(0, b.num_rows, DOCS):
                part = b.slice(at, DOCS)
                p = scorer([t or "" for t in part.column(place).to_pylist()]) if scorer else np.zeros(part.num_rows)
                yield part.filter(pa.array(p < threshold))
    return docs.mapInArrow(run, schema)
