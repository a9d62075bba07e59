"""Kernel against its definition, the classifier by held-out accuracy."""

import random
from itertools import combinations

import numpy as np
import pytest

from cumulus.llm import toxicity as X
from tests.llm.conftest import DOCS, prose

INSULTS = ["idiot", "moron", "worthless", "disgusting", "pathetic"]


def plain_kernel(a, b):
    def phi(w):
        w, f = f"^{w}$", {}
        for i, j, k in combinations(range(len(w)), 3):
            if k - i < X.SPAN:
                f[w[i] + w[j] + w[k]] = f.get(w[i] + w[j] + w[k], 0) + X.DECAY ** (k - i - 2)
        return f
    fa, fb = phi(a), phi(b)
    dot = sum(v * fb.get(k, 0) for k, v in fa.items())
    return dot / np.sqrt(sum(v * v for v in fa.values()) * sum(v * v for v in fb.values()))


def test_trigrams_give_the_subsequence_kernel():
    words = ["idiot", "idxiot", "moron", "a", "table", "aaaa"]
    own, gram, value = X.trigrams(words)
    phi = np.zeros((len(words), 1 << 18))
    phi[own, gram] = value
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert abs(phi[i] @ phi[j] - plain_kernel(a, b)) < 1e-9


def sample(rng, n):
    out = []
    for i in range(n):
        words = prose(rng, rng.randint(20, 120)).split()
        if i % 5 == 0:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        out.append((" ".join(words), int(i % 5 == 0)))
    return out


@pytest.fixture(scope="module")
def model():
    rows = sample(random.Random(1), 1200)
    return X.fit([t for t, _ in rows], [y for _, y in rows])


def test_held_out(model):
    rows = sample(random.Random(2), 400)
    p = X.Scorer(model)([t for t, _ in rows])
    y = np.array([y for _, y in rows])
    assert ((p >= X.THRESHOLD) == y).mean() > 0.97


def test_gapped_and_inserted_insults(model):
    rng = random.Random(3)
    clean = prose(rng, 60)
    s = X.Scorer(model)
    for insult in ("idiot", "i d i o t", "m.o.r.o.n", "mor0n", "worxthless", "dis-gusting", "pathhetic"):
        assert s([f"{clean} {insult} {clean}"])[0] >= X.THRESHOLD, insult
    assert s([clean])[0] < X.THRESHOLD


def test_split_insults(model):
    rng = random.Random(8)
    s = X.Scorer(model)
    for insult in ("id iot", "mo ron", "wort hless", "path etic", "disg usting"):
        for _ in range(5):
            before, after = prose(rng, 40).rstrip("."), prose(rng, 40)
            assert s([f"{before} {insult} {after}"])[0] >= X.THRESHOLD, insult
    clean = s([prose(rng, 80) for _ in range(200)])
    assert (clean >= X.THRESHOLD).mean() <= 0.01


def test_neighbours_are_joined_unless_both_are_known():
    known = frozenset({"the", "of"})
    assert X.joined("the of id iot, the x end", known) == {"ofid", "idiot,"}
    assert X.joined("averyveryvery longword", frozenset()) == set() == X.joined("", known)


def test_positive_margins_are_those_of_margins(model):
    rng = random.Random(11)
    words = [*INSULTS, "idxiot", "", "a", "aaaaaaaa", *{w.strip(".").lower() for w in prose(rng, 3000).split()}]
    words += [w[:i] + c + w[i:] for w in INSULTS for i in range(1, len(w)) for c in "aqz"]
    want = {w: m for w, m in zip(words, model.margins(words).tolist()) if m > 0}
    got = model.positive(words)
    assert got.keys() == want.keys() and len(got) > 5
    assert all(abs(got[w] - want[w]) < 1e-9 for w in got)


def test_witnesses_exceed_chance():
    from collections import Counter
    clean, toxic = Counter({f"w{i}": 3 for i in range(500)}), Counter({"bad": 20, "w1": 2, "once": 1})
    toxic.update({f"pair{i}": 2 for i in range(300)})  # two documents each: as chance would have it
    assert set(X._sure([clean, toxic], 101, 901)) == {"bad"}


def test_long_words_are_learnt_whole():
    rng = random.Random(9)
    rows = [(prose(rng, 30) + (" " + "".join(rng.choices("anerth", k=90)) + "idiot" if i % 4 == 0 else ""), int(i % 4 == 0))
            for i in range(400)]
    m = X.fit([t for t, _ in rows], [y for _, y in rows])
    assert X.pieces("a" * 200)[-1][-1] == "a" and "".join(X.pieces("abc")) == "abc" and X.pieces("") == [""]
    assert m is None or X.Scorer(m)([prose(rng, 30)])[0] < X.THRESHOLD


def test_long_text_scores_like_its_words(model):
    rng = random.Random(4)
    text = prose(rng, 20_000)
    s = X.Scorer(model)
    assert s([text])[0] < X.THRESHOLD <= s([text + " you pathetic idiot"])[0]
    assert s(["x" * 100_000])[0] < X.THRESHOLD


def test_edges(spark, model, edge, empty, clashing):
    out = X.score(edge, model).collect()
    assert len(out) == edge.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= .3) for r in out)
    assert all(r["score"] == 0 for r in X.score(edge, None).collect())
    assert X.score(empty, model).count() == 0
    kept = X.keep_clean(clashing, model)
    assert kept.columns == clashing.columns and kept.count() == sum(r["predicted"] == 0 for r in out)
    assert X.fit(["a"], [1]) is None


def test_training_ignores_the_held_out_rows(spark):
    from pyspark.sql import functions as F
    rows = sample(random.Random(5), 300)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, (t, _) in enumerate(rows)], DOCS)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    usable = F.col("doc_id") % 3 != 0
    flipped = labels.withColumn("toxic", F.when(~usable, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = X.train(docs, labels, usable), X.train(docs, flipped, usable)
    assert (a.weights == b.weights).all() and (a.top == b.top).all()
    assert X.train(docs, labels.limit(0), usable) is None
