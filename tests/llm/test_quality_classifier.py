"""Context vectors against a plain loop, the classifier by held-out accuracy."""

import random

import numpy as np

from cumulus.llm import quality_classifier as C
from tests.llm.conftest import DOCS, prose


def plain_contexts(texts):
    places, signs = C.index_vectors()
    index = np.zeros((C.BUCKETS, C.DIM))
    for b in range(C.BUCKETS):
        index[b, places[b]] = signs[b]
    out, of = np.zeros((C.BUCKETS, C.DIM)), C.Buckets()
    for t in texts:
        ids = of.of(t or "")
        for i, b in enumerate(ids):
            for j in range(max(0, i - C.WINDOW), min(len(ids), i + C.WINDOW + 1)):
                if j != i:
                    out[b] += index[ids[j]]
    return out


def test_contexts_match_plain_loop(spark):
    rng = random.Random(1)
    texts = [prose(rng, 50), "a a a b ### !! 12", None, "", "x"] * 3
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    keep, C.CHUNK = C.CHUNK, 16
    try:  # chunks smaller than a text
        rows = docs.coalesce(1)
        got = C.contexts(rows)
    finally:
        C.CHUNK = keep
    assert (got == plain_contexts(texts)).all()
    assert (C.contexts(docs.repartition(4)) == got).all()


def test_chunked_pooling():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(C.BUCKETS, C.DIM)).astype(np.float32)
    ids = rng.integers(1, C.BUCKETS, 1000).tolist()
    whole = C.pooled(ids, v)
    keep, C.CHUNK = C.CHUNK, 7
    try:
        assert np.allclose(C.pooled(ids, v), whole)
    finally:
        C.CHUNK = keep
    x = v[ids].astype(float)
    assert np.allclose(whole[:C.DIM], x.mean(0)) and np.allclose(whole[C.DIM:2 * C.DIM], x.std(0))


def sample(rng, n):
    rows = []
    for i in range(n):
        words = prose(rng, rng.randint(30, 150)).split()
        kind = i % 9
        if kind == 0:
            words = [w + rng.choice(["###", "%%%"]) for w in words]
        elif kind == 1:
            words = [w for w in words[:12] for _ in range(12)]
        rows.append((i, " ".join(words), int(kind > 1)))
    return rows


def test_held_out(spark, edge, empty, clashing):
    from pyspark.sql import functions as F
    rows = sample(random.Random(2), 1500)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    vectors = C.scaled(C.contexts(docs))
    net = C.train(docs, labels, vectors, F.col("doc_id") % 4 != 0)
    assert net.temperature > 0
    out = {r["doc_id"]: r for r in C.score(docs, vectors, net).collect()}
    held = [(out[i]["predicted"], y) for i, _, y in rows if i % 4 == 0]
    assert np.mean([p == y for p, y in held]) > 0.95
    flipped = labels.withColumn("quality", F.when(F.col("doc_id") % 4 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (C.train(docs, flipped, vectors, F.col("doc_id") % 4 != 0).w1 == net.w1).all()
    scored = C.score(edge, vectors, net).collect()
    assert len(scored) == edge.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert sorted(C.score(clashing, vectors, net).collect(), key=repr) == sorted(scored, key=repr)
    assert C.score(empty, vectors, net).count() == 0 and not C.contexts(empty).any()
    assert C.train(docs, labels.limit(0), vectors, F.lit(True)) == 0.5
    assert {r["score"] for r in C.score(edge, vectors, 0.5).collect()} == {0.5}
