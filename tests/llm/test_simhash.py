"""SimHash near-duplicates against brute force over all pairs."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from cumulus.llm import simhash as S
from tests.llm.conftest import CLASH, DOCS, prose


def plain_fingerprint(text, k=3):
    words = (text or "").encode().translate(S.LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, bits=2):
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if comp[j] < comp[i] and bin(fps[i] ^ fps[j]).count("1") <= bits:
                    comp[i], changed = comp[j], True
    low = {}
    for c, (d, _) in zip(comp, rows):
        if d is not None:
            low[c] = min(d, low.get(c, d))
    return sorted(((d, f"{f:016x}", low.get(c)) for c, f, (d, _) in zip(comp, fps, rows)), key=repr)


def got(docs):
    out = S.near_duplicates(docs)
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in out.select(
        "doc_id", S.hex_fingerprint("fp").alias("fingerprint"), "component_id").collect()), key=repr)


def test_words_one_bit_apart_share_a_codeword_index():
    w = np.random.default_rng(1).integers(0, 1 << 23, 3000)
    a = S.codeword_indices(w)
    for b in range(23):
        near = S.codeword_indices(w ^ (1 << b))
        assert (a[:, :, None] == near[:, None, :]).any((1, 2)).all()


def test_fingerprints_two_bits_apart_share_a_key():
    f = np.random.default_rng(2).integers(0, 1 << 63, 300, dtype=np.uint64)
    for i in range(64):
        for j in range(i, 64, 7):
            g = f ^ np.uint64(1 << i) ^ np.uint64((1 << j) if j != i else 0)
            one, two = (set(zip(k.tolist(), r.tolist())) for k, r in (S.keys_of(f), S.keys_of(g)))
            assert len({r for _, r in one & two}) == len(f)


def test_dense_lookup_equals_comparison():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 1, dtype=np.uint64)[0]
    fps = np.unique(np.array([base ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j))
                              for i, j in rng.integers(0, 64, (800, 2))] +
                             list(rng.integers(0, 1 << 63, 50, dtype=np.uint64)), np.uint64))
    few = S._forest(fps, 2)
    keep, S.DENSE = S.DENSE, 10
    try:
        assert (S._forest(fps, 2) == few).all()
    finally:
        S.DENSE = keep


def test_components_match_brute_force(spark):
    rng = random.Random(1)
    rows, text = [], [prose(rng, 120) for _ in range(25)]
    for t in text:
        rows.append((len(rows) + 10, t))
        for _ in range(rng.randint(0, 4)):
            words = t.split()
            words[rng.randrange(len(words))] = "changed"
            t = " ".join(words)
            rows.append((len(rows) + 10, t))
    rows += [(3, ""), (4, None), (2, "  "), (1, "one"), (0, "ONE")]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS)
    assert got(docs) == brute(rows)


def test_edges(edge, empty, clashing):
    rows = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    want = brute(rows)
    assert got(edge) == want and got(clashing) == want
    assert got(empty) == []


def test_one_of_each_component_stays(edge, clashing, empty):
    kept = S.keep_one(clashing)
    assert kept.columns == clashing.columns
    ids = [r["doc_id"] for r in kept.collect()]
    found = {r["component_id"] for r in S.near_duplicates(edge).collect()}
    assert sorted(ids, key=repr) == sorted(found, key=repr)
    assert S.keep_one(empty).count() == 0


def test_rows_without_or_with_repeated_ids_keep_their_component(spark):
    rng = random.Random(9)
    a, b, c, d, *clean = [prose(rng, 150) for _ in range(24)]
    rows = [(None, t) for t in clean]  # different texts, no id: all stay
    rows += [(1, a), (None, a), (1, a), (1, b), (2, b), (1, b)]  # id 1 is the smallest of two components
    rows += [(None, c)] * 20 + [(7, d), (None, d)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).repartition(4)
    for docs in (docs, docs.withColumns({n: F.lit(n) for n in CLASH})):
        kept = sorted(((r["doc_id"], r["text"]) for r in S.keep_one(docs).collect()), key=repr)
        assert kept == sorted([(None, t) for t in clean] + [(1, a), (1, b), (None, c), (7, d)], key=repr)


def test_components_of_long_chains_and_stars(spark):
    from cumulus.llm.components import connected_components
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, j) for j in range(6, 90)] + [(7, 7), (None, 1)]
    out = connected_components(spark.createDataFrame(edges, "u long, v long"))
    comp = {r["node"]: r["component"] for r in out.collect()}
    assert comp == {**{i: 100 for i in range(100, 161)}, **{j: 5 for j in range(5, 90)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
