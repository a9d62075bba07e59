"""Base counts against a plain form, MCD against numpy on one group."""

import random
import re

import numpy as np

from cumulus.llm import quality_rules as Q
from tests.llm.conftest import DOCS, prose


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit.update(range(i, i + 5))
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)]


def test_counts_match_plain_form():
    rng = random.Random(2)
    texts = [None, "", "a", "a b c d e a b c d e", "x\nx\n\n\n  \nx", "é\x0b\x0c # $$ <b>|", "a a a a a a a"]
    texts += [" ".join(rng.choices("abc", k=60)) for _ in range(20)] + [prose(rng, 200)]
    for t in texts:
        assert Q.counts(t)[0] == plain(t), t


def test_many_different_words_still_exact():
    words = [f"w{i}".encode() for i in range(9000)]
    assert Q.repeated_words(words + words[:7]) == 14
    assert Q.repeated_words(words) == 0


def test_chi_square():
    assert abs(Q.chi2_quantile(0.95, 6) - 12.5916) < 1e-3 and abs(Q.chi2_quantile(0.5, 1) - 0.4549) < 1e-3
    assert abs(Q.chi2_cdf(12.5916, 6) - 0.95) < 1e-5


def fixture(rng, n=400):
    rows = []
    for i in range(n):
        t = prose(rng, rng.randint(60, 300))
        if i % 8 == 0:
            t = " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in t.split())
        rows.append((i, t, "en", "hot" if i % 3 else "other", None))
    return rows


def test_outliers_go_and_prose_stays(spark):
    rows = fixture(random.Random(3))
    out = {r["doc_id"]: r for r in Q.judged(spark.createDataFrame(rows, DOCS), ["doc_id"]).select("row.doc_id", "*").collect()}
    assert len(out) == len(rows)
    assert all(out[i]["kept"] == (i % 8 != 0) for i in range(len(rows)) if not out[i]["base_failed"])


def test_moderate_outliers_of_clean_groups_go(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(100, 300)), "en", f"s{i % 2}", None) for i in range(400)]
    odd = []
    for i in range(4):
        words = prose(rng, 200).split()
        odd.append(" ".join(str(rng.randint(10000, 99999)) if j % 2 else w for j, w in enumerate(words)))
        odd.append(" ".join(w + "#" if j % 3 == 0 else w for j, w in enumerate(words)))
        odd.append(" ".join(words[:181] + words[:19]))  # 19% in repeated windows
    rows += [(1000 + i, t, "en", f"s{i % 2}", None) for i, t in enumerate(odd)]
    out = {r["doc_id"]: r for r in Q.judged(spark.createDataFrame(rows, DOCS), ["doc_id"]).select("row.doc_id", "*").collect()}
    assert not any(out[1000 + i]["base_failed"] or out[1000 + i]["kept"] for i in range(len(odd)))
    assert sum(out[i]["kept"] for i in range(400)) >= 390


def test_small_groups_are_judged_like_large_ones(spark):
    """Twenty rows a group and an outlier in each, a language of one group, and groups without names."""
    rng = random.Random(8)
    rows, odd = [], []
    for g, (lang, source) in enumerate([("en", "a"), ("en", "b"), ("de", "a"), (None, None), (None, "b"), ("en", "c")]):
        for i in range(20):
            rows.append((100 * g + i, prose(rng, rng.randint(100, 300)), lang, source, None))
        words = prose(rng, 200).split()
        odd.append(100 * g + 50)
        rows.append((odd[-1], " ".join(str(rng.randint(10000, 99999)) if j % 2 else w for j, w in enumerate(words)),
                     lang, source, None))
    out = {r["doc_id"]: r for r in Q.judged(spark.createDataFrame(rows, DOCS), ["doc_id"]).select("row.doc_id", "*").collect()}
    assert all(r["distance"] is not None for r in out.values())
    assert not any(out[i]["kept"] for i in odd)
    assert sum(r["kept"] for r in out.values()) >= 118


def test_a_single_row_and_a_single_group(spark):
    rng = random.Random(9)
    one = [(1, prose(rng, 80), "en", "a", None)]
    r = Q.judged(spark.createDataFrame(one, DOCS), ["doc_id"]).first()
    assert r["kept"] and abs(r["distance"]) < 1e-6
    alone = [(i, prose(rng, 100), "en", "a", None) for i in range(15)] + [(99, prose(rng, 100), "xx", "z", None)]
    out = Q.judged(spark.createDataFrame(alone, DOCS), ["doc_id"]).collect()
    assert len(out) == 16 and all(r["kept"] and r["distance"] is not None for r in out)


def test_blend_weighs_by_rows(spark):
    prec = (np.eye(Q.P) / 4).ravel().tolist()
    found = spark.createDataFrame(
        [('["en","a"]', [1.0] * Q.P, prec), ('["en"]', [2.0] * Q.P, np.eye(Q.P).ravel().tolist()),
         (Q.ALL, [4.0] * Q.P, np.eye(Q.P).ravel().tolist())], "gkey string, m array<double>, prec array<double>")
    usable = spark.createDataFrame([('["en","a"]',)] * 30, "key string")
    r = Q.blended(usable, found).collect()
    assert len(r) == 1 and np.allclose(r[0]["m"], 0.5 * 1 + 0.5 * (0.5 * 2 + 0.5 * 4))
    assert np.allclose(np.array(r[0]["prec"]).reshape(Q.P, Q.P), np.eye(Q.P) / (0.5 * 4 + 0.5))


def test_estimate_is_that_of_the_covered_rows(spark):
    """The concentration steps end where numpy's, over the same rows, does (up to the width of a distance bin)."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, Q.P)) @ np.diag(np.linspace(1, 2, Q.P)) + 5
    x[:120] += 25
    rows = spark.createDataFrame([("g", r.tolist()) for r in x], "gkey string, v array<double>")
    e = Q.estimates(rows).first()
    m, prec = np.array(e["m"]), np.array(e["prec"]).reshape(Q.P, Q.P)
    d = np.einsum("ij,jk,ik->i", x - m, prec, x - m)
    assert d[:120].min() > Q.chi2_quantile(Q.LEVEL, Q.P) > np.quantile(d[120:], 0.99)
    assert np.abs(m - x[120:].mean(0)).max() < 0.3


def test_edges(edge, empty, clashing):
    out = Q.judged(edge, ["doc_id"]).collect()
    assert len(out) == edge.count() and all(r["kept"] is not None for r in out)
    for r in edge.collect():
        if r["text"] is None or len(r["text"].split()) < 10:
            assert all(not o["kept"] for o in out if o["row"]["doc_id"] == r["doc_id"] and o["n_words"] < 10)
    assert Q.judged(empty, ["doc_id"]).count() == 0
    good = Q.keep_good(clashing)
    assert good.columns == clashing.columns
    assert sorted((r["doc_id"] for r in good.collect()), key=repr) == sorted(
        (o["row"]["doc_id"] for o in out if o["kept"]), key=repr)
