"""PPM language identification: code lengths against a plain form, held-out accuracy, edges."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulus.llm import language_id as L
from cumulus.llm import queries as Q
from tests.conftest import SF_SMALL

from .conftest import DOCS


def plain_bits(training, text):
    """PPM with escape C and exclusion, byte by byte over dictionaries."""
    seen = [{} for _ in range(L.ORDER + 1)]
    for t in training:
        whole = b" " * L.ORDER + L.normalised(t) + b" "
        for i in range(L.ORDER, len(whole)):
            for o in range(L.ORDER + 1):
                seen[o].setdefault(whole[i - o:i], Counter())[whole[i]] += 1
    whole, bits = b" " * L.ORDER + L.normalised(text) + b" ", 0.0
    for i in range(L.ORDER, len(whole)):
        out = set()
        for o in range(L.ORDER, -1, -1):
            after = {b: n for b, n in seen[o].get(whole[i - o:i], {}).items() if b not in out}
            if not after:
                continue
            total = sum(after.values()) + len(after)
            if whole[i] in after:
                bits -= math.log2(after[whole[i]] / total)
                break
            bits -= math.log2(len(after) / total)
            out |= set(after)
        else:
            bits += math.log2(256 - len(out))
    return bits


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(2)
    texts = {"aa": ["".join(rng.choices("abc dé", k=200)) for _ in range(4)], "zz": ["".join(rng.choices("xyz dü!", k=200)) for _ in range(4)]}
    rows = [(i, t, lang, "s", 1) for i, (lang, t) in enumerate((k, t) for k in texts for t in texts[k])]
    return texts, rows, L.train(spark.createDataFrame(rows, DOCS), F.lit(True))


def test_code_lengths_are_those_of_plain_ppm(trained):
    texts, _, model = trained
    assert model.languages == ["aa", "zz"]
    for text in ["abc dé", "zzz", "Quite ANOTHER text 123", "", texts["aa"][0], "日本"]:
        s = L.strings(b" " * L.ORDER + L.normalised(text.encode()) + b" ")
        got = model.lengths(s).sum(1)
        want = [plain_bits([t.encode() for t in texts[k]], text.encode()) for k in model.languages]
        assert np.allclose(got, want, rtol=1e-9), text


def test_every_context_is_a_code(trained):
    for context in (b"abc ", b"    ", b"\xc3\xa9ab", b"qqqq", b"zz\xff\xff"):
        for bits in trained[2].lengths((np.int64(int.from_bytes(context, "big")) << 8) + np.arange(256)):
            assert abs(np.exp2(-bits).sum() - 1) < 1e-9


def test_pruned_trees_stay_codes(spark, trained):
    model = L.train(spark.createDataFrame(trained[1], DOCS), F.lit(True), nodes=120)
    for tree in model.trees:
        assert 0 < sum(len(k) for k, _ in tree.nodes) <= 120
        bits = tree.lengths((np.int64(int.from_bytes(b"ab c", "big")) << 8) + np.arange(256))
        assert abs(np.exp2(-bits).sum() - 1) < 1e-9


def test_pieces_and_memory_change_nothing(trained, monkeypatch):
    import pyarrow as pa
    _, rows, model = trained
    texts = [r[1].encode() for r in rows] + [b"", None, b"abc " * 500]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], names=["row", "text"])
    whole = [b.to_pydict() for b in L._predicted(iter([batch]), model)]
    monkeypatch.setattr(L, "BLOCK", 37)
    monkeypatch.setattr(L, "REMEMBERED", 50)
    monkeypatch.setattr(L.pieces, "__defaults__", (37,))
    cut = [b.to_pydict() for b in L._predicted(iter([batch]), model)]
    assert [x["lang_pred"] for x in whole] == [x["lang_pred"] for x in cut]
    assert np.allclose([x["score"] for x in whole], [x["score"] for x in cut])


def test_training_is_bounded_by_bytes(spark):
    rows = [(i, "wort und " * 20, "de", "s", 1) for i in range(400)] + [(1000 + i, "mot et " * 20, "fr", "s", 1) for i in range(10)]
    df = spark.createDataFrame(rows, DOCS)
    drawn = L.training_texts(df, F.lit(True), 20_000).groupBy("lang").agg(F.sum(F.length("text")).alias("b")).collect()
    size = {r.lang: r.b for r in drawn}
    assert 10_000 < size["de"] < 30_000 and size["fr"] == 10 * 140


def test_held_out_accuracy(spark):
    rows = Q.QUERIES["op12_language_id"](spark, SF_SMALL).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 30
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark, edge, empty, clashing, trained):
    model = trained[2]
    out = L.predict(edge, model, ["doc_id", "text"]).collect()
    assert len(out) == edge.count()
    for r in out:
        none = r.row.text is None or not any(map(str.isalpha, r.row.text))
        assert (r.lang_pred == "und") == none and (r.score == 0) == none, r.row.text
    odd = clashing.withColumns({c: F.lit("x") for c in ("lang_pred", "h", "share", "n")})
    assert sorted(map(str, L.predict(odd, model, ["doc_id", "text"]).collect())) == sorted(map(str, out))
    assert L.train(odd, F.lit(True)).languages == L.train(edge, F.lit(True)).languages == ["en"]
    assert L.predict(empty, model, ["doc_id"]).collect() == []
    nothing = L.train(empty, F.lit(True))
    assert {(r.lang_pred, r.score) for r in L.predict(edge, nothing, ["doc_id"]).collect()} == {("und", 0.0)}


def test_equal_lengths_take_the_first_language(spark):
    rows = [(i, "same words", lang, "s", 1) for i, lang in enumerate(["b", "a"])]
    df = spark.createDataFrame(rows, DOCS)
    got = L.predict(df, L.train(df, F.lit(True)), ["doc_id"]).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("a", 0.5)}
