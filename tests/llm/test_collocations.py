"""Phrase collocations by dynamic itemset counting, against plain counting."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cumulus.llm import collocations as K

from .conftest import DOCS


def plain(rows, least, share, top):
    """All counts of all lengths at once, in Python's integers."""
    count, size = Counter(), Counter()
    for r in rows:
        lang = r[2] if r[2] is not None else "und"
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            size[lang] += len(w)
            for k in (1, 2, 3):
                count.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    out = {}
    for (lang, p), a in count.items():
        if len(p) == 1 or a < least:
            continue
        longer = [f for (x, q), f in count.items() if x == lang and len(q) == 3 and len(p) == 2 and f >= least and p in (q[:2], q[1:])]
        if any(100 * f >= share * a for f in longer):
            continue
        s, k = min((1_000_000 * a * a // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-s, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, size[lang], -s)
                  for lang, found in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert dict(df.dtypes)["rank"] == dict(df.dtypes)["score"] == "bigint"
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def texts():
    import random
    rng = random.Random(3)
    words = ["new", "york", "City", "the", "of", "été", "ÉTÉ", "a", "a", "b\x1fc", "日本"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60))).replace("of of", "of, of")
             .replace("a the", "a\tthe").replace("b\x1fc b", "b\x1fc\x0bb"), rng.choice(["en", "de", None]), "s", 1)
            for i in range(60)]
    rows += [(100 + i, "New York City. " * 3, "en", "s", 1) for i in range(5)] + [(None, None, None, None, None), (200, "", "fr", "s", 0)]
    rows += [(300, "x y " * 12, "rare", "s", 1), (300, "x y " * 12, "rare", "s", 1)]  # x y x has all of y x, and nearly all of x y
    return rows


@pytest.mark.parametrize("shards", [1, 3, 5])
def test_same_as_plain_counting(spark, texts, shards):
    df = K.collocations(spark.createDataFrame(texts, DOCS), 10, 50, 2000, shards=shards)
    assert got(df) == plain(texts, 10, 50, 2000)


def test_false_positives_change_nothing(spark, texts):
    """A bit array so small that every phrase seems to have reached the threshold."""
    df = K.collocations(spark.createDataFrame(texts, DOCS), 10, 50, 7, shards=2, bloom_bits=64)
    assert got(df) == plain(texts, 10, 50, 7)


def test_blocks_only_split_the_work(spark, texts, monkeypatch):
    plan = {"words": True, "reached": {1: None, 2: None}, "recent": {1: None, 2: None}}
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in texts]), pa.array([(r[1] or "").encode() for r in texts])],
                                       names=["lang", "text"])

    def sums():
        found = Counter()
        for out in K._scan(iter([batch]), plan):
            for row in out.to_pylist():
                found[row["lang"], row["phrase"]] += row["n"]
        return found

    whole = sums()
    monkeypatch.setattr(K, "BLOCK", 50)
    assert sums() == whole and sum(whole.values()) > 500


def test_edges(spark, edge, empty, clashing):
    rows = [tuple(r) for r in edge.collect()]
    want = plain(rows, 10, 50, 2000)
    assert want and got(K.collocations(edge)) == want
    assert got(K.collocations(clashing.withColumns({c: F.lit(1) for c in ("k", "n", "phrase", "step", "shard", "h")}))) == want
    assert K.collocations(empty).collect() == []
    assert K.collocations(edge.withColumn("text", F.lit(None).cast("string"))).collect() == []


def test_longer_phrases_are_sent_packed_by_bin():
    """One row per bin and length of a block, not per phrase; what it holds is every pair's and triple's count."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    words = [f"w{i}" for i in range(200)]
    text = " ".join(words[i * i % 200] + " " + words[i % 7] for i in range(20_000))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text.encode()])], names=["lang", "text"])
    every = K.Bits(np.full(1, ~np.uint64(0)))
    plan = {"reached": {1: every, 2: every}, "recent": {1: every, 2: every}, "only": None}
    got = pa.Table.from_batches(K._scan_keys(iter([batch]), plan))
    w = text.split()
    for k in (2, 3):
        rows = got.filter(pc.equal(got.column("k"), k))
        assert rows.num_rows == len(set(rows.column("bin").to_pylist())) <= K.BINS
        counts = Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
        h = {x: K._hashes(b"en", [x.encode()]) for x in set(w)}
        key = {p: K.pair_key(h[p[0]], h[p[1]]) for p in counts}
        key = {p: (K.triple_key(v, h[p[2]]) if k == 3 else v)[0] for p, v in key.items()}
        found = dict(zip(*(x.tolist() for x in K._combine(K._unpacked(rows), np.add))))
        assert found == {int(key[p]): n for p, n in counts.items()}


def test_a_key_counts_every_shard_once():
    import numpy as np
    import pyarrow as pa

    def packed(**n):
        return K._packed(np.array(list(map(int, (k[1:] for k in n))), np.uint64)), np.array(list(n.values()), np.int64).tobytes()

    parts = [packed(k1=6, k2=9, k3=10), packed(k1=4, k2=1), packed(k1=6, k2=9)]  # shards 0, 1 and 0 again
    table = pa.table({"step": [1, 2, 3], "bin": [0, 0, 0], "keys": pa.array([p[0] for p in parts], pa.binary()), "ns": pa.array([p[1] for p in parts], pa.binary())})
    assert K._frequent(table, 10, 2, 4).tolist() == [1, 2, 3]
    assert K._frequent(table, 10, 2, 2).tolist() == [3]
    assert K._frequent(table, 11, 2, 4).tolist() == []
