"""Mixing against a plain loop, packing as an exact round trip."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from cumulus.llm import mixing as M
from cumulus.llm import packing as K
from tests.llm.conftest import DOCS, prose


def plain_targets(sizes):
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(sorted((s for s in sizes if s is not None)) +
                                                        [s for s in sizes if s is None])}
    total, target = sum(sizes.values()), {}
    free = dict(weight)
    while free:
        rest = total - sum(target.values())
        per = rest / sum(free.values())
        full = [s for s in free if 3 * sizes[s] < per * free[s]]
        if not full:
            return target | {s: per * w for s, w in free.items()}
        for s in full:
            target[s] = 3 * sizes[s]
            del free[s]
    return target


def test_mix_hits_targets(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(0, 60)) if i % 11 else None, None,
             "big" if i % 3 == 0 else f"s{i % 7}" if i % 13 else None, None) for i in range(700)]
    docs = spark.createDataFrame(rows, DOCS)
    out = M.taken(docs).collect()
    assert len(out) == len(rows)
    of = {r[0]: r for r in rows}
    sizes, took, largest, target = {}, {}, {}, {}
    for r in out:
        s = of[r["doc_id"]][3]
        assert r["size"] == len((of[r["doc_id"]][1] or "").split())
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        sizes[s] = sizes.get(s, 0) + r["size"]
        took[s] = took.get(s, 0) + r["taken"]
        largest[s] = max(largest.get(s, 0), r["size"])
        target[s] = r["target"]
    want = plain_targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * want[s]
        assert abs(took[s] - target[s]) <= largest[s] / 2 + 1
    assert sorted(out) == sorted(M.taken(docs).collect())
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert all(r["size"] * times.get(r["doc_id"], 0) == r["taken"] for r in out)


def test_rows_of_equal_key_meet_their_target(spark):
    same = "one two three four five six seven eight nine ten"
    rows = [(None, same, None, "a", None)] * 400 + [(7, same, None, "b", None)] * 300
    rows += [(i, same, None, "c" if i % 2 else None, None) for i in range(100)] + [(None, None, None, "a", None)] * 3
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    out = M.taken(docs).collect()
    assert len(out) == len(rows)
    sizes, took = {}, {}
    target = {r["source_size"]: r["target"] for r in out}
    for r in out:
        took[r["source_size"]] = took.get(r["source_size"], 0) + r["taken"]
    sizes = {"a": 4000, "b": 3000, "c": 500, None: 500}
    want = plain_targets(sizes)
    assert abs(target[4000] - want["a"]) < 1e-6 and abs(target[3000] - want["b"]) < 1e-6
    assert abs(took[4000] - want["a"]) <= 5 and abs(took[3000] - want["b"]) <= 5
    assert sorted(map(repr, out)) == sorted(map(repr, M.taken(docs).collect()))
    assert M.mix(docs).filter("source = 'a' and text is not null").count() * 10 == took[4000]


def test_noisy_documents_come_later(spark):
    rng = random.Random(7)
    rows = [(i, prose(rng, 50) if i % 2 else " ".join(w + "##" for w in prose(rng, 50).split()), None,
             "a" if i < 400 else "z", None) for i in range(440)]
    out = {r["doc_id"]: r for r in M.taken(spark.createDataFrame(rows, DOCS)).collect()}
    z = [out[i]["taken"] // out[i]["size"] for i in range(440)]
    clean, noisy = sum(z[1::2]), sum(z[::2])
    assert clean > noisy


def test_mixing_edges(edge, empty, clashing, spark):
    out = M.taken(edge).collect()
    assert len(out) == edge.count()
    assert all(r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] for r in out)
    assert M.taken(empty).count() == 0 and M.mix(empty).count() == 0
    mixed = M.mix(clashing)
    assert mixed.columns == clashing.columns and mixed.count() == M.mix(edge).count()
    blank = spark.createDataFrame([(1, None, None, "a", None), (2, "", None, None, None)], DOCS)
    assert [r["taken"] for r in M.taken(blank).collect()] == [0, 0]


def test_ids_are_those_of_tokenizers():
    path = public_tokenizers.path(K.TOKENIZER)
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    rng = random.Random(8)
    texts = ["", "I'll go, 123 times;\n\n  \t x", "é ü 日本 \U0001f600", "<|endoftext|> a", "a" * 3000, prose(rng, 400),
             "".join(chr(rng.randrange(1, 0x2fff)) for _ in range(3000))]
    assert [e.ids for e in t.encode_batch(texts, add_special_tokens=False)] == [
        K.encoder(path).encode_ordinary(x) for x in texts]


def test_added_tokens_have_their_ids(spark):
    t = Tokenizer.from_file(public_tokenizers.path(K.TOKENIZER))  # as the file says, nothing set
    rng = random.Random(10)
    end = "<|endoftext|>"
    texts = ["a log line <|endoftext|> and more", end, end * 3, f" {end}  \n{end}a", "<|endoftext|", "<|<|endoftext|>|>",
             "".join(rng.choice([end, " ", "\n", "word ", "it's", "<|", "1é"]) for _ in range(3000)), "", None]
    ids = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert ids[0] == [64, 2604, 1627, 220, 50256, 290, 517]
    path = public_tokenizers.path(K.TOKENIZER)
    assert [K.ids_of(x or "", path) for x in texts] == ids
    out = K.pieces(spark.createDataFrame([(i, x, None, None, None) for i, x in enumerate(texts)], DOCS)).collect()
    for r in out:
        own = [*ids[r["doc_id"]], K.END][r["start"]:r["start"] + r["length"]]
        assert len(own) == r["length"] and r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
    assert sum(r["length"] for r in out) == sum(map(len, ids)) + len(ids)


def check(docs, out, length=1024):
    tok = Tokenizer.from_file(public_tokenizers.path(K.TOKENIZER))  # unaltered: added tokens get their own ids
    want = []
    for r in docs.collect():
        ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= length else len(ids) % length or length
        ends = [first, *range(first + length, len(ids) + 1, length)]
        for k, (a, b) in enumerate(zip([0, *ends], ends)):
            want.append((r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    rows = out.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(want, key=repr)
    of = {}
    for r in rows:
        of.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in of.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= length
    return len(of), sum(w[3] for w in want)


def test_packing_round_trip(spark):
    rng = random.Random(9)
    docs = spark.createDataFrame([(i, prose(rng, int(rng.paretovariate(1.1) * 60) % 4000), None, None, None)
                                  for i in range(1200)], DOCS)
    n, total = check(docs, K.pack(docs))
    assert n <= 1.02 * -(-total // 1024) + 2


def test_packing_edges(edge, empty, clashing):
    check(edge, K.pack(edge))
    assert K.pack(empty).count() == 0
    check(edge, K.pack(clashing))


def test_every_piece_is_placed_once():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 3000):
        lengths = rng.integers(1, 1025, n)
        s, o = K.packed(lengths)
        assert (s >= 0).all() and len(s) == n
        for b in np.unique(s):
            at = np.flatnonzero(s == b)
            at = at[np.argsort(o[at])]
            assert (o[at] == np.cumsum(lengths[at]) - lengths[at]).all() and lengths[at].sum() <= 1024


def test_placement_minimises_the_sum_of_squares():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 30, 300)
    bins = K.place(lengths, 32)
    of = {p: i for i, b in enumerate(bins) for p in b}
    gaps = {}
    for p, n in enumerate(lengths.tolist()):
        count = np.bincount([g for g in gaps.values() if g], minlength=33)[:33]
        def total(old, new):
            c = count.copy()
            c[0] = 0
            if old is not None:
                c[old] -= 1
            if new:
                c[new] += 1
            return int((c ** 2).sum())
        options = [total(g, g - n) for g in set(gaps.values()) if g >= n] + [total(None, 32 - n)]
        old = gaps.get(of[p])
        assert total(old, (32 if old is None else old) - n) == min(options)
        gaps[of[p]] = (32 if old is None else old) - n
