"""SimHash near-duplicates found through Golay-code keys.

A document's fingerprint has 64 bits: bit b is 1 if it is set in over half
of the XXH64 values of its word shingles. Two fingerprints link when they
differ in at most two bits.

Candidate search. The fingerprint is cut into three segments (21, 21, 22
bits). Two differing bits leave, for one of the three cyclic pairs
(a, a+1), segment a equal and segment a+1 with at most one error:
(2,0,0) and (0,0,2), (0,2,0) leave a pair without errors, (1,1,0) and its
turns a pair with one. So the keys are (pair, exact segment a, index of a
codeword near segment a+1). The codewords are those of the perfect binary
Golay code [23,12,7]: every 23-bit word lies within 3 bits of exactly one.
A word at distance 0-2 emits the index of that codeword; a word at distance
3 also those of the five codewords at distance 4. Words x, y one bit apart
then always share an index: if x lies within 2 of its codeword, y lies
within 3 of the same; if both lie at 3 from different codewords, each lies
at 4 from the other's.

Within a key the distinct fingerprints are compared bit by bit and only a
spanning forest of the links leaves the task, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import SALTS
from .common import stored
from .components import connected_components

SEED = 42
MASK_SEG = ((0, 21), (21, 21), (42, 22))  # (first bit, bits) of the three segments
GOLAY = 0xC75  # generator x^11+x^10+x^6+x^5+x^4+x^2+1 of the [23,12,7] code
CHUNK = 1 << 15  # shingles hashed at a time
BITS_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)
BYTE_OFFSET = (np.arange(8) * 256).astype(np.uint16)
DENSE = 4096  # fingerprints in a key from which neighbours are looked up, not compared
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, k: int = 3) -> int:
    """SimHash of the k-word shingles of a whole text; 0 without a word."""
    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= k:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n, votes = len(words) - k + 1, np.zeros(64, np.int64)
    shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(k))))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    while len(part := np.fromiter(islice(hashes, CHUNK), np.uint64)):
        at = part.view(np.uint8).reshape(-1, 8) + BYTE_OFFSET
        votes += (np.bincount(at.ravel(), minlength=2048).reshape(8, 256) @ BITS_OF_BYTE).ravel().astype(np.int64)
    return int((np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))[votes * 2 > n]).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, k: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the long columns ``carry``: fp is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), k) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), *b.columns[2:]],
                                             ["doc_id", "fp", *carry])
    return docs.select(F.col("doc_id").cast("long"), "text", *carry).mapInArrow(
        run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *carry)))


# ---------------------------------------------------------------- Golay keys


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of low 12 / high 11 bits; error word by syndrome; up to six codeword offsets by syndrome."""
    def mod(x: int) -> int:
        for b in range(22, 10, -1):
            if x >> b & 1:
                x ^= GOLAY << (b - 11)
        return x
    bit = [mod(1 << b) for b in range(23)]
    low, high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
    for b in range(12):
        low[np.arange(1 << 12) >> b & 1 == 1] ^= bit[b]
    for b in range(11):
        high[np.arange(1 << 11) >> b & 1 == 1] ^= bit[12 + b]
    error, weight = np.zeros(2048, np.int64), np.zeros(2048, np.int64)
    for w in range(4):
        for at in combinations(range(23), w):
            s = 0
            for b in at:
                s ^= bit[b]
            error[s], weight[s] = sum(1 << b for b in at), w
    codewords = np.array([(m << 11) ^ mod(m << 11) for m in range(1 << 12)], np.int64)
    seven = codewords[np.bitwise_count(codewords) == 7]
    near = np.zeros((2048, 6), np.int64)  # codeword offsets from the nearest one; 0 repeats the nearest
    for s in np.flatnonzero(weight == 3):
        near[s, 1:] = seven[(seven & error[s]) == error[s]]
    return low, high, error, near


def codeword_indices(words: np.ndarray) -> np.ndarray:
    """For 23-bit words, six codeword indices each; a repeated index fills the row."""
    low, high, error, near = _golay()
    s = low[words & 0xFFF] ^ high[words >> 12]
    return ((words ^ error[s])[:, None] ^ near[s]) >> 11


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of fingerprints, and the position of each key's fingerprint."""
    seg = [(fps >> np.uint64(a) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in MASK_SEG]
    keys, rows = [], []
    for p in range(3):
        idx = codeword_indices(seg[(p + 1) % 3])
        own = np.ones(idx.shape, bool)
        own[:, 1:] = idx[:, 1:] != idx[:, :1]
        r, c = np.nonzero(own)
        keys.append((np.int64(p) << 40) | (seg[p][r] << 12) | idx[r, c])
        rows.append(r)
    return np.concatenate(keys), np.concatenate(rows)


# ---------------------------------------------------------------- links in a key


def _forest(fps: np.ndarray, bits: int) -> np.ndarray:
    """For sorted distinct fingerprints of one key: the position of each one's root."""
    n = len(fps)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def union(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)

    if n <= DENSE:
        for i in range(n - 1):
            for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= bits):
                union(i, i + 1 + int(j))
    else:  # each fingerprint has 64 + 2016 neighbours: look them up, linear in n
        for w in range(1, bits + 1):
            for at in combinations(range(64), w):
                other = fps ^ np.uint64(sum(1 << b for b in at))
                pos = np.searchsorted(fps, other)
                ok = (pos < n) & (fps[np.minimum(pos, n - 1)] == other)
                for i in np.flatnonzero(ok & (pos > np.arange(n))):
                    union(int(i), int(pos[i]))
    return np.array([find(i) for i in range(n)], np.int64)


def _edges_in_runs(keys: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) within runs of equal keys; rows come sorted by key."""
    cut = np.flatnonzero(np.diff(keys)) + 1
    starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(keys)]])
    size = ends - starts
    two = starts[size == 2]
    a, b = fps[two], fps[two + 1]
    near = np.bitwise_count(a ^ b) <= bits
    us, vs = [a[near]], [b[near]]
    for s, e in zip(starts[size > 2], ends[size > 2]):
        own = np.unique(fps[s:e])
        r = _forest(own, bits)
        m = r != np.arange(len(own))
        us.append(own[m])
        vs.append(own[r[m]])
    return np.concatenate(us), np.concatenate(vs)


def links(distinct: DataFrame, bits: int = 2) -> DataFrame:
    """(u, v): a spanning set of the links among distinct fingerprints (column fp)."""
    if not 0 <= bits <= 2:
        raise ValueError("the Golay keys find fingerprints of at most 2 differing bits")

    def emit(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys, rows = keys_of(fps)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows].view(np.int64))], ["key", "fp"])

    def compare(batches):
        kept_k, kept_f = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in batches:  # a run may go on in the next batch: hold the last one back
            kept_k = np.concatenate([kept_k, b.column(0).to_numpy(zero_copy_only=False)])
            kept_f = np.concatenate([kept_f, b.column(1).to_numpy(zero_copy_only=False)])
            at = int(np.searchsorted(kept_k, kept_k[-1])) if len(kept_k) else 0
            if at:
                yield from out(kept_k[:at], kept_f[:at])
                kept_k, kept_f = kept_k[at:], kept_f[at:]
        if len(kept_k):
            yield from out(kept_k, kept_f)

    def out(k, f):
        u, v = _edges_in_runs(k, f.view(np.uint64), bits)
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    keyed = distinct.select("fp").mapInArrow(emit, "key long, fp long")
    return (keyed.repartition("key").sortWithinPartitions("key")
            .mapInArrow(compare, "u long, v long"))


def near_duplicates(docs: DataFrame, k: int = 3, bits: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs`` (columns doc_id, text).

    component_id is the smallest doc_id reachable through links. Null and
    empty texts have fingerprint 0 and link like any other; equal rows share
    a component; a null doc_id is never the smallest (null if a component
    has no other). No rows give no rows.
    """
    fps = stored(fingerprints(docs, k), "fp")
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")), "classes")
    comp = stored(connected_components(stored(links(classes, bits), "links")), "comp")
    of = (classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
          .filter("n > 1 or component is not null")
          .select("fp", "low", F.coalesce("component", "fp").alias("component")))
    of = stored(of, "linked")
    lows = stored(of.groupBy("component").agg(F.min("low").alias("component_id")), "lows")
    named = stored(of.join(lows, "component").select("fp", "component_id", F.lit(True).alias("grouped")), "named")
    return (fps.join(named, "fp", "left")
            .select("doc_id", "fp", F.when(F.col("grouped"), F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _row_hashes(docs: DataFrame) -> tuple[Column, Column]:
    """Two hashes (96 bits) of a row's columns, but for maps, which have no order; equal rows agree."""
    cols = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
    return F.xxhash64(*cols), F.hash(*cols).cast("long")


def keep_one(docs: DataFrame, k: int = 3, bits: int = 2) -> DataFrame:
    """The rows of ``docs`` that remain when one row of each component stays.

    The row with the component's smallest doc_id stays (of several, that
    with the smallest hash), once however often it repeats. A null doc_id
    comes after all others. Rows are told apart by all their columns, so
    rows without a doc_id, or of one doc_id in several components, each
    count for their own component.
    """
    h1, h2 = _row_hashes(docs)
    hashed = docs.select("doc_id", "text", h1.alias("h1"), h2.alias("h2"))
    rows = (stored(fingerprints(hashed, k, ("h1", "h2")), "fp")
            .groupBy("fp", "h1", "h2").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n")))
    first = F.min(F.struct(F.isnull("id").alias("no_id"), "id", "h1", "h2", "n")).alias("first")
    classes = stored(rows.groupBy("fp").agg(first), "classes")
    comp = connected_components(stored(links(classes, bits), "links")).withColumnRenamed("node", "fp")
    kept = stored(classes.join(stored(comp, "comp"), "fp", "left")
                  .groupBy(F.coalesce("component", "fp").alias("root")).agg(F.min("first").alias("first"))
                  .select(F.col("first.h1").alias("_h1"), F.col("first.h2").alias("_h2"),
                          F.col("first.n").alias("_n")), "kept")
    once, again = kept.filter("_n = 1"), kept.filter("_n > 1")
    # the hashes are the hashed side: texts are shuffled once and never sorted
    out = docs.join(once.hint("shuffle_hash"), (h1 == once["_h1"]) & (h2 == once["_h2"]), "left_semi")
    if again.isEmpty():
        return out
    # equal rows are dealt over SALTS tasks, of which each leaves one
    part = docs.withColumns({"_h1": h1, "_h2": h2, "_salt": F.monotonically_increasing_id() % SALTS})
    dealt = again.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    same = part.join(dealt.hint("shuffle_hash"), ["_h1", "_h2", "_salt"], "left_semi")
    one = same.dropDuplicates(["_h1", "_h2", "_salt"]).dropDuplicates(["_h1", "_h2"])
    return out.unionByName(one.drop("_h1", "_h2", "_salt"))
