"""Phrase collocations by dynamic itemset counting.

Documents are dealt into SHARDS shards by a hash of their text, and the shards
are scanned in turn, again and again. A step of the scan counts, in one shard,
phrases of all lengths that are active: every word in the first cycle; a
longer phrase from the step after both its subphrases (without the last and
without the first word) have been seen ``least`` times, for one full cycle. So
two- and three-word phrases are counted while words still are, and the scan
ends as soon as no phrase is left that has not completed its cycle.

* Which subphrases have reached the threshold is told to the tasks by bit
  arrays of fixed size (BLOOM_BITS bits per length and kind), gathered by bits
  and not by phrases. A false positive activates a phrase too early, which
  does no harm: each count belongs to one shard and is the whole count of that
  shard, and a phrase's total takes every shard once.
* Longer phrases are counted by keys of 56 bits, packed by BINS bins of the key: a
  block of BLOCK words of a task sends one row per bin, whose keys and counts
  numpy sorts and adds, in a table bucketed by bin. Two phrases of one key only
  look more frequent than they are. So the keys that reach the threshold, as
  bit arrays, name every phrase that may, and a last scan counts these by
  their words, exactly.
* Words are counted as text in a table bucketed by word; a frequent word sends
  one row per block and language, whatever its count.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count as counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.bucketed import bucket_count, forget, new_name, write_bucketed
from .common import stored

SHARDS = 2
BLOOM_BITS = 1 << 25
BLOCK = 2_000_000  # words of a task between two flushes
BINS = 4096  # of the keys of longer phrases, by their highest bits
TOP = 2000
UNKNOWN = "und"

#: Bytes of a text: A-Z in lower case, separators of pieces as \xff (no byte of UTF-8), tab as blank.
_BYTES = bytes(0xFF if chr(b) in ".,;:!?\x0a\x0b\x0c\x0d" else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b
               for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8, in order, with ``\\xff`` between pieces."""
    return text.translate(_BYTES).replace(b"\xff", b" \xff ").split()


class Bits:
    """Membership in a bit array of fixed size, two bits a key."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 64 - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for h in (hashes & self.mask, (hashes >> np.uint64(32)) & self.mask):
            out &= (self.bits[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) != 0
        return out


def _hashes(lang: bytes, phrases: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest
    return np.fromiter((xxh64_intdigest(lang + b"\x1f" + p, 42) for p in phrases), np.uint64, len(phrases))


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A pair's key, from its words' hashes. The fourth byte is empty: a packed key has six bytes and its bin."""
    return (first ^ ((second << np.uint64(1)) | (second >> np.uint64(63)))) & np.uint64(0xFFFFFFFF_00FFFFFF)


def triple_key(pair: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A triple's key, from the key of its first two words and its last word's hash."""
    return pair_key(pair * np.uint64(0x9E3779B97F4A7C15), last)


def _longer(lang: str, words: list[bytes], ids: np.ndarray, plan: dict):
    """(pairs, triples) of a block that are active, at each place where they stand; id 0 is the end of a piece. Pairs
    are (keys, first word ids, second), triples (keys, first word ids, second, third)."""
    if plan["reached"][1] is None or len(ids) < 2:
        return None, None
    h = _hashes(lang.encode(), words)
    ok, new = plan["reached"][1].has(h), plan["recent"][1].has(h)
    ok[0] = new[0] = False
    at = np.flatnonzero(ok[ids[:-1]] & ok[ids[1:]])
    if not len(at):
        return None, None
    left, right = ids[at], ids[at + 1]
    keys = pair_key(h[left], h[right])
    active = np.flatnonzero(new[left] | new[right] if plan["only"] is None else plan["only"][2].has(keys))
    pairs = (keys[active], left[active], right[active])
    if plan["reached"][2] is None:
        return pairs, None
    ok2, new2 = plan["reached"][2].has(keys), plan["recent"][2].has(keys)
    first = np.flatnonzero((at[:-1] + 1 == at[1:]) & ok2[:-1] & ok2[1:] & (new2[:-1] | new2[1:]))
    last = right[first + 1]
    keys3 = triple_key(keys[first], h[last])
    if plan["only"] is not None:
        held = plan["only"][3].has(keys3)
        keys3, first, last = keys3[held], first[held], last[held]
    return pairs, (keys3, left[first], right[first], last)


def _counted(lang: str, words: list[bytes], ids: np.ndarray, plan: dict) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(length, phrases, counts) of a block's words, or of the longer phrases whose keys are in ``plan["only"]``."""
    if plan["words"]:
        n = np.bincount(ids, minlength=len(words))
        seen = np.flatnonzero(n[1:]) + 1
        yield 1, [words[i] for i in seen], n[seen]
        return
    size = np.int64(len(words))
    pairs, triples = _longer(lang, words, ids, plan)
    if pairs is not None:
        codes, n = np.unique(pairs[1] * size + pairs[2], return_counts=True)
        yield 2, [words[p // size] + b" " + words[p % size] for p in codes.tolist()], n
    if triples is not None:
        heads, head = np.unique(triples[1] * size + triples[2], return_inverse=True)
        codes, n = np.unique(head.astype(np.int64) * size + triples[3], return_counts=True)
        yield 3, [words[p // size] + b" " + words[p % size] + b" " + words[w]
                  for p, w in zip(heads[codes // size].tolist(), (codes % size).tolist())], n


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, list[bytes], np.ndarray]]]:
    """(lang, words, ids of the words in order) of the languages of each block of BLOCK words; id 0 ends a piece."""
    vocabulary, found, held = {}, defaultdict(list), 0

    def block():
        out = [(lang, list(vocabulary[lang]), np.concatenate(parts)) for lang, parts in found.items()]
        vocabulary.clear()
        found.clear()
        return out

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text)
            if not words:
                continue
            if lang not in vocabulary:
                numbers = counter()
                vocabulary[lang] = defaultdict(numbers.__next__)
                vocabulary[lang][b"\xff"]  # the end of a piece is number 0
            words.append(b"\xff")
            found[lang].append(np.fromiter(map(vocabulary[lang].__getitem__, words), np.int64, len(words)))
            held += len(words)
            if held >= BLOCK:
                yield block()
                held = 0
    yield block()


def _scan(batches: Iterator[pa.RecordBatch], plan: dict) -> Iterator[pa.RecordBatch]:
    """Counts of the documents' phrases by their text: (k, lang, phrase, n), combined per block."""
    for block in _blocks(batches):
        for lang, words, ids in block:
            for k, phrases, n in _counted(lang, words, ids, plan):
                for i in range(0, len(phrases), 100_000):
                    part = phrases[i:i + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k] * len(part), pa.int32()), pa.array([lang] * len(part), pa.string()),
                         pa.array(part, pa.binary()), pa.array(n[i:i + 100_000].astype(np.int64))],
                        names=["k", "lang", "phrase", "n"])


_PACKED = "k int, bin int, keys binary, ns binary"
_IN_BIN = np.uint64(65 - BINS.bit_length())
_BYTES_KEPT = [0, 1, 2, 4, 5, 6]  # the fourth is empty, the last is told by the bin


def _packed(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, _BYTES_KEPT].tobytes()


def _scan_keys(batches: Iterator[pa.RecordBatch], plan: dict) -> Iterator[pa.RecordBatch]:
    """Counts of one shard's active pairs and triples by their keys, packed by bin, per block."""
    for block in _blocks(batches):
        longer = [_longer(*part, plan) for part in block]
        for k in (2, 3):
            got = [x[k - 2][0] for x in longer if x[k - 2] is not None]
            if not got:
                continue
            keys, n = np.unique(np.concatenate(got), return_counts=True)
            ends = np.searchsorted(keys >> _IN_BIN, np.arange(BINS + 1, dtype=np.uint64))
            filled = np.flatnonzero(np.diff(ends))
            for few in np.array_split(filled, max(1, len(keys) * 16 >> 23)):
                parts = [(b, slice(ends[b], ends[b + 1])) for b in few.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(parts), pa.int32()), pa.array([b for b, _ in parts], pa.int32()),
                     pa.array([_packed(keys[p]) for _, p in parts], pa.binary()),
                     pa.array([n[p].tobytes() for _, p in parts], pa.binary())], names=["k", "bin", "keys", "ns"])


def _combine(parts: list[tuple[np.ndarray, np.ndarray]], how) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and ``how`` (add or maximum) over each one's numbers."""
    keys, n = np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts])
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], how.reduceat(n[order], starts)


def _unpacked(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) of each row, whose bin has the keys' highest bits."""
    out = []
    for b, packed, n in zip(*(table.column(c).to_pylist() for c in ("bin", "keys", "ns"))):
        keys = np.zeros((len(packed) // 6, 8), np.uint8)
        keys[:, _BYTES_KEPT] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
        out.append((keys.view("<u8")[:, 0] | (np.uint64(b) << _IN_BIN), np.frombuffer(n, np.int64)))
    return out


def _summed(table: pa.Table) -> pa.Table:
    """One bin's counts of one step and length, in one row."""
    keys, n = _combine(_unpacked(table), np.add)
    return pa.table({"k": table.column("k").slice(0, 1), "bin": table.column("bin").slice(0, 1),
                     "keys": pa.array([_packed(keys)], pa.binary()), "ns": pa.array([n.tobytes()], pa.binary())})


def _frequent(table: pa.Table, least: int, shards: int, upto: int) -> np.ndarray:
    """One bin's keys with ``least`` occurrences in the steps before ``upto``, every shard taken once."""
    by_shard = defaultdict(list)
    for step, part in zip(table.column("step").to_pylist(), _unpacked(table)):
        if step < upto:
            by_shard[step % shards].append(part)
    if not by_shard:
        return np.zeros(0, np.uint64)
    keys, n = _combine([_combine(parts, np.maximum) for parts in by_shard.values()], np.add)
    return keys[n >= least]


def _reached_keys(counts: DataFrame, k: int, least: int, shards: int, upto: int, new: bool) -> DataFrame:
    """Keys ``h`` of length ``k`` that have reached the threshold before step ``upto``; the ``new`` in the last step only."""
    def of_bin(table: pa.Table) -> pa.Table:
        found = _frequent(table, least, shards, upto)
        if new:
            found = np.setdiff1d(found, _frequent(table, least, shards, upto - 1), assume_unique=True)
        return pa.table({"h": pa.array(found.view(np.int64), pa.int64())})

    return (counts.filter((F.col("k") == k) & (F.col("step") < upto)).select("bin", "keys", "ns", "step")
            .groupBy("bin").applyInArrow(of_bin, "h long"))


def _word_keys(reached: DataFrame) -> DataFrame:
    """The hashes ``h`` of (lang, phrase) rows of words, as ``_hashes``."""
    return reached.select(F.xxhash64(F.concat("lang", F.lit("\x1f"), "phrase")).alias("h"))


def _bits(keys: DataFrame, size: int) -> np.ndarray | None:
    """The bit array of hashes ``h``: at most size / 64 numbers come to the driver."""
    places = keys.select(F.explode(F.array("h", F.shiftrightunsigned("h", 32))).alias("h")).select(
        F.col("h").bitwiseAND(F.lit(size - 1)).alias("p"))
    got = (places.groupBy(F.shiftright("p", 6).alias("i"))
           .agg(F.expr("bit_or(shiftleft(1L, CAST(p & 63 AS INT)))").alias("b"))).toArrow()
    if not got.num_rows:
        return None
    bits = np.zeros(size // 64, np.uint64)
    bits[got.column("i").to_numpy()] = got.column("b").to_numpy().view(np.uint64)
    return bits


def _either(arrays) -> Bits | None:
    arrays = [a for a in arrays if a is not None]
    return Bits(np.bitwise_or.reduce(arrays)) if arrays else None


def _total(shards: int, upto: int):
    """A phrase's occurrences in the steps before ``upto``, every shard taken once."""
    step = F.col("step")
    per_shard = [F.coalesce(F.max(F.when((step % shards == s) & (step < upto), F.col("n"))), F.lit(0)) for s in range(shards)]
    return sum(per_shard[1:], per_shard[0])


def _totals(counts: DataFrame, k: int, shards: int, upto: int) -> DataFrame:
    """(lang, phrase, total, was) of length ``k`` before step ``upto``; ``was`` without the last step."""
    return counts.filter(F.col("k") == k).groupBy("lang", "phrase").agg(
        _total(shards, upto).alias("total"), _total(shards, upto - 1).alias("was"))


def phrase_counts(docs: DataFrame, least: int = 10, shards: int = SHARDS, bloom_bits: int = BLOOM_BITS):
    """(words, phrases): (lang, phrase, total) of all words, and (lang, phrase, k, total) of the phrases of two and
    three words that occur at least ``least`` times, by dynamic itemset counting.

    ``docs`` has text and lang (null text: no words, null lang: ``und``), and
    may have any other columns and repeated rows, which all count. No rows
    give no phrases.
    """
    spark = docs.sparkSession
    text, lang = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    folder = scratch_path(spark, "llm-dic-shards")
    dealt = docs.select(lang.alias("lang"), text.alias("text")).filter("text != ''")
    dealt.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int")).write.partitionBy("shard").parquet(folder)
    documents = spark.read.schema("lang string, text string, shard int").parquet(folder)
    buckets = bucket_count(spark)
    by_text, by_key = (new_name(f"dic_{x}") for x in ("words", "keys"))
    paths = {x: scratch_path(spark, f"llm-{x}") for x in (by_text, by_key)}
    longer = False  # whether longer phrases have been counted
    reached = {1: [], 2: []}  # per step, the bits of the phrases that then reached the threshold
    step = 0

    def scanned(docs: DataFrame, scan, plan: dict, schema: str):
        told = spark.sparkContext.broadcast(plan)
        return told, (docs.select("lang", F.col("text").cast("binary").alias("text"))
                      .mapInArrow(lambda batches, told=told: scan(batches, told.value), schema))

    while True:
        late = {k: _either(reached[k][max(0, step - shards):]) for k in (1, 2)}
        if step >= shards and not late[1] and not late[2]:
            break  # every active phrase has completed its cycle
        shard, steps = documents.filter(F.col("shard") == step % shards), F.lit(step).alias("step")
        words_now, longer_now = step < shards, bool(late[1] or late[2])
        if words_now:
            told, counted = scanned(shard, _scan, {"words": True}, "k int, lang string, phrase binary, n long")
            # dealt by phrase alone: both the sums and the buckets then need no other exchange
            summed = (counted.select("k", "lang", F.col("phrase").cast("string").alias("phrase"), "n").repartition(buckets, "phrase")
                      .groupBy("k", "lang", "phrase").agg(F.sum("n").alias("n")))
            write_bucketed(summed.select("lang", "phrase", "n", "k", steps), by_text, paths[by_text], ["phrase"], buckets,
                           partition_by=["k", "step"], dealt=True)
            told.unpersist()
        if longer_now:
            all_ = {1: _either(reached[1]), 2: _either(reached[2]) if late[2] else None}
            plan = {"reached": all_, "only": None,
                    "recent": {k: late[k] or (all_[k] and Bits(np.zeros_like(all_[k].bits))) for k in (1, 2)}}
            told, counted = scanned(shard, _scan_keys, plan, _PACKED)
            summed = counted.repartition(buckets, "bin").groupBy("k", "bin").applyInArrow(_summed, _PACKED)
            write_bucketed(summed.select("bin", "keys", "ns", "k", steps), by_key, paths[by_key], ["bin"], buckets,
                           partition_by=["k", "step"], dealt=True)
            told.unpersist()
            longer = True
        step += 1
        reached[1].append(_bits(_word_keys(_totals(spark.table(by_text), 1, shards, step).filter(
            f"total >= {int(least)} and was < {int(least)}")), bloom_bits) if words_now else None)
        reached[2].append(_bits(_reached_keys(spark.table(by_key), 2, least, shards, step, True), bloom_bits) if late[1] else None)
    words = stored(_totals(spark.table(by_text), 1, shards, step).drop("was"), "dic-words")
    only = {k: _either([_bits(_reached_keys(spark.table(by_key), k, least, shards, step, False), bloom_bits)] if longer else [])
            for k in (2, 3)}
    if only[2] is None:
        phrases = spark.createDataFrame([], "lang string, phrase string, k int, total long")
    else:
        bits = {1: _either(reached[1]), 2: only[2] if only[3] is not None else None}
        told, counted = scanned(documents, _scan, {"words": False, "reached": bits, "recent": bits, "only": only},
                                "k int, lang string, phrase binary, n long")
        phrases = stored(counted.groupBy("lang", F.col("phrase").cast("string").alias("phrase"), "k").agg(F.sum("n").alias("total"))
                         .filter(F.col("total") >= least), "dic-phrases")
        told.unpersist()
    for name in (by_text, by_key) if longer else (by_text,):
        forget(spark, name)
    return words, phrases


def _score(a: str, left: str, right: str):
    """floor(1000000 a a / (left right)) in decimals of 38 digits: exact for a up to 10^15."""
    return F.expr(f"CAST((CAST({a} AS DECIMAL(15,0)) * CAST({a} AS DECIMAL(15,0)) * 1000000) "
                  f"div (CAST({left} AS DECIMAL(19,0)) * CAST({right} AS DECIMAL(19,0))) AS BIGINT)")


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = TOP, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases.

    A phrase of two or three words with at least ``least`` occurrences scores
    1000000 a a / (l r) at its weakest cut, rounded down. A phrase is dropped
    if a longer candidate that contains it has ``share`` percent of its
    occurrences. A language without such phrases has no rows.
    """
    words, phrases = phrase_counts(docs, least, **options)
    size = words.groupBy("lang").agg(F.sum("total").alias("n"))
    one = words.filter(F.col("total") >= least)  # every part of a candidate is as frequent as the candidate
    part = F.split("phrase", " ")
    cuts = stored(phrases.select(
        "lang", "phrase", "k", F.col("total").alias("a"), F.element_at(part, 1).alias("first"), F.element_at(part, -1).alias("last"),
        F.array_join(F.slice(part, 1, 2), " ").alias("head"), F.array_join(F.slice(part, F.size(part) - 1, 2), " ").alias("tail")),
        "dic-cuts")

    def of(table: DataFrame, key: str, value: str) -> DataFrame:
        return table.select("lang", F.col("phrase").alias(key), F.col("total").alias(value))

    two = cuts.filter("k = 2")
    pairs = stored(phrases.filter("k = 2").select("lang", "phrase", "total"), "dic-pairs")
    three = cuts.filter("k = 3")
    over = (three.select("lang", "a", F.explode(F.array("head", "tail")).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept2 = (two.join(over, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
             .join(of(one, "first", "l"), ["lang", "first"]).join(of(one, "last", "r"), ["lang", "last"])
             .select("lang", "phrase", "a", "l", "r", _score("a", "l", "r").alias("score")))
    kept3 = (three.join(of(one, "first", "l1"), ["lang", "first"]).join(of(pairs, "tail", "r1"), ["lang", "tail"])
             .join(of(pairs, "head", "l2"), ["lang", "head"]).join(of(one, "last", "r2"), ["lang", "last"])
             .withColumns({"s1": _score("a", "l1", "r1"), "s2": _score("a", "l2", "r2")})
             .select("lang", "phrase", "a", F.when(F.col("s1") <= F.col("s2"), F.col("l1")).otherwise(F.col("l2")).alias("l"),
                     F.when(F.col("s1") <= F.col("s2"), F.col("r1")).otherwise(F.col("r2")).alias("r"),
                     F.least("s1", "s2").alias("score")))
    scored = stored(kept2.unionByName(kept3), "dic-scored")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # first by portions of a language, so that one task sees few rows of a large one
    portion = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    few = scored.withColumn("rank", F.row_number().over(portion)).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(size, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same rows in DuckDB SQL, from all phrases of all lengths.
ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
ones AS (SELECT lang, unnest(w) AS p FROM worded),
f1 AS (SELECT lang, p, count(*) AS f FROM ones GROUP BY ALL),
g2 AS (SELECT lang, unnest(w[:-2]) AS x, unnest(w[2:]) AS y FROM worded WHERE len(w) > 1),
f2 AS (SELECT lang, x, y, x || ' ' || y AS p, count(*) AS f FROM g2 GROUP BY ALL HAVING count(*) >= 10),
g3 AS (SELECT lang, unnest(w[:-3]) AS x, unnest(w[2:-2]) AS y, unnest(w[3:]) AS z FROM worded WHERE len(w) > 2),
f3 AS (SELECT lang, x, y, z, x || ' ' || y || ' ' || z AS p, count(*) AS f FROM g3 GROUP BY ALL HAVING count(*) >= 10),
cut AS (
  SELECT f2.lang, f2.p, f2.f AS a, 1 AS k, u.f AS l, v.f AS r
  FROM f2 JOIN f1 u ON u.lang = f2.lang AND u.p = f2.x JOIN f1 v ON v.lang = f2.lang AND v.p = f2.y
  WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.f >= 50 * f2.f
                    AND (f3.x = f2.x AND f3.y = f2.y OR f3.y = f2.x AND f3.z = f2.y))
  UNION ALL
  SELECT f3.lang, f3.p, f3.f, 1, u.f, v.f FROM f3 JOIN f1 u ON u.lang = f3.lang AND u.p = f3.x
  JOIN f2 v ON v.lang = f3.lang AND v.x = f3.y AND v.y = f3.z
  UNION ALL
  SELECT f3.lang, f3.p, f3.f, 2, u.f, v.f FROM f3 JOIN f2 u ON u.lang = f3.lang AND u.x = f3.x AND u.y = f3.y
  JOIN f1 v ON v.lang = f3.lang AND v.p = f3.z),
scored AS (
  SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cut
  QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
sizes AS (SELECT lang, count(*) AS n FROM ones GROUP BY lang)
SELECT lang, rank, p AS phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM scored) JOIN sizes USING (lang)
WHERE rank <= 2000"""
