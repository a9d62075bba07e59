"""Language identification by prediction by partial matching.

For each language a byte context tree of order 4 is counted once and then
frozen. A byte's code length is that of PPM with escape method C and
exclusions: the longest context of the tree that occurs predicts it, or
escapes to the next shorter one, where the bytes that the longer context
predicts are left out; past the empty context all other bytes are equally
likely. So the lengths are those of a real code (each context's probabilities
add up to 1), and a text's length is the sum over its bytes, in every
language. The shortest code wins; its score is the posterior probability with
even priors.

Bytes that are ASCII but no letters become blanks, runs of blanks one blank,
and A-Z small; other bytes stay.

Trees are counted by Spark from at most about TRAIN_BYTES bytes per language
(whole texts, drawn by hash) and keep at most NODES nodes a language, the most
frequent ones; a node is never kept without its shorter ones. All texts are
scored whole, in pieces of BLOCK bytes, each distinct five-byte string once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ORDER = 4
TRAIN_BYTES = 4_000_000  # a language's training texts, about
NODES = 1 << 18  # of a language's tree, at most
ALL_NODES = 1 << 22  # of all trees together, at most
BLOCK = 2_000_000  # bytes scored or counted at a time
REMEMBERED = 1 << 19  # code lengths that a task keeps
UNKNOWN = "und"

_BYTES = bytes(b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def normalised(text: bytes) -> bytes:
    return b" ".join(text.translate(_BYTES).split())


def has_letter(text: bytes) -> bool:
    """Any letter of any script."""
    kept = normalised(text)
    return bool(kept) and (not kept.replace(b" ", b"").isascii() and any(map(str.isalpha, kept.decode("utf-8", "ignore")))
                           or any(97 <= b <= 122 for b in set(kept)))


def _mask(order: int) -> np.int64:
    return np.int64((1 << 8 * (order + 1)) - 1)


def strings(text: bytes) -> np.ndarray:
    """Each byte of ``text[ORDER:]`` (the low byte) with the ORDER bytes before it."""
    a = np.frombuffer(text, np.uint8).astype(np.int64)
    n = len(a) - ORDER
    return sum((a[ORDER - k:ORDER - k + n] << np.int64(8 * k) for k in range(1, ORDER + 1)), a[ORDER:])


def pieces(text: bytes, block: int = BLOCK) -> Iterator[bytes]:
    """A normalised text after ORDER blanks and before one, in pieces that overlap by ORDER bytes."""
    whole = b" " * ORDER + text + b" "
    for i in range(ORDER, len(whole), block):
        yield whole[i - ORDER:i + block]


# --------------------------------------------------------------------------- counting
def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def flush():
        for lang, parts in held.items():
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n.astype(np.int64))],
                                             names=["lang", "key", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for piece in pieces(normalised(text)):
                held.setdefault(lang, []).append(strings(piece))
                size += len(piece)
                if size >= BLOCK:
                    yield from flush()
                    size = 0
    yield from flush()


def training_texts(docs: DataFrame, usable: Column, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """(lang, text) of the training documents: all, or of larger languages those whose hash falls in its share."""
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string")).alias("h"))
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("b")).collect()  # a row per language, as there are trees
    shares = [F.lit(x) for r in sizes if r.b > train_bytes for x in (r.lang, train_bytes / r.b)]
    share = F.coalesce(F.element_at(F.create_map(*shares), F.col("lang")), F.lit(1.0)) if shares else F.lit(1.0)
    return rows.filter(F.col("h") / F.lit(2.0 ** 64) + 0.5 < share).select("lang", F.col("text").cast("binary").alias("text"))


def train(docs: DataFrame, usable: Column, train_bytes: int = TRAIN_BYTES, nodes: int = NODES) -> Model:
    """The frozen trees of all languages that the ``usable`` rows (a condition) of ``docs`` name.

    Rows without text or language teach nothing; repeated rows count as often
    as they occur. Without usable rows there is no language, and every
    prediction is ``und``.
    """
    full = training_texts(docs, usable, train_bytes).mapInArrow(_tallied, "lang string, key long, n long")
    full = full.groupBy("lang", "key").agg(F.sum("n").alias("n"))
    order = F.explode(F.sequence(F.lit(0), F.lit(ORDER))).alias("o")
    mask = F.expr(f"shiftright({int(_mask(ORDER))}L, 8 * ({ORDER} - o))")
    counted = stored(full.select("lang", "n", "key", order).select("lang", "o", F.col("key").bitwiseAND(mask).alias("key"), "n")
                     .groupBy("lang", "o", "key").agg(F.sum("n").alias("n")), "ppm-nodes")
    least: dict[str, int] = {}
    sizes: dict[str, list[tuple[int, int]]] = {}
    for r in counted.groupBy("lang", "n").count().collect():  # as many rows as there are different counts
        sizes.setdefault(r["lang"], []).append((r["n"], r["count"]))
    room = min(nodes, ALL_NODES // max(1, len(sizes)))
    for lang, counts in sizes.items():
        total, least[lang] = 0, max(n for n, _ in counts) + 1
        for n, c in sorted(counts, reverse=True):
            total += c
            if total > room:
                break
            least[lang] = n
    if not least:
        return Model({})
    bound = counted.sparkSession.createDataFrame(list(least.items()), "lang string, least long")
    got = counted.join(bound, "lang").filter("n >= least").select("lang", "o", "key", "n").toArrow()
    lang, rest = np.array(got.column("lang").to_pylist(), object), [got.column(c).to_numpy() for c in ("o", "key", "n")]
    return Model({x: Tree(*[c[lang == x] for c in rest]) for x in sorted(least)})


class Tree:
    """Frozen counts: per order the contexts (sorted) with their totals and the nodes (context and byte) with counts."""

    def __init__(self, orders: np.ndarray, keys: np.ndarray, counts: np.ndarray):
        self.nodes, self.contexts = [], []
        for o in range(ORDER + 1):
            mine = orders == o
            at = np.argsort(keys[mine])
            k, n = keys[mine][at].astype(np.int64), counts[mine][at].astype(np.float64)
            c, start = np.unique(k >> 8, return_index=True)
            total = np.add.reduceat(n, start) if len(k) else np.zeros(0)
            kinds = np.diff(np.append(start, len(k))).astype(np.float64)
            left_total, left_kinds = np.zeros(len(c)), np.zeros(len(c))
            if o and len(k):  # what the shorter context holds besides the bytes that this one predicts
                shorter, below = self.contexts[o - 1], self.nodes[o - 1]
                p = np.searchsorted(shorter[0], c & (_mask(o - 1) >> 8))
                taken = np.add.reduceat(below[1][np.searchsorted(below[0], k & _mask(o - 1))], start)
                left_total, left_kinds = shorter[1][p] - taken, shorter[2][p] - kinds
            self.nodes.append((k, n))
            self.contexts.append((c, total, kinds, left_total, left_kinds))

    def lengths(self, strings: np.ndarray) -> np.ndarray:
        """Code length in bits of each string's last byte after the others."""
        cost = np.zeros(len(strings))
        open_ = np.arange(len(strings))
        left = np.full((2, len(strings)), np.nan)  # total and kinds that exclusion leaves; nan: no longer context
        for o in range(ORDER, -1, -1):
            (c, total, kinds, left_total, left_kinds), (k, n) = self.contexts[o], self.nodes[o]
            v = strings[open_] & _mask(o)
            p = np.minimum(np.searchsorted(c, v >> 8), max(len(c) - 1, 0))
            there = np.flatnonzero(c[p] == v >> 8) if len(c) else np.zeros(0, np.int64)
            if not len(there):
                continue
            i, p, v = open_[there], p[there], v[there]
            fresh = np.isnan(left[0, i])
            t, d = np.where(fresh, total[p], left[0, i]), np.where(fresh, kinds[p], left[1, i])
            q = np.minimum(np.searchsorted(k, v), len(k) - 1)
            hit = k[q] == v
            cost[i[hit]] += np.log2((t + d)[hit] / n[q[hit]])
            out = ~hit & (d > 0)  # with nothing left to predict the escape is certain
            cost[i[out]] += np.log2((t + d)[out] / d[out])
            left[0, i], left[1, i] = left_total[p], left_kinds[p]
            still = np.ones(len(open_), bool)
            still[there[hit]] = False
            open_ = open_[still]
        cost[open_] += np.log2(256 - len(self.nodes[0][0]))
        return cost


class Model:
    """The trees by language."""

    def __init__(self, trees: dict[str, Tree]):
        self.languages, self.trees = list(trees), list(trees.values())

    def lengths(self, strings: np.ndarray) -> np.ndarray:
        return np.array([t.lengths(strings) for t in self.trees]).reshape(len(self.trees), len(strings))


def posterior(bits: np.ndarray) -> np.ndarray:
    """Probabilities of code lengths (languages by texts), priors even."""
    p = np.exp2(bits.min(0) - bits)
    return p / p.sum(0)


class _Lengths:
    """A model's code lengths, with a bounded memory of strings seen before."""

    def __init__(self, model: Model):
        self.model, self.known, self.value = model, np.zeros(0, np.int64), np.zeros((len(model.trees), 0))

    def __call__(self, found: np.ndarray) -> np.ndarray:
        p = np.minimum(np.searchsorted(self.known, found), max(len(self.known) - 1, 0))
        new = self.known[p] != found if len(self.known) else np.ones(len(found), bool)
        if new.any():
            more = found[new]
            values = self.model.lengths(more)
            if len(self.known) + len(more) > REMEMBERED:
                self.known, self.value = self.known[p[~new]], self.value[:, p[~new]]
            self.known, self.value = np.append(self.known, more), np.append(self.value, values, axis=1)
            order = np.argsort(self.known)
            self.known, self.value = self.known[order], self.value[:, order]
            p = np.searchsorted(self.known, found)
        return self.value[:, p]


def _predicted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    lengths = _Lengths(model)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        bits = np.zeros((len(model.trees), len(texts)))
        known = np.array([t is not None and has_letter(t) for t in texts], bool)
        held, owner, size = [], [], 0

        def add():
            found, inverse = np.unique(np.concatenate(held), return_inverse=True)
            table = lengths(found)
            starts = np.cumsum([0, *map(len, held)])[:-1]
            for k in range(len(table)):
                np.add.at(bits[k], owner, np.add.reduceat(table[k][inverse], starts))
            held.clear()
            owner.clear()

        for i in np.flatnonzero(known) if model.trees else ():
            for piece in pieces(normalised(texts[i])):
                held.append(strings(piece))
                owner.append(i)
                size += len(piece)
                if size >= BLOCK:
                    add()
                    size = 0
        if held:
            add()
        if model.trees:
            p, best = posterior(bits), bits.argmin(0)
            score = np.where(known, p.max(0), 0.0)
            names = [model.languages[b] if x else UNKNOWN for b, x in zip(best, known)]
        else:
            score, names = np.zeros(len(texts)), [UNKNOWN] * len(texts)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(names, pa.string()), pa.array(score)],
                                         names=["row", "lang_pred", "score"])


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``row`` (a struct of the columns ``keep``), lang_pred and score of every row.

    ``und`` and 0 for a null text, a text without a letter, and if no
    language was learned. Of equal code lengths the language that comes first
    by code point wins. Repeated rows give repeated results, an empty table
    none; columns of the same names in ``docs`` play no part.
    """
    told = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(lambda b, told=told: _predicted(b, told.value),
                           f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double")
