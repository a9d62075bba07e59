"""Quality by random-indexing word vectors and a two-layer network.

Random indexing. Every token (a run of letters, of digits, or of signs, as
written) falls into one of BUCKETS buckets by a fixed hash, and every bucket
has a sparse ternary index vector. A bucket's context vector is the sum of
the index vectors of the tokens that stand up to WINDOW places from its
own, over all documents; the sums are whole numbers, so they don't depend on
the order of the work. The table of buckets has a fixed size, whatever the
vocabulary.

A document is pooled as mean and standard deviation of its tokens' scaled
context vectors and as the correlation of each token's with the next one's. A network of one hidden layer is trained with numpy on a
bounded sample of labelled rows; a part of it, not trained on, sets the
temperature that calibrates the probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


BUCKETS = 1 << 13
DIM = 32
NONZERO = 4
WINDOW = 2
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
CACHE = 500_000  # tokens whose bucket a worker remembers
CHUNK = 400_000  # tokens handled at once
MAX_LABELLED = 4000  # bound of the labelled sample: rows with the smallest hash of their id
HIDDEN = 32
THRESHOLD = 0.3
SEED = 11


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every bucket's index vector."""
    rng = np.random.default_rng(SEED)
    places = np.argsort(rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
    return places, rng.choice(np.array([-1.0, 1.0]), (BUCKETS, NONZERO))


class Buckets(dict):
    """token -> bucket 1 .. BUCKETS - 1; 0 is the gap between documents."""

    def __missing__(self, token: str) -> int:
        if len(self) > CACHE:
            self.clear()
        b = zlib.crc32(token.encode("utf-8", "replace")) % (BUCKETS - 1) + 1
        self[token] = b
        return b

    def of(self, text: str) -> list[int]:
        return list(map(self.__getitem__, TOKEN.findall(text)))


def add_contexts(total: np.ndarray, b: np.ndarray, start: int, places: np.ndarray, signs: np.ndarray) -> None:
    """Adds to each token's bucket the index vectors of its neighbours, for pairs that end at ``start`` or later."""
    flat = total.reshape(-1)
    for d in range(1, WINDOW + 1):
        left, right = b[max(0, start - d):len(b) - d], b[max(0, start - d) + d:]
        for own, other in ((left, right), (right, left)):
            for k in range(NONZERO):
                flat += np.bincount(own * DIM + places[other, k], signs[other, k], BUCKETS * DIM)


def contexts(docs: DataFrame) -> np.ndarray:
    """Context vectors of all buckets, summed over all texts: BUCKETS x DIM whole numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        signs[0] = 0  # the gap lends nothing
        total, seen = np.zeros((BUCKETS, DIM)), Buckets()
        ids, start = [0] * WINDOW, WINDOW  # the last tokens of the chunk before stay as neighbours
        for batch in batches:
            for t in batch.column(0):
                ids += seen.of(t.as_py() or "")
                ids += [0] * WINDOW
                while len(ids) > CHUNK:
                    add_contexts(total, np.array(ids[:CHUNK]), start, places, signs)
                    ids = ids[CHUNK - WINDOW:]
        add_contexts(total, np.array(ids), start, places, signs)
        total[0] = 0
        used = np.flatnonzero(np.abs(total).sum(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(list(total[used].astype(np.int64)), pa.list_(pa.int64()))],
            ["bucket", "v"])
    sums = (docs.select(F.col("text").cast("string")).mapInArrow(run, "bucket int, v array<long>")
            .groupBy("bucket").agg(F.array(*[F.sum(F.col("v")[i]) for i in range(DIM)]).alias("v")).toArrow())
    out = np.zeros((BUCKETS, DIM))
    if sums.num_rows:
        out[sums.column("bucket").to_numpy()] = np.array(sums.column("v").to_pylist(), float)
    return out


def scaled(total: np.ndarray) -> np.ndarray:
    """Unit context vectors less their common direction."""
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    v = np.divide(total, norm, out=np.zeros_like(total), where=norm > 0)
    weight = norm / max(norm.sum(), 1e-12)
    v -= np.where(norm > 0, (weight * v).sum(0), 0)
    return v.astype(np.float32)


def pooled(b: list[int], vectors: np.ndarray) -> np.ndarray:
    """Mean, standard deviation and lag-one product of the tokens' vectors; zeros without a token."""
    if not b:
        return np.zeros(3 * DIM)
    s, ss, lag, n = np.zeros(DIM), np.zeros(DIM), np.zeros(DIM), len(b)
    for at in range(0, n, CHUNK):
        x = vectors[b[max(0, at - 1):at + CHUNK]]  # the first of a later chunk is the last one before it
        new = x[1:] if at else x
        s += new.sum(0, dtype=np.float64)
        ss += np.einsum("ij,ij->j", new, new, dtype=np.float64)
        lag += np.einsum("ij,ij->j", x[1:], x[:-1], dtype=np.float64)
    mean = s / n
    var = np.maximum(ss / n - mean ** 2, 0)
    return np.concatenate([mean, np.sqrt(var), (lag / max(1, n - 1) - mean ** 2) / (var + 1e-4)])


def features(docs: DataFrame, vectors: np.ndarray, carry: list[str]) -> DataFrame:
    """The columns ``carry`` and x, the pooled vector of the row's text."""
    rows = docs.select(F.struct(*carry).alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Buckets()
        for b in batches:
            x = [pooled(seen.of(t.as_py() or ""), vectors) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["row", "x"])
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, x array<double>").select("row.*", "x")


# ---------------------------------------------------------------- the network


@dataclass
class Network:
    mean: np.ndarray
    sd: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.sd @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, steps: int = 600, rate: float = 0.01, decay: float = 1e-3) -> Network | float:
    """Network trained by Adam on four fifths of the rows, temperature set on the rest.

    Without both labels the share of label 1 (0.5 without rows) is returned instead.
    """
    if len(y) < 10 or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    rng = np.random.default_rng(SEED)
    held = np.zeros(len(y), bool)
    held[rng.permutation(len(y))[: len(y) // 5]] = True
    mean, sd = x[~held].mean(0), x[~held].std(0) + 1e-6
    z, t = (x[~held] - mean) / sd, y[~held].astype(float)
    weight = np.where(t == 1, 0.5 / max(t.mean(), 1e-9), 0.5 / max(1 - t.mean(), 1e-9))
    weight = np.sqrt(weight)
    p = [rng.normal(size=(x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN),
         rng.normal(size=HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for i in range(1, steps + 1):
        h = np.tanh(z @ p[0] + p[1])
        q = 1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30)))
        e = weight * (q - t) / len(t)
        back = np.outer(e, p[2]) * (1 - h ** 2)
        grads = [z.T @ back + decay * p[0], back.sum(0), h.T @ e + decay * p[2], np.array([e.sum()])]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(v[k] / (1 - 0.999 ** i)) + 1e-8)
    net = Network(mean, sd, p[0], p[1], p[2], float(p[3][0]), 1.0)
    if held.any():
        logit, t = net.logits(x[held]), y[held].astype(float)
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 121))
        loss = [np.logaddexp(0, np.where(t == 1, -logit, logit) / g).mean() for g in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, usable, max_labelled: int = MAX_LABELLED
          ) -> Network | float:
    """Fit on at most ``max_labelled`` labelled rows for which ``usable`` holds (smallest hash of doc_id first)."""
    rows = (labels.filter(usable & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
            .select("doc_id", F.col("quality").cast("int").alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_labelled))
    sample = rows.join(docs.select("doc_id", "text"), "doc_id").filter("text is not null")
    got = features(sample, vectors, ["doc_id", "quality"]).toArrow().to_pylist()
    got.sort(key=lambda r: (r["doc_id"], r["quality"], r["x"]))
    return fit(np.array([r["x"] for r in got], float).reshape(-1, 3 * DIM),
               np.array([int(r["quality"] > 0) for r in got]))


def score(docs: DataFrame, vectors: np.ndarray, net: Network | float, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``.

    A null or empty text, or one without a token, is pooled as zeros and
    scored like any other; without labels of both kinds every score is the
    share of label 1 (0.5 without labels); repeated rows score alike.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Buckets()
        for b in batches:
            if isinstance(net, float):
                p = np.full(b.num_rows, net)
            else:
                p = net.probability(np.array([pooled(seen.of(t.as_py() or ""), vectors) for t in b.column(1)]
                                             ).reshape(-1, 3 * DIM))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, score double, predicted int")
