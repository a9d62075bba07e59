"""Embedding whitening by polarisation covariance.

Entries become whole numbers x, so every sum is exact. For each dimension and
each pair of dimensions the tasks sum squares of centred values: of y_i, and
of y_i + y_j. The variance of a sum less both variances is twice the
covariance, so these sums of squares alone give the whole covariance matrix,
which is assembled for ``eigh`` (d^2 numbers; d is the vectors' length).

x is centred at the rounded mean of its dimension, a whole number, before it
is squared; the rest of the mean is taken off in exact arithmetic at the end:
sum (n x - S)^2 = n^2 sum y^2 - n (sum y)^2. A task adds up in 64 bits as long
as no sum can overflow and in Python's integers otherwise, and sends one row
per dimension or pair; those are added as decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LARGEST = float(1 << 62)  # entries beyond are set to it: x is a long


def usable(vector: str = "embedding"):
    """A vector that isn't null and whose entries are all finite (also as doubles)."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(F.col(vector).isNotNull() & finite, F.lit(False))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, row numbers, x) for the vectors of each length in a batch."""
    for batch in batches:
        lists = batch.column("v")
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        for d in np.unique(lengths):
            if d:
                rows = np.flatnonzero(lengths == d)
                c = np.clip(np.floor(flat[starts[rows][:, None] + np.arange(d)] * float(SCALE)), -LARGEST, LARGEST)
                yield batch, rows, c.astype(np.int64) + SHIFT


def _sent(sums: dict) -> Iterator[pa.RecordBatch]:
    for (d, i), values in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * len(values), pa.int32()), pa.array([i] * len(values), pa.int32()),
             pa.array(range(i, i + len(values)), pa.int32()), pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))],
            names=["d", "i", "j", "total"])


SUMS = "d int, i int, j int, total decimal(38,0)"


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length d: the count (i = -1) and the sum of each dimension (i = 0, j the dimension)."""
    sums: dict = {}
    for _, rows, x in _matrices(batches):
        d = x.shape[1]
        wide = int(np.abs(x).max()).bit_length() + len(rows).bit_length() > 62
        total = x.astype(object).sum(0) if wide else x.sum(0)
        sums[d, -1] = sums.get((d, -1), np.zeros(1, object)) + np.array([len(rows)], object)
        sums[d, 0] = sums.get((d, 0), np.zeros(d, object)) + total.astype(object)
    yield from _sent(sums)


def _squares(batches: Iterator[pa.RecordBatch], centres: dict) -> Iterator[pa.RecordBatch]:
    """Per length d and dimensions i <= j: the sum of (y_i + y_j)^2, or of y_i^2 where i = j."""
    sums: dict = {}
    for _, rows, x in _matrices(batches):
        d = x.shape[1]
        y = x - centres[d]
        if 2 * (int(np.abs(y).max()).bit_length() + 1) + len(rows).bit_length() > 62:
            y = x.astype(object) - centres[d].astype(object)
        for i in range(d):
            pair = y[:, i:] + y[:, i:i + 1]
            pair[:, 0] = y[:, i]
            sums[d, i] = sums.get((d, i), np.zeros(d - i, object)) + (pair * pair).sum(0).astype(object)
    yield from _sent(sums)


class Fit:
    """What whitens the vectors of one length: count, sums, mean parts, components, eigenvalues and their shares."""

    def __init__(self, n: int, sums: list[int], squares: dict[tuple[int, int], int], centre: list[int], top: int):
        d = len(sums)
        rest = [s - n * c for s, c in zip(sums, centre)]  # sum of y: less than n in size

        def spread(i, j):  # n^2 times the variance of y_i (i = j) or of y_i + y_j: an exact whole number
            r = rest[i] if i == j else rest[i] + rest[j]
            return n * squares[i, j] - r * r

        own = [spread(i, i) for i in range(d)]
        v = np.empty((d, d))
        for i in range(d):
            v[i, i] = float(Fraction(own[i], n * n))
            for j in range(i + 1, d):
                v[i, j] = v[j, i] = float(Fraction(spread(i, j) - own[i] - own[j], 2 * n * n))
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(-values, kind="stable")[:top]
        trace = float(Fraction(sum(own), n * n))
        values, vectors = values[order], vectors[:, order]
        real = values > trace * d * np.finfo(float).eps  # a direction without spread can't be scaled
        self.n, self.sums, self.centre = n, [int(s) for s in sums], np.array(centre, np.int64)
        self.rest = np.array([float(Fraction(r, n)) for r in rest])
        self.scaled = np.where(real, vectors / np.sqrt(np.where(real, values, 1)), np.nan)
        self.explained = [float(e / trace) if trace > 0 else None for e in np.maximum(values, 0)]


def fit(vectors: DataFrame, top: int = COMPONENTS) -> dict[int, Fit]:
    """One ``Fit`` per vector length of ``v`` (array<double>, all usable)."""
    first = vectors.select("v").mapInArrow(_first, SUMS).groupBy("d", "i", "j").agg(F.sum("total").alias("t")).collect()
    n = {r.d: int(r.t) for r in first if r.i == -1}
    sums = {d: [0] * d for d in n}
    for r in first:
        if r.i == 0:
            sums[r.d][r.j] = int(r.t)
    centre = {d: [(2 * s + n[d]) // (2 * n[d]) for s in sums[d]] for d in n}
    told = vectors.sparkSession.sparkContext.broadcast({d: np.array(c, np.int64) for d, c in centre.items()})
    second = (vectors.select("v").mapInArrow(lambda b, told=told: _squares(b, told.value), SUMS)
              .groupBy("d", "i", "j").agg(F.sum("total").alias("t")).toArrow())
    squares: dict = {d: {} for d in n}
    for d, i, j, t in zip(*(second.column(c).to_pylist() for c in ("d", "i", "j", "t"))):
        squares[d][i, j] = int(t)
    return {d: Fit(n[d], sums[d], squares[d], centre[d], top) for d in n}


def _projected(batches: Iterator[pa.RecordBatch], fits: dict[int, Fit]) -> Iterator[pa.RecordBatch]:
    """The row with its deviation and whitened components."""
    for batch, rows, x in _matrices(batches):
        f = fits[x.shape[1]]
        y = x - f.centre
        white = (y - f.rest) @ f.scaled
        c = y.astype(object) * f.n - (np.array(f.sums, object) - f.n * f.centre.astype(object))
        large = int(np.abs(y).max() + 1).bit_length() + f.n.bit_length()
        if 2 * large + x.shape[1].bit_length() <= 62:
            c = c.astype(np.int64)
        deviation = (c * c).sum(1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row").take(pa.array(rows)), pa.array([x.shape[1]] * len(rows), pa.int32()),
             pa.array([int(t) if t < 1 << 63 else None for t in deviation], pa.int64()),
             pa.array(white.tolist(), pa.list_(pa.float64()))], names=["row", "d", "deviation", "w"])


def whiten(table: DataFrame, keep: list[str], vector: str = "embedding", top: int = COMPONENTS) -> DataFrame:
    """``row`` (a struct of the columns ``keep``), component, n, deviation, whitened, explained and identity_error.

    One row per usable vector and component, of the first ``top`` components
    (fewer for shorter vectors). Null vectors and those with null or
    non-finite entries are dropped, as are vectors of length 0, which have no
    component. Vectors of another length are a fit of their own. Repeated rows
    count as often as they occur. ``whitened`` is null along a component
    without spread (all rows equal, or fewer rows than components), and such
    components count in no identity error; ``deviation`` is null where it
    passes 64 bits. An empty table gives no rows; other columns of ``table``
    play no part, whatever they are called.
    """
    spark = table.sparkSession
    vectors = stored(table.filter(usable(vector)).select(
        F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(vector).cast("array<double>").alias("v")), "white-vectors")
    fits = fit(vectors, top)
    told = spark.sparkContext.broadcast(fits)
    kind = vectors.schema["row"].dataType.simpleString()
    white = stored(vectors.mapInArrow(lambda b, told=told: _projected(b, told.value),
                                      f"row {kind}, d int, deviation long, w array<double>"), "white-rows")
    size = max([min(top, d) for d in fits], default=0)
    w = [F.nanvl(F.get("w", F.lit(k)), F.lit(None)) for k in range(size)]
    # the covariance of what was written, less the identity; null (no such component) counts nowhere
    pairs = [(k, m) for k in range(size) for m in range(k, size)]
    means = [F.avg(c).alias(f"m{k}") for k, c in enumerate(w)] + [F.avg(w[k] * w[m]).alias(f"p{k}_{m}") for k, m in pairs]
    errors = {}
    for r in white.groupBy("d").agg(*means).collect() if pairs else ():
        off = [abs(r[f"p{k}_{m}"] - r[f"m{k}"] * r[f"m{m}"] - (k == m)) for k, m in pairs if r[f"p{k}_{m}"] is not None]
        errors[r["d"]] = max(off, default=None)
    facts = spark.createDataFrame([(d, k, f.n, e, errors.get(d)) for d, f in fits.items() for k, e in enumerate(f.explained)],
                                  "d int, k int, n long, explained double, identity_error double")
    long = white.select("row", "d", "deviation", F.posexplode("w").alias("k", "x"))
    # as many facts as components: a few rows for each length of vectors
    return long.join(facts, ["d", "k"]).select(
        "row", (F.col("k") + 1).cast("int").alias("component"), "n", "deviation",
        F.nanvl("x", F.lit(None).cast("double")).alias("whitened"), "explained", "identity_error")
