"""Polarisation covariance and whitening, against numpy and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cumulus.llm import queries as Q
from cumulus.llm import whitening as W
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def matrix(vectors):
    return [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]


def checked(rows, vectors, ids, top=8):
    """Compares rows with a plain form: covariance by products of centred integers."""
    x, n, d = matrix(vectors), len(vectors), len(vectors[0])
    s = [sum(col) for col in zip(*x)]
    c = [[n * a - b for a, b in zip(r, s)] for r in x]
    cov = np.array([[float(sum(r[i] * r[j] for r in c)) / n ** 3 for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    white = (np.array(c, float) / n) @ u[:, :top] / np.sqrt(e[:top])
    by = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(by) == len(rows) == n * min(top, d)
    for k in range(min(top, d)):
        signs = np.sign([by[i, k + 1]["whitened"] * white[m, k] for m, i in enumerate(ids)])
        for m, i in enumerate(ids):
            r = by[i, k + 1]
            assert r["n"] == n and r["deviation"] == sum(v * v for v in c[m])
            assert abs(r["explained"] / (e[k] / np.trace(cov)) - 1) < 1e-9 and abs(r["identity_error"]) < 1e-9
            assert abs(abs(r["whitened"]) - abs(white[m, k])) < 1e-8
        assert len(set(signs[np.abs(white[:, k]) > 1e-9])) == 1


def test_query(spark):
    t = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    good = [r for r in t if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    rows = Q.QUERIES["op13_whitening"](spark, SF_SMALL).collect()
    assert rows[0].__fields__ == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    checked(rows, [r.embedding for r in good], [r.vec_id for r in good])


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(0)
    vectors = (rng.normal(size=(60, 5)) @ rng.normal(size=(5, 5)) + rng.normal(size=5)).astype(np.float32).tolist()
    rows = [(i, v, 1) for i, v in enumerate(vectors)]
    return vectors, rows


def test_unusable_rows_are_dropped(spark, made):
    vectors, rows = made
    bad = [(900, None, 1), (901, [None] + vectors[0][1:], 1), (902, [float("nan")] + vectors[0][1:], 1),
           (903, [float("-inf")] + vectors[0][1:], 1), (904, [], 1)]
    df = spark.createDataFrame(rows + bad, SCHEMA)
    for t in (df, df.withColumns({c: F.lit("z") for c in ("row", "v", "d", "k", "w", "n", "deviation")})):
        out = W.whiten(t, ["vec_id"]).select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
        checked(out.collect(), vectors, range(60))


def test_repeats_nulls_and_lengths(spark, made):
    vectors, rows = made
    other = [(700 + i, [float(i), 1.0], None) for i in range(4)]  # a length of its own, one entry constant
    df = spark.createDataFrame(rows + [rows[0], (None, vectors[1], None)] + other, SCHEMA)
    out = W.whiten(df, ["vec_id"]).select("row.vec_id", "component", "n", "whitened", "explained", "identity_error").collect()
    assert sum(r.vec_id == 0 for r in out) == 10 and sum(r.vec_id is None for r in out) == 5
    short = sorted((r.vec_id, r.component, r.n, r.whitened) for r in out if r.vec_id and r.vec_id >= 700)
    assert [r[2] for r in short] == [4] * 8 and [r[3] for r in short if r[1] == 2] == [None] * 4
    first = [r[3] for r in short if r[1] == 1]
    assert np.allclose(np.abs(first), [3 / 5 ** .5, 1 / 5 ** .5, 1 / 5 ** .5, 3 / 5 ** .5])


def test_degenerate_tables(spark, made):
    vectors, _ = made
    none = spark.createDataFrame([], SCHEMA)
    assert W.whiten(none, ["vec_id"]).collect() == []
    assert W.whiten(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA), ["vec_id"]).collect() == []
    one = W.whiten(spark.createDataFrame([(1, vectors[0], 1)], SCHEMA), ["vec_id"]).collect()
    assert len(one) == 5 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in one)


def test_huge_entries_stay_exact(spark):
    df = spark.createDataFrame([(i, [(-1.0) ** i * 2e15 * i, 1e300 if i == 3 else float(i)], 1) for i in range(6)],
                               "vec_id long, embedding array<double>, label int")
    out = W.whiten(df, ["vec_id"]).collect()
    assert len(out) == 12 and all(abs(r.identity_error) < 1e-4 and r.deviation is None for r in out)


def test_polarisation_is_exact():
    """Covariances come from squares of sums alone, exactly, far from zero too."""
    import pyarrow as pa
    rng = np.random.default_rng(1)
    v = rng.integers(-5, 6, size=(50, 3)) / 1024 + 1e6
    batch = pa.RecordBatch.from_arrays([pa.array(v.tolist(), pa.list_(pa.float64()))], names=["v"])
    x = (v * 1024).astype(np.int64) + W.SHIFT
    centre = np.array([int(round(c)) for c in x.mean(0)])
    got = {(i, j): int(t) for b in W._squares(iter([batch]), {3: centre}) for _, i, j, t in zip(*[c.to_pylist() for c in b.columns])}
    f = W.Fit(50, [int(s) for s in x.sum(0)], got, centre.tolist(), 3)
    e = np.linalg.eigvalsh(np.cov(x.T.astype(float), bias=True))[::-1]
    assert np.allclose(f.explained, e / e.sum(), rtol=1e-9)
