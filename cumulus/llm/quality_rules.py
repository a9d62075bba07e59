"""Quality rules: robust multivariate outliers among document statistics.

Every text gives counts (words, symbols, repeated lines, repeated five-word
windows) and a vector of transformed shares. A document whose base rule
fails is out; the others are judged, within their language and source, by
the Mahalanobis distance to the minimum covariance determinant (MCD)
estimate of the group. Estimates are made for every language and source,
every language, and all rows; a group's own counts by its rows, and that of
its language (of all rows, for the language) as OTHERS rows more. So every
group is judged the same way, however small.

MCD by deterministic starts and concentration steps. Three starts
(distance to the coordinate medians scaled by the median deviations, tanh
scores, spatial signs) give first estimates; a concentration step takes
the fraction COVER of the rows nearest to the estimate and re-estimates
mean and covariance from them, which never raises the determinant. After
two steps the start of the smallest determinant goes on alone, and one
reweighting step follows. Every step is one pass over the small vector
table: rows are counted, summed and cross-summed by (group, distance bin)
with map-side combine, and the few bins of a group are cumulated. No group
is gathered, so a source with a third of all rows costs what its rows cost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import salted_join
from .common import stored

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEATED = 20  # percent of words in repeated five-word windows
WINDOW = 5
COVER = 0.6  # share of a group's rows that the estimate rests on, at least
STEPS = 3  # concentration steps after the choice of a start
OTHERS = 30.0  # rows that the estimate of the language, or of all rows, counts as
LEVEL = 0.9999  # chi-square level beyond which a document is an outlier
PRIOR = 30.0  # words by which shares of short texts are drawn to typical ones
PER_OCTAVE, LOWEST, BINS = 4, -6, 100  # distance bins
#: name, typical share (the prior's), smallest standard deviation taken as real
FEATURES = (("word_length", 4.6, 0.1), ("symbols", 0.01, 0.015), ("capitals", 0.03, 0.02),
            ("digits", 0.002, 0.05), ("marks", 0.12, 0.03), ("repeats", 0.01, 0.05))
P = len(FEATURES)


# ---------------------------------------------------------------- statistics of a text


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur at least twice, the first included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    base = len(ids)
    key, span = code[:n], base
    for i in range(1, size):
        if span > (1 << 62) // base:  # rank the keys so far, exactly, before they overflow
            uniq, key = np.unique(key, return_inverse=True)
            span = len(uniq)
        key = key * base + code[i:n + i]
        span *= base
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def counts(text: str | None) -> tuple[list[int], list[float]]:
    """[n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words] and the feature vector."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines, dup = set(), 0
    for line in text.split("\n"):
        if line in lines:
            dup += 1
        elif line.strip(" \t\v\f\r"):
            lines.add(line)
    repeats = repeated_words(words)
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=128)
    share = lambda k, over, prior: math.sqrt((k + PRIOR * prior) / (over + PRIOR))
    odd = int(byte[33:48].sum() + byte[58:65].sum() + byte[91:97].sum() + byte[123:127].sum()) - symbols
    v = [(chars + PRIOR * FEATURES[0][1]) / (n + PRIOR), share(symbols, n, FEATURES[1][1]),
         share(int(byte[65:91].sum()), chars, FEATURES[2][1]), share(int(byte[48:58].sum()), chars, FEATURES[3][1]),
         share(odd, n, FEATURES[4][1]), share(repeats, n, FEATURES[5][1])]
    return [n, chars, symbols, dup, repeats], v


def measured(docs: DataFrame, carry: list[str]) -> DataFrame:
    """(row, key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, v) of every row.

    ``row`` holds the columns ``carry`` of ``docs`` unchanged; key names the
    language and source (null is a value of its own), as a JSON array.
    """
    rows = docs.select(F.struct(*carry).alias("row"), F.col("text").cast("string").alias("text"),
                       F.to_json(F.array(F.col("lang").cast("string"), F.col("source").cast("string"))).alias("key"))
    ints = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [counts(t.as_py()) for t in b.column(1)]
            c = np.array([x for x, _ in got], np.int64).reshape(-1, 5)
            failed = (c[:, 0] < MIN_WORDS) | (100 * c[:, 4] > MAX_REPEATED * c[:, 0])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), *(pa.array(c[:, i]) for i in range(5)), pa.array(failed),
                 pa.array([v for _, v in got], pa.list_(pa.float64()))],
                ["row", "key", *ints, "base_failed", "v"])
    row = rows.schema["row"].dataType.simpleString()
    return rows.select("row", "text", "key").mapInArrow(
        run, f"row {row}, key string, {', '.join(f'{i} long' for i in ints)}, base_failed boolean, v array<double>")


# ---------------------------------------------------------------- chi-square


def chi2_cdf(x: float, k: int) -> float:
    """Lower regularised gamma function by its series."""
    if x <= 0:
        return 0.0
    a, h = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-14:
        n += 1
        term *= h / n
        total += term
    return min(1.0, total * math.exp(a * math.log(h) - h - math.lgamma(a)))


def chi2_quantile(q: float, k: int) -> float:
    z = NormalDist().inv_cdf(q)
    lo, hi = 0.0, 4 * k * (1 + abs(z)) ** 2 + 40
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < q else (lo, mid)
    return hi


# ---------------------------------------------------------------- minimum covariance determinant

PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
FLOOR = np.array([f for _, _, f in FEATURES]) ** 2
RIDGE = 1e-6  # part of each variance that is added, so that the covariance can be inverted
ESTIMATE = "gkey string, start int, m array<double>, prec array<double>, det double, scale double"


def _distance(v: str = "v", m: str = "m", prec: str = "prec"):
    """Squared Mahalanobis distance as one generated expression."""
    d = [F.col(v)[i] - F.col(m)[i] for i in range(P)]
    return sum((d[i] * d[j] * F.col(prec)[i * P + j] * (1 if i == j else 2) for i, j in PAIRS[1:]),
               d[0] * d[0] * F.col(prec)[0])


def _bin(d2):
    at = F.floor(F.log2(F.greatest(d2, F.lit(2.0 ** LOWEST))) * PER_OCTAVE) - LOWEST * PER_OCTAVE
    return F.least(F.greatest(at, F.lit(0)), F.lit(BINS - 1)).cast("int")


def _upper(b: np.ndarray) -> np.ndarray:
    return 2.0 ** ((b + 1) / PER_OCTAVE + LOWEST)


def _estimate(gkey: str, start: int, n: float, s: np.ndarray, ss: np.ndarray, cover: float) -> dict:
    """Mean, inverse covariance and determinant of summed rows that cover a share of their group."""
    m = s / n
    cov = np.zeros((P, P))
    for (i, j), x in zip(PAIRS, ss):
        cov[i, j] = cov[j, i] = x / n - m[i] * m[j]
    scale = cover / max(chi2_cdf(chi2_quantile(cover, P), P + 2), 1e-9) if cover < 1 else 1.0
    cov *= scale
    own = np.diag(cov)  # the group's own spread counts, but for statistics that hardly vary in it
    cov = cov + np.diag(np.maximum(FLOOR - own, 0) + RIDGE * np.maximum(own, FLOOR))
    return {"gkey": gkey, "start": start, "m": m.tolist(), "prec": np.linalg.inv(cov).ravel().tolist(),
            "det": float(np.linalg.slogdet(cov)[1]), "scale": scale}


def _sums(rows: DataFrame, by: list) -> DataFrame:
    v = F.col("v")
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(v[i]) for i in range(P)]).alias("s"),
        F.array(*[F.sum(v[i] * v[j]) for i, j in PAIRS]).alias("ss"))


def _step(rows: DataFrame, now: DataFrame, cutoff: float | None = None) -> DataFrame:
    """New estimates from the rows nearest to the present ones.

    The nearest share COVER (whole distance bins), or with ``cutoff`` the
    rows within that distance (the reweighting step).
    """
    def choose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        n = pdf["n"].to_numpy(float)
        cum = n.cumsum()
        if cutoff is None:
            k = int(np.searchsorted(cum, COVER * cum[-1])) + 1
            cover = float(cum[k - 1] / cum[-1])
        else:
            k = max(1, int((_upper(pdf["bin"].to_numpy()) <= cutoff).sum()))
            cover = chi2_cdf(cutoff, P)
        s = np.vstack(pdf["s"].to_numpy())[:k].sum(0)
        ss = np.vstack(pdf["ss"].to_numpy())[:k].sum(0)
        return pd.DataFrame([_estimate(key[0], int(key[1]), float(cum[k - 1]), s, ss, cover)])

    # salted: a shuffle by gkey alone would also serve the sums, and bring a hot group's rows to one task
    near = salted_join(rows, now.select("gkey", "start", "m", "prec"), "gkey").withColumn("bin", _bin(_distance()))
    return stored(_sums(near, ["gkey", "start", "bin"]).groupBy("gkey", "start")
                  .applyInPandas(choose, ESTIMATE), "mcd")


def _starts(rows: DataFrame) -> DataFrame:
    """Three estimates per group: scaled medians, tanh scores, spatial signs."""
    med = stored(rows.groupBy("gkey").agg(F.array(*[
        F.percentile_approx(F.col("v")[i], 0.5, 2000) for i in range(P)]).alias("m")), "median")
    dev = stored(salted_join(rows, med, "gkey").groupBy("gkey").agg(
        F.first("m").alias("m"), F.array(*[F.percentile_approx(F.abs(F.col("v")[i] - F.col("m")[i]), 0.5, 2000)
                                            for i in range(P)]).alias("dev")), "deviation")
    sd = [F.greatest(1.4826 * F.col("dev")[i], F.lit(float(FLOOR[i] ** 0.5))) for i in range(P)]
    z = salted_join(rows, dev, "gkey").select("gkey", "m", "dev", F.array(*[
        (F.col("v")[i] - F.col("m")[i]) / sd[i] for i in range(P)]).alias("z"))
    norm = F.greatest(sum((F.pow(F.col("z")[i], 2) for i in range(P)), F.lit(0.0)), F.lit(1e-12))
    agg = z.groupBy("gkey").agg(
        F.first("m").alias("m"), F.first("dev").alias("dev"),
        F.array(*[F.avg(F.tanh(F.col("z")[i]) * F.tanh(F.col("z")[j])) for i, j in PAIRS]).alias("tanh"),
        F.array(*[F.avg(F.col("z")[i] * F.col("z")[j] / norm) for i, j in PAIRS]).alias("sign"))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                sd = np.maximum(1.4826 * np.array(r.dev), np.sqrt(FLOOR))
                for start, pairs in enumerate((None, r.tanh, r.sign)):
                    corr = np.eye(P)
                    if pairs is not None:
                        for (i, j), x in zip(PAIRS, pairs):
                            corr[i, j] = corr[j, i] = x
                        d = np.sqrt(np.maximum(np.diag(corr), 1e-9))
                        corr = corr / np.outer(d, d) * 0.95 + 0.05 * np.eye(P)
                    cov = corr * np.outer(sd, sd)
                    out.append({"gkey": r.gkey, "start": start, "m": list(r.m),
                                "prec": np.linalg.inv(cov).ravel().tolist(), "det": 0.0, "scale": 1.0})
            yield pd.DataFrame(out, columns=["gkey", "start", "m", "prec", "det", "scale"])
    return stored(agg.mapInPandas(build, ESTIMATE), "starts")


def estimates(rows: DataFrame) -> DataFrame:
    """(gkey, m, prec): reweighted MCD estimate of every group of (gkey, v)."""
    now = _step(rows, _step(rows, _starts(rows)))
    best = F.min_by(F.struct("start", "m", "prec", "det", "scale"), F.struct("det", "start"))
    now = stored(now.groupBy("gkey").agg(best.alias("e")).select("gkey", "e.*"), "best")
    for _ in range(STEPS):
        now = _step(rows, now)
    return _step(rows, now, chi2_quantile(0.975, P)).select("gkey", "m", "prec")


ALL = "all"  # no JSON array, hence no language's or group's key


def language(key: str):
    """The key of a group's language: a JSON array of it alone."""
    return F.to_json(F.array(F.get_json_object(key, "$[0]")))


def blended(usable: DataFrame, found: DataFrame) -> DataFrame:
    """(key, m, prec) of every group: its estimate, its language's and that of all rows, weighted by rows.

    Means and covariances are weighted alike: the language's estimate of n
    rows takes n parts of n + OTHERS beside that of all rows, then the
    group's of n rows beside the outcome.
    """
    groups = stored(usable.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("lkey", language("key")), "groups")
    languages = groups.groupBy("lkey").agg(F.sum("n").alias("ln"))
    found = stored(found, "mcd-estimates")
    both = [found.select(F.col("gkey").alias(key), F.struct("m", "prec").alias(name))
            for key, name in (("key", "own"), ("lkey", "of_language"))]
    sides = groups.join(languages, "lkey").join(both[0], "key").join(both[1], "lkey")
    every = found.filter(F.col("gkey") == ALL).select("m", "prec").first()  # one row of P + P * P numbers

    def mix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, n, ln, *two in pdf.itertuples(index=False):
                (m1, c1), (m2, c2), (m3, c3) = [
                    (np.array(x["m"]), np.linalg.inv(np.array(x["prec"]).reshape(P, P))) for x in (*two, every)]
                of_language = ln / (ln + OTHERS)
                own = n / (n + OTHERS)
                m = own * m1 + (1 - own) * (of_language * m2 + (1 - of_language) * m3)
                cov = own * c1 + (1 - own) * (of_language * c2 + (1 - of_language) * c3)
                out.append({"key": key, "m": m.tolist(), "prec": np.linalg.inv(cov).ravel().tolist()})
            yield pd.DataFrame(out, columns=["key", "m", "prec"])
    return sides.select("key", "n", "ln", "own", "of_language").mapInPandas(
        mix, "key string, m array<double>, prec array<double>")


def judged(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The columns of ``measured`` with distance (squared) and kept, one row per row of ``docs``.

    Null and empty texts fail the base rule, like texts of fewer than ten
    words, and have no distance; every other row has one. Null languages and
    sources form groups of their own; a group of one row is judged by its
    language's estimate almost alone, and a row that is alone in the table
    is its own estimate and kept. Equal rows get equal verdicts; no rows
    give no rows.
    """
    all_rows = stored(measured(docs, carry), "measured")
    usable = all_rows.filter(~F.col("base_failed"))
    rows = stored(usable.select(F.explode(F.array("key", language("key"), F.lit(ALL))).alias("gkey"), "v"), "usable")
    of_groups = stored(blended(usable, estimates(rows)), "group-estimates")
    out = all_rows.join(of_groups, "key", "left").withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(
        F.col("distance") <= chi2_quantile(LEVEL, P), F.lit(False))).drop("m", "prec", "key")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    return judged(docs, docs.columns).filter("kept").select("row.*")
