"""Links, components and counts against all pairs."""

import numpy as np

from cumulus.llm import rp_forest as R

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=R.COSINE):
    ok = [r for r in rows if r[0] is not None and r[1] and r[2] is not None and None not in r[1]
          and np.isfinite(r[1]).all() and any(r[1])]
    x = [np.array(np.array(r[1], np.float32), float) for r in ok]
    n = len(ok)
    links = [[j for j in range(n) if j != i and ok[i][2] == ok[j][2] and len(x[i]) == len(x[j])
              and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= cosine] for i in range(n)]
    comp = [r[0] for r in ok]
    while (new := [min([comp[i], *(comp[j] for j in links[i])]) for i in range(n)]) != comp:
        comp = new
    out = [(r[0], len(links[i]), comp[i], comp[i] == r[0]) for i, r in enumerate(ok)]
    rest = [(r[0], 0, r[0], True) for r in rows if not any(r is o for o in ok)]
    return sorted(out + rest, key=repr)


def vectors(seed, n=900, d=16, centres=12, spread=0.07):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, d))
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            v = rng.normal(size=d)
        else:
            v = c[rng.integers(centres)] + rng.normal(size=d) * spread
        rows.append((i, np.float32(v * rng.uniform(.5, 2)).tolist(), int(rng.integers(2))))
    return rows


def got(spark, rows, **how):
    return sorted((tuple(r) for r in R.link(spark.createDataFrame(rows, SCHEMA), **how).collect()), key=repr)


def test_recall_and_no_false_links(spark):
    rows = vectors(1)
    found = got(spark, rows, leaf=40)  # several levels of splits
    want = brute(rows)
    assert all(f[1] <= w[1] for f, w in zip(found, want))
    assert sum(f[1] for f in found) >= 0.99 * sum(w[1] for w in want) > 0


def pairs_of_near_copies(seed, n, d=64):
    """Random vectors, every second one a copy of the one before at a cosine just above the limit."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(1, n, 2):
        side = rng.normal(size=d)
        side -= side @ x[i - 1] * x[i - 1]
        x[i] = 0.932 * x[i - 1] + np.sqrt(1 - 0.932 ** 2) * side / np.linalg.norm(side)
    return x.astype(np.float32)


def frame(spark, x):
    import pandas as pd
    return spark.createDataFrame(pd.DataFrame({"vec_id": range(len(x)), "embedding": x.tolist(), "label": 1}), SCHEMA)


def test_leaves_hold_about_leaf_classes_at_any_size(spark):
    for n in (1500, 9000):
        classes = frame(spark, pairs_of_near_copies(n, n)).selectExpr(
            "label", "64 as dim", "vec_id as rep", "vec_id as cid", "embedding")
        leaves = [r["leaves"] for r in R.leaves_of(classes).collect()]
        assert len(leaves) == n and all(len({x >> R.TREE for x in ls}) == R.TREES for ls in leaves)
        size = np.unique(np.concatenate(leaves), return_counts=True)[1]
        assert size.max() <= R.LEAF and np.median(size) >= R.LEAF / 3
        depth = np.log2(max(x & (1 << R.TREE) - 1 for ls in leaves for x in ls))
        assert depth >= 3


def test_recall_at_production_settings(spark):
    x = pairs_of_near_copies(5, 8000)
    found = {r["vec_id"]: r for r in R.link(frame(spark, x)).collect()}
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    links = (y @ y.T >= R.COSINE).sum(1) - 1
    assert links.sum() >= 7900
    assert all(found[i]["n_links"] <= links[i] for i in range(len(x)))
    assert sum(r["n_links"] for r in found.values()) >= 0.99 * links.sum()


def test_node_that_no_direction_divides_is_a_leaf():
    rng = np.random.default_rng(1)
    x = R.unit(np.ones((600, 32)) + rng.normal(size=(600, 32)) * 1e-3)
    nodes = R.grow(x, 1, 600, R.COSINE)
    assert nodes == {1: (-1, 0.0)}
    at, node, done = R.descend(x, 1, nodes, R.COSINE)
    assert len(at) == 600 and set(node) == {1} and done.all()


def test_clashing_columns_and_dense_leaf(spark):
    rng = np.random.default_rng(2)
    dense = np.float32(np.ones((300, 16)) + rng.normal(size=(300, 16)) * 0.01)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(dense)] + [(i + 300, v[1], v[2]) for i, v in enumerate(vectors(6, n=50))]
    from pyspark.sql import functions as F
    names = ["rep", "cid", "node", "n", "w", "dim", "leaf", "leaves", "links", "component", "done", "bucket"]
    wide = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in names})
    assert sorted((tuple(r) for r in R.link(wide, leaf=40).collect()), key=repr) == brute(rows)


def test_one_leaf_in_blocks_is_exact(spark):
    rows = vectors(2, n=300)
    keep = R.BLOCK
    R.BLOCK = 37
    try:
        assert got(spark, rows) == brute(rows)
    finally:
        R.BLOCK = keep


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(3, n=40) + [(100, None, 1), (101, [], 1), (102, [0.] * 16, 1), (103, [nan] * 16, 1),
                               (104, [inf] + [1.] * 15, 1), (105, [None] + [1.] * 15, 1), (106, [1.] * 16, None),
                               (None, [1.] * 16, 1), (107, [1.] * 16, 1), (108, [1.] * 16, 1), (109, [2.] * 16, 1),
                               (110, [1.] * 8, 1), (111, [1.] * 8, 1), (112, [1.] * 16, 0)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_oracle_on_linked_vectors(spark):
    import duckdb
    rows = vectors(4, n=200) + [(900, None, 1), (901, [0.] * 16, 1), (902, [1.] * 16, None)]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    duck.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    rel = duck.sql(R.ORACLE)
    cols = ["vec_id", "n_links", "component_id", "kept"]
    want = sorted((tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall()), key=repr)
    assert got(spark, rows) == want and sum(w[1] for w in want) > 0
