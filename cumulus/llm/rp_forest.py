"""Embedding near-duplicates by a forest of random-projection trees.

A tree splits the unit vectors of a label at the median of a random
direction, again and again, until a leaf holds at most LEAF classes; vectors
within a margin of the threshold go to both sides (spill). The margin is a
share of the spread that the difference of two linked vectors has along a
random direction, so a linked pair is rarely parted in one tree and
practically never in all.

Trees grow in rounds, to any depth: a round draws a bounded sample of every
node that is still too large, fits the node's next levels on it, and routes
the node's members, dealt over tasks by a hash. A node that no direction
divides well (both sides would keep most of it) stays a leaf.

Equal vectors are one class, compared once. Within a leaf all classes are
compared by cosine in double precision; a leaf of more than BLOCK classes
is dealt as pairs of blocks over many tasks. A pair that meets in several
leaves counts in the first of them only, which its two leaf lists tell, so
link counts need no list of pairs. What leaves a task is, per vector, its
number of links there and the root of its linked group; these are united by
connected components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import connected_components

COSINE = 0.93
TREES = 5
MARGIN = 0.65  # of the standard deviation of a borderline pair's difference along a direction
SAMPLE = 4096  # classes of a node that its next levels are fitted on, by hash
LEAF = 128  # classes a leaf may hold
LEAST = 32  # sampled classes below which the next round goes on with a node
MOST = 0.7  # share of a node that a side may keep: two sides of more cost more than the node itself
TRIES = 4  # directions tried for a split
GROUP = 20_000  # classes routed at once
BLOCK = 1024  # classes compared at once
TREE = 48  # a node's number: its tree above this bit, its path (1 for the root) below
SEED = 7


def matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """The vectors, all of one length and without nulls, as rows."""
    return np.asarray(pc.list_flatten(vectors), np.float64).reshape(len(vectors), -1)


def unit(rows: list | np.ndarray) -> np.ndarray:
    x = np.asarray(rows, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def margin(d: int, cosine: float) -> float:
    return MARGIN * np.sqrt(2 - 2 * cosine) / np.sqrt(d)


def direction(d: int, node: int, way: int) -> np.ndarray:
    u = np.random.default_rng([SEED, d, node, way]).normal(size=d)
    return u / np.linalg.norm(u)


def grow(x: np.ndarray, root: int, n: int, cosine: float, leaf: int = LEAF) -> dict[int, tuple[int, float]]:
    """{node: (direction, cut)} of the levels under ``root``, fitted on ``x``, a sample of its ``n`` classes.

    Direction -1: the node stays a leaf. A node that isn't named is small
    enough, or has too few sampled classes to be split in this round.
    """
    nodes: dict[int, tuple[int, float]] = {}
    each, m = n / max(1, len(x)), margin(x.shape[1], cosine)
    todo = [(root, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if node != root and (len(rows) * each <= leaf or len(rows) < LEAST):
            continue
        nodes[node] = (-1, 0.0)
        path = node & (1 << TREE) - 1
        for way in range(TRIES if path < 1 << TREE - 1 else 0):
            p = x[rows] @ direction(x.shape[1], node, way)
            cut = float(np.median(p))
            sides = [rows[p <= cut + m], rows[p >= cut - m]]
            if max(map(len, sides)) <= MOST * len(rows):
                nodes[node] = (way, cut)
                todo += [(child(node, k), side) for k, side in enumerate(sides)]
                break
    return nodes


def child(node: int, side: int) -> int:
    tree, path = node >> TREE, node & (1 << TREE) - 1
    return tree << TREE | 2 * path + side


def descend(x: np.ndarray, root: int, nodes: dict[int, tuple[int, float]], cosine: float
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, node, done) for every node in which a row of ``x`` ends; done: no later round splits it."""
    m = margin(x.shape[1], cosine)
    ends: list[tuple[np.ndarray, int, bool]] = []
    todo = [(root, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        way, cut = nodes.get(node, (-1, 0.0))
        if way < 0:
            ends.append((rows, node, node in nodes or not nodes))
            continue
        p = x[rows] @ direction(x.shape[1], node, way)
        todo += [(child(node, 0), rows[p <= cut + m]), (child(node, 1), rows[p >= cut - m])]
    at = np.concatenate([rows for rows, _, _ in ends])
    return (at, np.concatenate([np.full(len(rows), node, np.int64) for rows, node, _ in ends]),
            np.concatenate([np.full(len(rows), done) for rows, _, done in ends]))


def leaves_of(classes: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(rep, cid, leaves) of (label, dim, rep, cid, embedding): a label of at most ``leaf`` classes is leaf 0."""
    kind = {f.name: f.dataType.simpleString() for f in classes.schema}
    key, own = ["label", "dim", "node"], ["label", "dim", "rep", "cid", "embedding"]
    label = f"label {kind['label']}, dim int"
    number = F.xxhash64("rep", "cid")

    def fit(group: tuple, table: pa.Table) -> pa.Table:
        node = group[2].as_py()
        nodes = grow(unit(matrix(table.column("embedding"))), node, table.column("n")[0].as_py(), cosine,
                     leaf)
        return pa.table({"label": table.column("label").slice(0, 1), "dim": table.column("dim").slice(0, 1),
                         "node": pa.array([node]), "n": table.column("n").slice(0, 1),
                         "nodes": pa.array([list(nodes)], pa.list_(pa.int64())),
                         "ways": pa.array([[w for w, _ in nodes.values()]], pa.list_(pa.int64())),
                         "cuts": pa.array([[c for _, c in nodes.values()]], pa.list_(pa.float64()))})

    def route(group: tuple, rows: pa.Table, model: pa.Table) -> pa.Table:
        nodes: dict[int, tuple[int, float]] = {}
        for r in model.select(["nodes", "ways", "cuts"]).to_pylist():
            nodes |= zip(r["nodes"], zip(r["ways"], r["cuts"]))
        x = unit(matrix(rows.column("embedding"))) if len(rows) else np.empty((0, group[1].as_py()))
        at, node, done = descend(x, group[2].as_py(), nodes, cosine)
        return rows.select(own).take(at).append_column("node", pa.array(node)).append_column("done", pa.array(done))

    roots = F.array(*[F.lit(t << TREE | 1) for t in range(trees)])
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    at = stored(classes.join(stored(sizes, "label-sizes"), ["label", "dim"]).select(
        *own, F.explode(F.when(F.col("n") > leaf, roots).otherwise(F.array(F.lit(0).cast("long")))).alias("node"),
        (F.col("n") <= leaf).alias("done")), "nodes")
    ends = []
    while True:
        large = stored(at.filter(~F.col("done")).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
                       .filter(F.col("n") > leaf), "large-nodes")
        if large.isEmpty():
            break
        ends.append(at.join(large, key, "left_anti").select("rep", "cid", "node"))
        members = at.join(large, key).withColumn("bucket", F.pmod(number, F.ceil(F.col("n") / GROUP)))
        drawn = members.filter(F.shiftrightunsigned(number, 20) / F.lit(1 << 44) * F.col("n") < SAMPLE)
        models = stored(drawn.select(*key, "n", "embedding").groupBy(*key).applyInArrow(
            fit, f"{label}, node long, n long, nodes array<long>, ways array<long>, cuts array<double>"), "models")
        models = models.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / GROUP) - 1)))
        at = stored(members.groupBy(*key, "bucket").cogroup(models.groupBy(*key, "bucket")).applyInArrow(
            route, f"{label}, rep long, cid long, embedding {kind['embedding']}, node long, done boolean"), "nodes")
    ends.append(at.select("rep", "cid", "node"))
    found = ends[0]
    for more in ends[1:]:
        found = found.union(more)
    return found.groupBy("rep", "cid").agg(F.sort_array(F.collect_list("node")).alias("leaves"))


def _valid(vec, label, vec_id):
    d = F.transform(vec, lambda x: x.cast("double"))
    finite = ~F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vec_id.isNotNull() & label.isNotNull() & vec.isNotNull() & finite & F.exists(d, lambda x: x != 0))


def compare(x: np.ndarray, weight: np.ndarray, first: np.ndarray, row: np.ndarray, leaf: np.ndarray, cosine: float
            ) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of unit vectors that share a leaf.

    ``first`` is False for vectors of the left block, True for the right
    one: pairs are made across, or among all if there is one block only.
    ``row`` also lies in ``leaf``, which is before this one.
    """
    n = len(x)
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    if first.any():
        linked &= first[:, None] != first[None, :]
    at = np.flatnonzero(linked.any(1)[row]) if len(row) else []
    if len(at):  # pairs that meet before are found there
        seen, number = np.unique(leaf[at], return_inverse=True)
        member = np.zeros((n, len(seen)), np.float32)
        member[row[at], number] = 1
        linked &= (member @ member.T) == 0
    links = linked @ weight
    root = np.arange(n)
    while len(at := np.flatnonzero(links)):
        low = np.minimum(root[at], np.where(linked[at], root[None, :], n).min(1))
        if (low == root[at]).all():
            break
        root[at] = low
    return links, root


def link(rows: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label).

    Vectors link when their labels and dimensions are equal and their cosine
    is at least ``cosine``. Vectors without id or label, null, empty or zero,
    or with a null or non-finite component link with nothing and are kept
    (their component is their own id). Equal vectors link with each other;
    equal rows are vectors of their own, of one id. No rows give no rows.
    """
    rows = stored(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label"), "vectors")
    good = rows.filter(_valid(F.col("embedding"), F.col("label"), F.col("vec_id")))
    classes = stored(good.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("w"))
        .withColumns({"dim": F.size("embedding"), "cid": F.xxhash64("label", "embedding")}), "classes")
    routed = stored(classes.join(leaves_of(classes.drop("w"), cosine, trees, leaf), ["rep", "cid"])
                    .select("embedding", "rep", "w", "label", "dim", "leaves"), "routed")
    key = ["label", "dim", "leaf"]
    members = routed.withColumn("leaf", F.explode("leaves"))
    blocks = stored(members.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks")),
                    "leaf-blocks")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (members.join(blocks, key).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
             .select(*key, "i", "j", (F.col("own") != F.col("i")).alias("right"), "rep", "w", "embedding", "leaves"))

    def within(group: tuple, table: pa.Table) -> pa.Table:
        leaves = table.column("leaves").combine_chunks()
        row, leaf = (np.asarray(f(leaves)) for f in (pc.list_parent_indices, pc.list_flatten))
        before = leaf < group[2].as_py()
        rep = table.column("rep").to_numpy()
        links, root = compare(unit(matrix(table.column("embedding"))), table.column("w").to_numpy(),
                              table.column("right").to_numpy().astype(bool), row[before], leaf[before], cosine)
        at = np.flatnonzero(links)
        return pa.table({"rep": pa.array(rep[at]), "links": pa.array(links[at].astype(np.int64)),
                         "root": pa.array(rep[root[at]])})
    found = stored(dealt.groupBy(*key, "i", "j").applyInArrow(within, "rep long, links long, root long"), "found")
    comp = connected_components(found.filter("rep != root"), "rep", "root")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    result = stored(classes.join(linked, "rep", "left").filter("w > 1 or links is not null")
                    .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
                    .select(F.col("label").alias("l"), F.col("embedding").alias("e"),
                            (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("links"),
                            F.coalesce("component", "rep").alias("component")), "class-result")
    is_good = _valid(F.col("embedding"), F.col("label"), F.col("vec_id"))
    joined = rows.join(result, is_good & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")), "left")
    component = F.coalesce("component", "vec_id")
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


ORACLE = """
WITH RECURSIVE valid AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM valid a JOIN valid b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
found AS (
  SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id
  FROM embeddings LEFT JOIN (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u) USING (vec_id)
  LEFT JOIN (SELECT u AS vec_id, min(v) AS low FROM reach GROUP BY u) USING (vec_id))
SELECT *, vec_id IS NULL OR vec_id = component_id AS kept FROM found
"""
