"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a target of words. Complete epochs over a source come
first; what is left of its target is filled by weighted sampling without
replacement: each document draws the key -ln(u) / quality from a fixed hash
u in (0, 1) of its id, and documents enter in the order of their keys until
their sizes, summed up, come nearest to the rest.

The order is never made by one task. Keys fall into buckets of 1/256 octave
(no bucket holds more than a few thousandths of a source, whatever its
quality, unless keys are equal); bucket sums are prefix-summed per source,
which leaves one bucket per source in which its rest ends. That bucket is
divided in the same way again: into 4096 parts, by the key itself and, for
rows of one key (repeated rows, rows without id), by the row's place in the
stored table, first its high bits and then all. So equal rows are told
apart, and what is put in order are sums of small shares of a source.
The result is one cut per source, so documents join a table of sources and
their texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_SQL, stored

WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating, null last
MAX_EPOCHS = 3
PER_OCTAVE = 256
NOISE = r"[#*$%&|<>{}=!]"  # signs whose density lowers a document's quality
MIN_QUALITY = 0.05
SEED = "mix"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_SQL)), F.lit(0)).cast("long")


def quality_of(text: Column, size: Column) -> Column:
    """1 for clean prose, falling with the signs per word to MIN_QUALITY."""
    signs = F.coalesce(F.regexp_count(text, F.lit(NOISE)), F.lit(0))
    return F.greatest(F.lit(MIN_QUALITY), 1 - 2 * signs / F.greatest(size, F.lit(1)))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with _size and _key (the exponential key of the sampling order)."""
    sized = docs.withColumn("_size", size_of(F.col("text").cast("string")))
    drawn = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                              F.col("_size").cast("string")).cast("binary"))
    u = (F.conv(F.substring(drawn, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return sized.withColumn("_key", -F.ln(u) / quality_of(F.col("text").cast("string"), F.col("_size")))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from stored (source, source_size).

    All sizes together are shared by weight; a source takes at most
    MAX_EPOCHS times its size and its excess goes to the others by weight,
    until none is above. Each round is one aggregate.
    """
    order = F.col("source").asc_nulls_last()
    ranged = stored(sources.repartitionByRange(order).withColumn("pid", F.spark_partition_id()), "ranged")
    before = stored(ranged.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).select(
        "pid", (F.sum("n").over(Window.orderBy("pid")) - F.col("n")).alias("before")), "before")  # a row per partition
    place = F.row_number().over(Window.partitionBy("pid").orderBy(order)) - 1 + F.col("before")
    ranked = stored(ranged.join(before, "pid").select(
        "source", "source_size",
        F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int")).alias("w")),
        "ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    per_weight, capped = 0.0, -1
    while total:
        full = (MAX_EPOCHS * F.col("source_size")) < F.lit(per_weight) * F.col("w")
        n, used, left = ranked.agg(
            F.count_if(full), F.sum(F.when(full, MAX_EPOCHS * F.col("source_size")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("w")))).first()
        if n == capped:
            break
        capped, per_weight = n, (total - used) / left
    return ranked.select("source", "source_size", F.least(
        F.lit(float(per_weight)) * F.col("w"), (MAX_EPOCHS * F.col("source_size")).cast("double")).alias("target"))


def placed(table: DataFrame) -> DataFrame:
    """A stored table with _place, which tells rows of equal key apart: a hash of the row's file and number there."""
    return table.withColumn("_place", F.xxhash64("_metadata.file_path", "_metadata.row_index"))


#: The digits by which rows are put in order, coarse to fine; each divides the rows that agree in those before.
DIGITS = {"bucket": f"cast(floor(log2(key) * {PER_OCTAVE}) AS long)",
          "part": f"cast(floor(log2(key) * {PER_OCTAVE} * 4096) AS long)",
          "key": "struct(key, shiftright(place, 48) AS range)",
          "place": "place"}


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target, epochs, cut, cut_place): how often documents of a source enter.

    They enter ``epochs`` times, and once more if their (key, place) is at
    most (cut, cut_place). ``rows`` is a stored table of (source, size, key, place).
    """
    sums = stored(rows.groupBy("source", F.expr(DIGITS["bucket"]).alias("digit")).agg(F.sum("size").alias("size")), "buckets")
    sources = stored(sums.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    goal = targets(sources, weights).withColumn("epochs", F.when(
        F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MAX_EPOCHS)))
        .otherwise(0).cast("int"))
    goal = stored(goal.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "goal")
    # per source: the digit in which its rest ends, and the words before it
    at = goal.select(F.col("source").alias("s"), "rest", F.lit(0).cast("long").alias("before"))
    inside = rows.select("source", "size", "key", "place")
    for name, digit in DIGITS.items():
        if name != "bucket":
            sums = inside.groupBy("source", F.expr(digit).alias("digit")).agg(F.sum("size").alias("size"))
        upto = F.sum("size").over(Window.partitionBy("source").orderBy("digit"))
        same = F.col("source").eqNullSafe(F.col("s"))
        in_order = (sums.withColumn("upto", upto).join(at, same)
                    .withColumn("upto", F.col("upto") + F.col("before")))
        if name == "place":
            break
        at = stored(in_order.filter("upto > rest").groupBy("s", "rest").agg(
            F.min(F.struct("digit", (F.col("upto") - F.col("size")).alias("before"))).alias("c"))
            .select("s", "rest", "c.before", F.col("c.digit").alias("at")), f"ends-{name}")
        inside = stored(inside.withColumn("digit", F.expr(digit)).join(at, same & (F.col("digit") == F.col("at")))
                        .select("source", "size", "key", "place"), f"inside-{name}")
        if name == "key":
            last_key = at.select(F.col("s").alias("k"), F.col("at.key").alias("cut"))
        at = at.drop("at")
    # the row in which the rest ends enters if the target is nearer with it; those before it do
    entered = (in_order.filter(F.col("upto") - F.col("size") / 2 <= F.col("rest")).groupBy("s")
               .agg(F.max("digit").alias("entered")))
    ends = (at.join(entered.withColumnRenamed("s", "e"), F.col("s").eqNullSafe(F.col("e")), "left")
            .select("s", F.col("before").alias("b"), "entered"))
    first = inside.groupBy(F.col("source").alias("i")).agg(F.min("place").alias("first"))
    ends = (ends.join(first, F.col("s").eqNullSafe(F.col("i")))
            .join(last_key, F.col("s").eqNullSafe(F.col("k")))
            .select("s", "cut", F.coalesce("entered", F.col("first") - 1).alias("cut_place")))
    # a source whose rest never ends enters whole
    return stored(goal.join(ends, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "epochs", F.coalesce("cut", F.lit(float("inf"))).alias("cut"),
        F.coalesce("cut_place", F.lit((1 << 63) - 1)).alias("cut_place")), "mix-plan")


def times(key: str = "_key", place: str = "_place") -> Column:
    """How often a row that was joined to its source's plan enters the mix."""
    enters = (F.col(key) < F.col("cut")) | (F.col(key) == F.col("cut")) & (F.col(place) <= F.col("cut_place"))
    return F.col("epochs") + enters.cast("int")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``docs`` mixed: each row as often as the mix takes it, all its columns unchanged.

    A null or empty text has size 0; a null source is a source of its own,
    the last; repeated rows are sized and taken each, so that equal rows may
    enter differently often; rows of a source without words enter once; no
    rows give no rows.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)  # clash-free, whatever the columns are called
    of = dict(zip(docs.columns, names))
    have = keyed(rows.withColumns({"doc_id": F.col(of["doc_id"]), "text": F.col(of["text"])})).drop("doc_id", "text")
    have = placed(stored(have, "keyed")).withColumn("_source", F.col(of["source"]).cast("string"))
    chosen = plan(have.select(F.col("_source").alias("source"), F.col("_size").alias("size"), F.col("_key").alias("key"),
                              F.col("_place").alias("place")), weights).select(
        F.col("source").alias("_s"), "epochs", "cut", "cut_place")
    return (have.join(chosen, F.col("_source").eqNullSafe(F.col("_s")))
            .withColumn("_n", F.explode(F.array_repeat(F.lit(1), times().cast("int"))))
            .select(*names).toDF(*docs.columns))


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs``.

    Nulls as in ``mix``. Repeated rows, and rows of one id (or none) and one
    size, are taken each for itself, so that a target is met among them too;
    no rows give no rows. Other columns, whatever their names, aren't read.
    """
    rows = placed(stored(keyed(docs.select("doc_id", "text", F.col("source").cast("string").alias("source")))
                         .select("doc_id", "source", F.col("_size").alias("size"), F.col("_key").alias("key")), "sized")
                  ).withColumnRenamed("_place", "place")
    chosen = plan(rows.select("source", "size", "key", "place"), weights).withColumnRenamed("source", "_s")
    return (rows.join(chosen, F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * times("key", "place")).alias("taken")))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
keyed AS (
  SELECT doc_id, source, size,
    -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE)
        / 4503599627370496::DOUBLE)
    / greatest(0.05::DOUBLE, 1 - 2 * coalesce(len(regexp_extract_all(text, '[#*$%&|<>{}=!]')), 0)::DOUBLE / greatest(size, 1)) AS key
  FROM sized),
sources AS (
  SELECT source, source_size,
    [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
-- sources in the order in which they reach three times their size as the share per weight rises
filled AS (
  SELECT source, source_size, w, 3 * source_size AS cap,
    coalesce(sum(3 * source_size) OVER up, 0) AS used, sum(w) OVER () - coalesce(sum(w) OVER up, 0) AS left_w,
    sum(source_size) OVER () AS total
  FROM sources
  WINDOW up AS (ORDER BY 3 * source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (SELECT coalesce(arg_min((total - used)::DOUBLE / left_w, cap::DOUBLE / w) FILTER (cap >= (total - used)::DOUBLE / left_w * w), 0) AS per_w FROM filled),
goal AS (
  SELECT source, source_size, least(per_w * w, cap::DOUBLE) AS target,
    CASE WHEN source_size > 0 THEN least(floor(least(per_w * w, cap::DOUBLE) / source_size), 3) ELSE 0 END::INT AS epochs
  FROM filled, share),
summed AS (
  SELECT k.doc_id, k.size, g.source_size, g.target, g.epochs,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key ROWS UNBOUNDED PRECEDING) AS upto  -- equal keys: one each
  FROM keyed k JOIN goal g ON k.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (size * (epochs + (upto - size / 2 <= target - epochs * source_size)::INT))::BIGINT AS taken
FROM summed
"""
