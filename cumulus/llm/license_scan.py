"""Licence scan by ordered signature rules, in DataFrame expressions only.

A text's words (runs of digits, letters and non-ASCII characters) are joined
so that each stands between single blanks. Two prefilters spare most work:
texts without any root string are not normalised, and a rule runs only on
texts with its keyword. Matches become intervals of word positions. A
detection is suppressed when another of at least its priority contains its
interval (of equal intervals the higher priority, then the earlier rule,
stays): intervals sorted by start and falling end need one scan that keeps
the furthest end per priority.

Everything happens within a row, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import license_rules

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
LEVELS = 4


def normalised(text: Column) -> Column:
    """Words, each between single blanks; empty without a word. A-Z in lower case."""
    words = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), GAP, "  "))
    return F.when(words == "", "").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def words_in(wrapped: Column) -> Column:
    return F.floor((F.length(wrapped) - F.length(F.replace(wrapped, F.lit(" "), F.lit("")))) / 2).cast("long")


def _spans(norm: str, pattern: str) -> str:
    """SQL: the (start, end) word intervals of a pattern's matches."""
    words = "CAST(floor((length({0}) - length(replace({0}, ' ', ''))) / 2) AS BIGINT)"
    return f"""
      aggregate(
        zip_with(split({norm}, {pattern}, -1), regexp_extract_all({norm}, {pattern}, 0),
                 (p, m) -> named_struct('a', {words.format("coalesce(p, '')")}, 'b', {words.format('m')})),
        named_struct('at', 0L, 'spans', CAST(array() AS array<struct<s: bigint, e: bigint>>)),
        (acc, x) -> named_struct(
          'at', acc.at + x.a + coalesce(x.b, 0L),
          'spans', CASE WHEN x.b IS NULL THEN acc.spans
                   ELSE concat(acc.spans, array(named_struct('s', acc.at + x.a, 'e', acc.at + x.a + x.b))) END),
        acc -> acc.spans)"""


def _matching(norm: Column) -> Column:
    """The rules that match, in order of their keywords: each keyword is looked for once, and only where a text has it
    are its rules' patterns tried, which are literals and so compiled once."""
    by_keyword: dict[str, list[Column]] = {}
    for i, (label, prio, conf, kw, pattern) in enumerate(license_rules.rules()):
        regex = license_rules.regex(pattern)
        rule = F.struct(F.lit(i).alias("i"), F.lit(label).alias("label"), F.lit(prio).alias("prio"),
                        F.lit(float(conf)).alias("conf"), F.lit(regex).alias("pattern"))
        by_keyword.setdefault(kw, []).append(F.when(norm.rlike(regex), rule))
    return F.flatten(F.array_compact(F.array(*[F.when(norm.contains(f" {kw}"), F.array_compact(F.array(*found)))
                                               for kw, found in by_keyword.items()])))


#: Detections of a row: (s, e, prio, i, label, conf), in scanning order.
_FOUND = f"""
  array_sort(flatten(transform(
    rules,
    r -> transform({_spans('norm', 'r.pattern')}, x -> named_struct(
      's', x.s, 'e', x.e, 'prio', r.prio, 'i', r.i, 'label', r.label, 'conf', r.conf)))),
    (a, b) -> CASE WHEN a.s <> b.s THEN CAST(sign(a.s - b.s) AS INT) WHEN a.e <> b.e THEN CAST(sign(b.e - a.e) AS INT)
                   WHEN a.prio <> b.prio THEN b.prio - a.prio ELSE a.i - b.i END)"""

#: One scan: ends[p] is the furthest end of a detection of priority p so far.
_KEPT = """
  aggregate(found,
    named_struct('ends', array_repeat(0L, {levels}), 'labels', CAST(array() AS array<string>), 'conf', 0D),
    (acc, d) -> named_struct(
      'ends', transform(acc.ends, (x, p) -> CASE WHEN p + 1 = d.prio THEN greatest(x, d.e) ELSE x END),
      'labels', CASE WHEN array_max(slice(acc.ends, d.prio, {levels})) >= d.e OR array_contains(acc.labels, d.label)
                THEN acc.labels ELSE concat(acc.labels, array(d.label)) END,
      'conf', CASE WHEN array_max(slice(acc.ends, d.prio, {levels})) >= d.e THEN acc.conf
              ELSE greatest(acc.conf, d.conf) END))""".format(levels=LEVELS)


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, found and kept.

    ``found`` lists all detections (s, e: words from 0, end excluded), kept
    holds the labels that suppression leaves and the highest confidence of
    them. A null or empty text has no words and no detections. Columns of
    the same names in ``docs`` are replaced; every row gives one row.
    """
    mine = ["n_words", "n_base", "first_word", "last_word", "base_labels", "found", "kept"]
    theirs = [c for c in docs.columns if c not in mine]
    names = [f"c{i}" for i in range(len(theirs))]  # clash-free, whatever the columns are called
    rows = docs.select(*theirs).toDF(*names)
    rows = rows.withColumn("text", F.coalesce(F.col(names[theirs.index("text")]).cast("string"), F.lit("")))
    low = F.lower("text")  # only for the prefilter: more texts may pass than need to
    root = low.contains(license_rules.ROOTS[0])
    for r in license_rules.ROOTS[1:]:
        root = root | low.contains(r)
    once = rows.withColumns({"n_words": F.regexp_count("text", F.lit(WORD)).cast("long"),
                             "norm": F.when(root, normalised(F.col("text"))).otherwise("")})
    pattern = "|".join(license_rules.regex(p) for p, _ in BASE)
    # a generator of one row keeps Catalyst from computing an expression again wherever it is used
    at_base = once.select(*once.columns, F.explode(F.array(F.when(F.col("norm").rlike(pattern), F.struct(
        F.split("norm", pattern, -1).alias("p"), F.regexp_extract_all("norm", F.lit(pattern), F.lit(0)).alias("m")))))
        .alias("b"))
    has = F.col("b").isNotNull()
    first = words_in(F.element_at("b.p", 1))
    last = F.col("n_words") - words_in(F.element_at("b.p", -1)) - words_in(F.element_at("b.m", -1))
    phrases = [F.when(F.array_contains("b.m", license_rules.regex(p)), F.lit(label)) for p, label in BASE]
    counted = at_base.withColumns({
        "n_base": F.when(has, F.size("b.m")).otherwise(0).cast("long"),
        "first_word": F.when(has, first), "last_word": F.when(has, last),
        "base_labels": F.when(has, F.array_sort(F.array_compact(F.array(*phrases)))).otherwise(
            F.array().cast("array<string>"))}).drop("b")
    cols = [*names, *mine[:5]]
    found = counted.withColumn("rules", F.when(F.col("norm") != "", _matching(F.col("norm")))).select(
        *cols, F.explode(F.array(F.coalesce(F.expr(_FOUND), F.expr(
            "CAST(array() AS array<struct<s: bigint, e: bigint, prio: int, i: int, label: string, conf: double>>)"))))
        .alias("found"))
    return found.withColumn("kept", F.expr(_KEPT)).toDF(*theirs, *mine)


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns of a scan."""
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", "kept.labels")))
    base = F.when(F.size("base_labels") > 0, 0.5).otherwise(0.0)
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                          F.array_join("base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
                          F.greatest("kept.conf", base).alias("score"))
