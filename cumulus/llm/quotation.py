"""Quotation linking: reply-ordered conversations without quotes.

A line's quote level is the number of ``>`` that lead it. Consecutive lines
of one level are a passage; passages of level 0 are a message's own. Quoted
passages are normalised (case, white space), hashed whole, by paragraph and
by line, and joined to the messages in whose own passages the same unit
stands: to the first such message of the conversation before the quoting
one, else, for whole passages and paragraphs, to the first of any earlier
conversation. The first passage of level 1 that links, by its largest
linked unit, names the message that is replied to. Replies are followed to
the message that began the thread, by pointer doubling, and every
conversation is ordered by thread, then by turn.

DataFrame expressions only. A message's lines never leave its row; the index
of originals has one row per unit (an aggregate with map-side combine), so
a passage that many messages quote joins one row; positions are counted
over range partitions, so a conversation of any size spreads over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

PREFIX = r"^[ \t]*(?:>[ \t]*)*"
PARAGRAPH = r"\n[ \t]*\n"
LEVELS = (3, 2, 1)  # whole passage, paragraph, line


def _lines(text):
    """Lines as (d, c): quote level and content."""
    def line(x):
        p = F.regexp_extract(x, PREFIX, 0)
        d = F.length(p) - F.length(F.replace(p, F.lit(">"), F.lit("")))
        return F.struct(d.alias("d"), F.when(d > 0, F.substr(x, F.length(p) + 1)).otherwise(x).alias("c"))
    return F.transform(F.split(text, "\n", -1), line)


def _passages():
    """SQL: runs of lines of one level, as (d, t), from the column ``lines``."""
    return """
      transform(
        filter(sequence(1, size(lines)), i -> i = 1 OR lines[i - 1].d <> lines[greatest(i, 2) - 2].d),
        (s, k) -> named_struct('d', lines[s - 1].d, 's', s))"""


def _norm(x: str) -> str:
    return f"lower(trim(regexp_replace({x}, '\\\\s+', ' ')))"


#: SQL: units of a passage text ``t``: (level, md5 of the normalised unit), without empty ones.
_UNITS = f"""
  filter(concat(
      array(named_struct('level', 3, 'n', {_norm('t')})),
      transform(split(t, '\\\\n[ \\\\t]*\\\\n', -1), x -> named_struct('level', 2, 'n', {_norm('x')})),
      transform(split(t, '\\\\n', -1), x -> named_struct('level', 1, 'n', {_norm('x')}))),
    u -> u.n <> '')"""


def _message_passages(messages: DataFrame) -> DataFrame:
    """(mid, conv_id, turn, p, d, t): the passages of messages, in order."""
    starts = messages.withColumn("starts", F.expr(_passages()))
    cut = starts.select("mid", "conv_id", "turn", "lines", "starts", F.posexplode("starts").alias("p", "run"))
    upto = F.coalesce(F.try_element_at("starts", F.col("p") + 2)["s"], F.size("lines") + 1)
    text = F.array_join(F.transform(F.slice("lines", F.col("run.s"), upto - F.col("run.s")), lambda x: x["c"]), "\n")
    return cut.select("mid", "conv_id", "turn", "p", F.col("run.d").alias("d"), text.alias("t"))


def _units(passages: DataFrame) -> DataFrame:
    return passages.select("mid", "conv_id", "turn", "p", "d", F.explode(F.expr(_UNITS)).alias("u")).select(
        "mid", "conv_id", "turn", "p", "d", "u.level", F.md5(F.col("u.n").cast("binary")).alias("h"))


def _roots(links: DataFrame) -> DataFrame:
    """(mid, root, hops) from stored (mid, parent): every step doubles the distance covered."""
    now = stored(links.select("mid", F.col("parent").alias("root"), F.lit(1).alias("hops")), "roots")
    while True:
        up = now.select(F.col("mid").alias("m"), F.col("root").alias("r"), F.col("hops").alias("h"))
        new = stored(now.join(up, now["root"] == up["m"], "left").select(
            "mid", F.coalesce("r", "root").alias("root"), (F.col("hops") + F.coalesce("h", F.lit(0))).alias("hops"),
            F.col("r").isNotNull().alias("moved")), "roots")
        if not new.filter("moved").limit(1).count():
            return new.drop("moved")
        now = new.drop("moved")


def _positions(rows: DataFrame, group: str, order: list) -> DataFrame:
    """``rows`` with position (from 0) of each row in its group; no group is ordered by one task."""
    ranged = stored(rows.repartitionByRange(F.col(group).asc_nulls_first(), *order)
                    .withColumn("_pid", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy(F.col("_pid").alias("_p"), F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    before = stored(sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("_g").orderBy("_p")) - F.col("_n"))
                    .select("_p", "_g", "_before"), "before")  # of a group a row per partition
    place = F.row_number().over(Window.partitionBy("_pid", group).orderBy(*order)) - 1
    numbered = ranged.withColumn("_place", place)
    return (numbered.join(before, (F.col("_pid") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
            .withColumn("position", F.col("_place") + F.col("_before")).drop("_pid", "_p", "_g", "_place", "_before", "_n"))


def linked(conversations: DataFrame) -> DataFrame:
    """One row per message: its text without quotes, what it replies to, its thread and place.

    Columns: conv_id, turn, role, text (own lines, trimmed; null texts are
    empty), n_quotes (quoted passages), n_linked (of these, found),
    reply_conv_id and reply_turn (null: no reply), thread_conv_id and
    thread_turn (of the message that began the thread, or the message's
    own), hops (replies from there), position (in thread_conv_id, from 0).
    Messages of equal conversation and turn are ordered by role and text;
    a message never replies to its own turn or a later one; messages with a
    null conv_id or turn quote and are quoted by nobody. Repeated rows are
    messages of their own. No rows give no rows.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("raw"))
    messages = stored(rows.withColumn("mid", F.monotonically_increasing_id()).withColumn("lines", _lines(F.col("raw"))),
                      "messages")
    can = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    quoting = messages.filter(F.exists("lines", lambda x: x["d"] > 0))
    quotes = stored(_message_passages(quoting).filter("d > 0"), "quotes")
    wanted = stored(_units(quotes.filter(can)), "wanted")
    own = _units(_message_passages(messages.filter(can)).filter("d = 0"))
    hashes = stored(wanted.select("h").distinct(), "hashes")
    known = stored(own.join(hashes, "h", "left_semi").select("h", "level", "conv_id", "turn", "mid"), "known")
    first = F.min(F.struct("turn", "mid"))
    here = stored(known.groupBy("h", "conv_id").agg(first.alias("o"))
                  .select(F.col("h").alias("hh"), F.col("conv_id").alias("hc"), "o"), "here")
    there = stored(known.filter("level > 1").groupBy("h").agg(F.min(F.struct("conv_id", "turn", "mid")).alias("e"))
                   .select(F.col("h").alias("th"), "e"), "there")
    found = (wanted.join(here, (F.col("h") == F.col("hh")) & (F.col("conv_id") == F.col("hc"))
                         & (F.col("o.turn") < F.col("turn")), "left")
             .join(there, (F.col("h") == F.col("th")) & (F.col("level") > 1)
                   & (F.col("e.conv_id") < F.col("conv_id")), "left")
             .withColumn("to", F.when(F.col("o").isNotNull(), F.struct(
                 F.col("conv_id").alias("conv_id"), F.col("o.turn").alias("turn"), F.col("o.mid").alias("mid")))
                 .when(F.col("e").isNotNull(), F.col("e")))
             .filter("to is not null"))
    best = stored(found.groupBy("mid", "p", "d").agg(F.min(F.struct(
        -F.col("level"), F.col("o").isNull(), -F.col("to.turn"), "to")).alias("b")).select("mid", "p", "d", "b.to"), "best")
    counts = quotes.groupBy("mid").agg(F.count(F.lit(1)).alias("n_quotes")).join(
        best.groupBy(F.col("mid").alias("bm")).agg(F.count(F.lit(1)).alias("n_linked"), F.min(F.when(
            F.col("d") == 1, F.struct("p", "to"))).alias("reply")), F.col("mid") == F.col("bm"), "left")
    about = stored(counts.select(F.col("mid").alias("am"), "n_quotes", F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
                                 F.col("reply.to").alias("to")), "about")
    roots = _roots(about.filter("to is not null").select(F.col("am").alias("mid"), F.col("to.mid").alias("parent")))
    starts = messages.select(F.col("mid").alias("root"), F.col("conv_id").alias("root_conv"), F.col("turn").alias("root_turn"))
    threads = stored(roots.join(starts, "root").select(F.col("mid").alias("tm"), "root_conv", "root_turn", "hops"), "threads")
    text = F.trim(F.array_join(F.transform(F.filter("lines", lambda x: x["d"] == 0), lambda x: x["c"]), "\n"), F.lit(" \t\r\n"))
    out = (messages.join(about, F.col("mid") == F.col("am"), "left").join(threads, F.col("mid") == F.col("tm"), "left")
           .select("conv_id", "turn", "role", text.alias("text"),
                   F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
                   F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
                   F.col("to.conv_id").alias("reply_conv_id"), F.col("to.turn").alias("reply_turn"),
                   F.when(F.col("tm").isNotNull(), F.col("root_conv")).otherwise(F.col("conv_id")).alias("thread_conv_id"),
                   F.when(F.col("tm").isNotNull(), F.col("root_turn")).otherwise(F.col("turn")).alias("thread_turn"),
                   F.coalesce("hops", F.lit(0)).cast("long").alias("hops"), "mid",
                   F.md5(F.col("raw").cast("binary")).alias("_h")))
    order = [F.col(c).asc_nulls_first() for c in ("thread_turn", "hops_first", "conv_id", "turn", "role", "_h", "mid")]
    placed = _positions(out.withColumn("hops_first", (F.col("hops") > 0).cast("int")), "thread_conv_id", order)
    return placed.select("conv_id", "turn", "role", "text", "n_quotes", "n_linked", "reply_conv_id", "reply_turn",
                         "thread_conv_id", "thread_turn", "hops", F.col("position").cast("long").alias("position"))


#: The tables' messages may quote each other like any others; units as in ``_UNITS``.
ORACLE = r"""
WITH RECURSIVE messages AS (
  SELECT row_number() OVER () AS mid, conv_id, turn, role, coalesce(text, '') AS raw FROM conversations),
lines AS (
  SELECT mid, conv_id, turn, i, regexp_extract(x, '^[ \t]*(?:>[ \t]*)*') AS p, x FROM (
    SELECT mid, conv_id, turn, unnest(l) AS x, generate_subscripts(l, 1) AS i
    FROM (SELECT *, string_split(raw, chr(10)) AS l FROM messages))),
levels AS (
  SELECT mid, conv_id, turn, i, len(p) - len(replace(p, '>', '')) AS d,
    CASE WHEN d > 0 THEN substr(x, len(p) + 1) ELSE x END AS c FROM lines),
runs AS (
  SELECT *, sum(new) OVER (PARTITION BY mid ORDER BY i) - 1 AS k FROM (
    SELECT *, (d IS DISTINCT FROM lag(d) OVER (PARTITION BY mid ORDER BY i))::INT AS new FROM levels)),
passages AS (
  SELECT mid, conv_id, turn, k, any_value(d) AS d, string_agg(c, chr(10) ORDER BY i) AS t FROM runs GROUP BY ALL),
units AS (
  SELECT mid, conv_id, turn, k, d, u.level AS level, u.n AS n FROM (
    SELECT *, unnest(list_concat([{'level': 3, 'n': t}],
      list_transform(regexp_split_to_array(t, '\n[ \t]*\n'), lambda x: {'level': 2, 'n': x}),
      list_transform(string_split(t, chr(10)), lambda x: {'level': 1, 'n': x}))) AS w FROM passages
    WHERE conv_id IS NOT NULL AND turn IS NOT NULL) s,
    LATERAL (SELECT {'level': s.w.level, 'n': lower(trim(regexp_replace(s.w.n, '\s+', ' ', 'g')))} AS u)
  WHERE u.n <> ''),
here AS (SELECT n, conv_id, min(turn) AS t0, min((turn, mid)) AS o FROM units WHERE d = 0 GROUP BY ALL),
there AS (SELECT n, min((conv_id, turn, mid)) AS e FROM units WHERE d = 0 AND level > 1 GROUP BY n),
hits AS (
  SELECT q.mid, q.k, q.d, q.level, h.o IS NULL AS far,
    CASE WHEN h.o IS NOT NULL THEN q.conv_id ELSE e[1] END AS c, coalesce(h.o[1], e[2]) AS t, coalesce(h.o[2], e[3]) AS m
  FROM units q LEFT JOIN here h ON h.n = q.n AND h.conv_id = q.conv_id AND h.t0 < q.turn
  LEFT JOIN there ON there.n = q.n AND q.level > 1 AND there.e[1] < q.conv_id
  WHERE q.d > 0 AND (h.o IS NOT NULL OR e IS NOT NULL)),
best AS (
  SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY mid, k ORDER BY level DESC, far, t DESC, c, m) = 1),
about AS (
  SELECT mid, count(*) AS n_quotes, (SELECT count(*) FROM best b WHERE b.mid = p.mid) AS n_linked
  FROM passages p WHERE d > 0 GROUP BY mid),
replies AS (SELECT mid, c, t, m FROM best WHERE d = 1 QUALIFY row_number() OVER (PARTITION BY mid ORDER BY k) = 1),
climb(mid, up, hops) AS (SELECT mid, m, 1 FROM replies UNION ALL SELECT x.mid, r.m, x.hops + 1 FROM climb x JOIN replies r ON r.mid = x.up),
roots AS (SELECT mid, arg_max(up, hops) AS root, max(hops) AS hops FROM climb GROUP BY mid),
own AS (SELECT mid, string_agg(c, chr(10) ORDER BY i) AS t FROM levels WHERE d = 0 GROUP BY mid),
threads AS (
  SELECT g.*, coalesce(trim(own.t, ' ' || chr(9) || chr(10) || chr(13)), '') AS text, coalesce(n_quotes, 0) AS n_quotes,
    coalesce(n_linked, 0) AS n_linked, r.c AS reply_conv_id, r.t AS reply_turn,
    CASE WHEN z.mid IS NULL THEN g.conv_id ELSE f.conv_id END AS thread_conv_id,
    CASE WHEN z.mid IS NULL THEN g.turn ELSE f.turn END AS thread_turn, coalesce(z.hops, 0) AS hops
  FROM messages g LEFT JOIN own USING (mid) LEFT JOIN about USING (mid) LEFT JOIN replies r USING (mid)
  LEFT JOIN roots z USING (mid) LEFT JOIN messages f ON f.mid = z.root)
SELECT conv_id, turn, role, text, n_quotes::BIGINT AS n_quotes, n_linked::BIGINT AS n_linked, reply_conv_id, reply_turn,
  thread_conv_id, thread_turn, hops::BIGINT AS hops,
  row_number() OVER (PARTITION BY thread_conv_id ORDER BY thread_turn NULLS FIRST, hops > 0, conv_id NULLS FIRST,
    turn NULLS FIRST, role NULLS FIRST, md5(raw), mid) - 1 AS position
FROM threads
"""
