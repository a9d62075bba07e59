"""Query-usage attribution: run metadata x usage history -> metric rows.

The id list never passes through the driver: the deduplicated run
metadata is a DataFrame, and "query_id IN (ids)" is a left-semi join
(or, when the metadata is needed too, one inner join against the
one-row-per-id metadata, which both filters and enriches). The id side is
parsed from JSON, of which Spark's estimate says nothing, so these joins never
broadcast it: they sort and merge at every size.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import rfc3339
from ..sources import documents as docs
from ..sources.tables import USAGE_MEASURES

META = ["assetId", "deploymentId", "runId", "dagId", "taskId", "namespace"]
SOURCE_LAG = timedelta(hours=6)

# Metric categories and types as published.
COST_CATEGORY, COST_TYPE = "COST", "SNOWFLAKE_CREDITS"
USAGE_CATEGORY = "CUSTOM"
USAGE_TYPES = {
    "rows_produced": "SNOWFLAKE_ROWS_PRODUCED",
    "rows_inserted": "SNOWFLAKE_ROWS_INSERTED",
    "rows_updated": "SNOWFLAKE_ROWS_UPDATED",
    "rows_deleted": "SNOWFLAKE_ROWS_DELETED",
    "rows_unloaded": "SNOWFLAKE_ROWS_UNLOADED",
    "total_elapsed_time": "SNOWFLAKE_TOTAL_ELAPSED_TIME",
    "bytes_scanned": "SNOWFLAKE_BYTES_SCANNED",
}
assert tuple(USAGE_TYPES) == USAGE_MEASURES


def _as_dt(x) -> datetime:
    return x if isinstance(x, datetime) else datetime.fromisoformat(str(x))


def lagged_window(start, end, lag: timedelta = SOURCE_LAG) -> tuple[datetime, datetime]:
    """The data interval shifted back by the source's lag: ``[start-lag, end-lag)``."""
    return _as_dt(start) - lag, _as_dt(end) - lag


def external_queries(pages: DataFrame, start, end, lag: timedelta = SOURCE_LAG) -> DataFrame:
    """Records of ``{"externalQueries": [...]}`` pages whose ``queryTime`` is in
    the lagged interval (half-open, so consecutive runs do not overlap).

    ``pages`` has ``(page, doc)``; output keeps ``page`` and the element
    position ``pos`` so that "last one wins" deduplication has an order. A
    record whose time can't be read is in no interval.
    """
    lo, hi = lagged_window(start, end, lag)
    p = docs.parse_valid(pages, "doc", docs.EXTERNAL_QUERIES, keep=["page"])
    ex = p.select("page", F.posexplode("externalQueries").alias("pos", "q"))
    ex = ex.select("page", "pos", "q.queryId", *[f"q.{c}" for c in META],
                   F.col("q.queryTime").try_cast("timestamp_ntz").alias("queryTime"))
    return ex.filter((F.col("queryTime") >= F.lit(lo).cast("timestamp_ntz"))
                     & (F.col("queryTime") < F.lit(hi).cast("timestamp_ntz")))


def dedup_last(records: DataFrame) -> DataFrame:
    """One row per ``queryId``: the record that comes last in (page, pos) order.

    ``max_by`` is a declarative aggregate with a partial (map-side) phase,
    so a queryId repeated millions of times is still combined before the
    shuffle.
    """
    rec = F.struct(*[F.col(c) for c in META])
    last = records.groupBy("queryId").agg(F.max_by(rec, F.struct("page", "pos")).alias("r"))
    return last.select("queryId", *[F.col(f"r.{c}").alias(c) for c in META])


def _ids(listed: DataFrame) -> DataFrame:
    """The listed ids, to be merged: never broadcast, whatever Spark takes their size for."""
    return listed.select(F.col("queryId").alias("query_id")).hint("merge")


def query_costs(attribution: DataFrame, listed: DataFrame) -> DataFrame:
    """``SELECT query_id, end_time, credits_attributed_compute ... WHERE query_id IN (ids)``.

    ``listed`` is any frame with ``queryId`` — duplicates do not change a
    semi join, so the raw external records serve directly (no dedup
    shuffle), and both join inputs stay plain shuffles that AQE can split.
    """
    return (attribution.join(_ids(listed), "query_id", "left_semi")
            .select("query_id", "end_time", "credits_attributed_compute"))


def query_rows(history: DataFrame, listed: DataFrame) -> DataFrame:
    """The nine usage columns for listed ids (see ``query_costs``)."""
    return (history.join(_ids(listed), "query_id", "left_semi")
            .select("query_id", *USAGE_MEASURES, "end_time"))


def _enrich(facts: DataFrame, meta: DataFrame, by_time: bool = False) -> DataFrame:
    """Inner join to the one-row-per-id metadata: filters and enriches at once.

    The metadata side is an aggregate (last-wins dedup) dealt by the id. The
    second key, which follows from the id, has Spark deal it anew, in a plain
    shuffle whose skewed partitions AQE splits; no row is repeated. It is the
    id's length, which takes hardly any room in the shuffles, unlike a hash.
    ``by_time``: each task's rows in the order of their time.
    """
    part = F.length("query_id")
    metas = meta.withColumnRenamed("queryId", "query_id").withColumn("_part", part)
    e = facts.withColumn("_part", part).join(metas.hint("merge"), ["query_id", "_part"]).drop("_part")
    return e.sortWithinPartitions("end_time") if by_time else e


def cost_metrics(attribution: DataFrame, meta: DataFrame, by_time: bool = False) -> DataFrame:
    """One COST / SNOWFLAKE_CREDITS metric per attribution row (NULL credit stays NULL)."""
    e = _enrich(attribution, meta, by_time)
    return e.select(F.lit(COST_CATEGORY).alias("category"), F.lit(COST_TYPE).alias("type"),
                    F.col("credits_attributed_compute").cast("double").alias("value"),
                    *META, rfc3339("end_time").alias("timestamp"))


def usage_metrics(history: DataFrame, meta: DataFrame, by_time: bool = False) -> DataFrame:
    """Seven CUSTOM metrics per history row; a NULL measure publishes as 0."""
    e = _enrich(history, meta, by_time)
    wide = e.select(*META, rfc3339("end_time").alias("timestamp"),
                    *[F.coalesce(F.col(m), F.lit(0)).cast("double").alias(t)
                      for m, t in USAGE_TYPES.items()])
    long = wide.unpivot([*META, "timestamp"], list(USAGE_TYPES.values()), "type", "value")
    return long.select(F.lit(USAGE_CATEGORY).alias("category"), "type", "value", *META, "timestamp")


def all_metrics(attribution: DataFrame, history: DataFrame, meta: DataFrame, by_time: bool = False) -> DataFrame:
    """Cost metrics and the seven usage metric types as one table.

    ``by_time``: each task's rows come in the order of their time, so that files
    written from them take little room for the stamps. They are sorted before
    each becomes seven.
    """
    return cost_metrics(attribution, meta, by_time).unionByName(usage_metrics(history, meta, by_time))


def metric_counts(metrics: DataFrame) -> DataFrame:
    """Rows per published batch (category, type)."""
    return metrics.groupBy("category", "type").agg(F.count(F.lit(1)).alias("n"))


def batch_counts(attribution: DataFrame, history: DataFrame, listed: DataFrame) -> DataFrame:
    """``metric_counts`` of ``all_metrics`` without building the metrics.

    Every listed attribution row publishes one cost metric and every listed
    history row one metric of each usage type, so counting the two semi
    joins is enough. Empty batches have no row.
    """
    cost = attribution.select("query_id").join(_ids(listed), "query_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))
    used = history.select("query_id").join(_ids(listed), "query_id", "left_semi").agg(F.count(F.lit(1)).alias("n"))
    types = F.explode(F.array(*map(F.lit, USAGE_TYPES.values())))
    rows = (cost.select(F.lit(COST_CATEGORY).alias("category"), F.lit(COST_TYPE).alias("type"), "n")
            .unionByName(used.select(F.lit(USAGE_CATEGORY).alias("category"), types.alias("type"), "n")))
    return rows.filter("n > 0")
