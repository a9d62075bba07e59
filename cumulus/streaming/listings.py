"""Run-metadata pages as a stream: the last record of each query id, whatever is sent twice.

State with event-time expiry drops pages that are sent again within the
watermark's delay; each micro-batch then keeps the last record per query id,
and a read merges the batches' records. The order of arrival plays no part,
since "last" goes by page and position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import usage
from ..operators.sinks import read_back, write_table
from .incremental import _run

LAST_RECORDS = T.StructType([
    T.StructField("queryId", T.StringType()), *[T.StructField(c, T.StringType()) for c in usage.META],
    T.StructField("page", T.LongType()), T.StructField("pos", T.IntegerType()),
    T.StructField("listings", T.LongType()), T.StructField("batch_id", T.LongType())])


def listings_stream(pages: DataFrame, partials_path: str, checkpoint: str, start, end, wait: str = "6 hours",
                    available_now: bool = True):
    """Stores the last record and the number of records per query id of each micro-batch.

    ``pages`` has (page, doc, landed_at). The same page with the same document
    counts once if it lands again within ``wait``; the state keeps a digest of
    each page for that long and no longer.
    """
    digest = F.sha2(F.coalesce("doc", F.lit("")), 256)
    once = (pages.withColumn("digest", digest).withWatermark("landed_at", wait)
            .dropDuplicatesWithinWatermark(["page", "digest"]).select("page", "doc"))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        found = usage.external_queries(batch, start, end)
        kept = F.struct(*usage.META, "page", "pos")
        last = found.groupBy("queryId").agg(F.max_by(kept, F.struct("page", "pos")).alias("r"), F.count(F.lit(1)).alias("listings"))
        write_table(last.select("queryId", "r.*", "listings", F.lit(batch_id).cast("long").alias("batch_id")), partials_path,
                    LAST_RECORDS, partition_by=["batch_id"])

    return _run(once.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint), available_now)


def last_listings(spark: SparkSession, partials_path: str) -> DataFrame:
    """One row per query id: its last record over all batches, and how often it was listed."""
    p = read_back(spark, partials_path, LAST_RECORDS)
    last = p.groupBy("queryId").agg(F.max_by(F.struct(*usage.META), F.struct("page", "pos")).alias("r"),
                                    F.sum("listings").alias("listings"))
    return last.select("queryId", "r.*", "listings")
