"""Incremental pipelines on Structured Streaming.

* ``weather_analytics_stream`` — new raw files -> recompute only the
  analysis dates they touch -> overwrite those analytics partitions.
* ``sales_category_stream`` — new order items -> per-batch sums per order
  and product, written idempotently per batch id; readers join them with the
  orders and products as they are then, so neither the order of arrival nor
  the split into batches matters.
* ``window_partials_stream`` — tumbling windows as per-batch partial sums;
  a row counts however late it comes, and readers tell closed windows by the
  latest time seen less the source's lag.
* ``tumbling_stream`` / ``usage_hourly_stream`` — tumbling windows emitted once
  under a watermark, for sources that are in time order but for the lag:
  rows later than that are dropped, as that contract says.

All run with ``trigger(availableNow=True)`` by default (process what is
there, then stop) and keep their checkpoints under the shared
``spark.checkpoint.dir``, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import sales, weather
from ..operators.sinks import read_back, write_table
from ..sources.tables import WEATHER_ANALYTICS, WEATHER_RAW


def _run(writer, available_now: bool = True):
    """Start a streaming query. With ``available_now`` it processes what is
    there, stops, and is awaited (re-raising any failure); otherwise the
    running query is returned to the caller."""
    if not available_now:
        return writer.start()
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def weather_analytics_stream(spark: SparkSession, raw_path: str, analytics_path: str,
                             checkpoint: str, constants: DataFrame, as_of=None, now=None,
                             days: int = weather.LOOKBACK_DAYS, available_now: bool = True,
                             published: Callable[[SparkSession, int, list[date]], None] | None = None):
    """Keep the analytics table current as raw partitions arrive.

    Each micro-batch yields the ingestion dates it touched; every analysis
    date whose look-back window contains one of them (d .. d+days, capped
    at ``as_of``, by default the day on which the batch runs) is recomputed from the raw partitions of its window only
    (literal partition filters) and its partition replaced (dynamic
    overwrite), so replays and reruns are idempotent. ``published(spark,
    batch_id, dates)`` is called once they are written.
    """
    src = spark.readStream.schema(WEATHER_RAW).parquet(raw_path)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        cap = datetime.now(timezone.utc).date() if as_of is None else date.fromisoformat(str(as_of))
        # The distinct ingestion dates of a micro-batch are a handful of
        # calendar days (bounded), so they are brought to the driver to become
        # literal partition filters on the raw table.
        touched = [r[0] for r in batch.select("ingestion_date").distinct().collect()
                   if r[0] is not None]
        wanted = sorted({d + timedelta(days=k) for d in touched for k in range(days + 1)
                         if d + timedelta(days=k) <= cap})
        if not wanted:
            return
        s = batch.sparkSession
        dates = s.createDataFrame([(d,) for d in wanted], "analysis_date date")
        raw_all = s.read.schema(WEATHER_RAW).parquet(raw_path)
        out = weather.analytics_for_dates(raw_all, constants, dates, now, days, listed=wanted)
        write_table(out, analytics_path, WEATHER_ANALYTICS, partition_by=["analysis_date"])
        if published:
            published(s, batch_id, wanted)

    w = src.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return _run(w, available_now)


PARTIAL_SALES = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("batch_id", T.LongType()),
])


def sales_category_stream(spark: SparkSession, items_stream: DataFrame, partials_path: str,
                          checkpoint: str, available_now: bool = True):
    """Maintain item sums per order and product as new order items stream in.

    Orders and products play no part yet, so items may come before their
    order, and a later change of an order's status takes effect. Each batch's
    partial sums land in their own ``batch_id`` partition with overwrite
    semantics, so a replayed batch replaces itself rather than double counting.
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        part = batch.groupBy("order_id", "product_id").agg(
            F.sum("quantity").alias("quantity"), F.sum(F.col("quantity") * F.col("unit_price")).alias("revenue"))
        write_table(part.withColumn("batch_id", F.lit(batch_id).cast("bigint")), partials_path, PARTIAL_SALES,
                    partition_by=["batch_id"])

    w = items_stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return _run(w, available_now)


def sales_from_partials(spark: SparkSession, partials_path: str, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales by category from the stored partials and the orders and products as they are now."""
    p = read_back(spark, partials_path, PARTIAL_SALES)
    return sales.sales_by_category(p, products, orders, revenue=F.col("revenue"))


WINDOW_PARTIALS = T.StructType([
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("key", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("latest", T.TimestampNTZType()),
    T.StructField("batch_id", T.LongType()),
])


def window_partials_stream(stream: DataFrame, ts_col: str, width: str, partials_path: str, checkpoint: str,
                           key: str | None = None, value: str | None = None, available_now: bool = True):
    """Tumbling-window counts (and sums) per batch, each batch in its own partition."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        ts = F.col(ts_col).cast("timestamp")
        part = batch.groupBy(F.window(ts, width)["start"].cast("timestamp_ntz").alias("window_start"),
                             (F.col(key) if key else F.lit(None)).cast("string").alias("key")).agg(
            F.count(F.lit(1)).alias("n"), (F.sum(value) if value else F.lit(None)).cast("double").alias("total"),
            F.max(ts.cast("timestamp_ntz")).alias("latest"))
        write_table(part.withColumn("batch_id", F.lit(batch_id).cast("bigint")), partials_path, WINDOW_PARTIALS,
                    partition_by=["batch_id"])

    w = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return _run(w, available_now)


def windows_from_partials(spark: SparkSession, partials_path: str, width: str, lag: str) -> DataFrame:
    """(window_start, window_end, key, n, total) of the windows that ended ``lag`` before the latest row seen."""
    p = read_back(spark, partials_path, WINDOW_PARTIALS)
    upto = p.select((F.max("latest") - F.expr(f"INTERVAL {lag}")).alias("u")).scalar()
    end = F.col("window_start") + F.expr(f"INTERVAL {width}")
    return (p.groupBy("window_start", "key").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
            .select("window_start", end.alias("window_end"), "key", "n", "total").filter(F.col("window_end") <= upto))


HOURLY_USAGE = T.StructType([
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("n", T.LongType()),
    T.StructField("credits", T.DoubleType()),
])


def tumbling_stream(stream: DataFrame, ts_col: str, width: str, lag: str, sink_path: str,
                    checkpoint: str, keys=(), value: str | None = None,
                    value_name: str = "total_value", available_now: bool = True):
    """Event-time tumbling windows over a stream, emitted once when closed.

    The watermark trails the latest event time by ``lag``; a window (per
    ``keys``) is appended to the Parquet sink when the watermark passes its
    end, and rows arriving after that are dropped. State holds only open
    windows, so it stays bounded however long the stream runs.
    """
    s = stream.withColumn("_event_time", F.col(ts_col).cast("timestamp"))
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(value).alias(value_name))
    agg = (s.withWatermark("_event_time", lag)
           .groupBy(F.window("_event_time", width).alias("w"), *keys).agg(*aggs))
    out = agg.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys,
                     *[a for a in ["n", value_name] if a in agg.columns])
    w = (out.writeStream.format("parquet").outputMode("append")
         .option("path", sink_path).option("checkpointLocation", checkpoint))
    return _run(w, available_now)


def usage_hourly_stream(spark: SparkSession, usage_stream: DataFrame, sink_path: str,
                        checkpoint: str, lag: str = "6 hours", width: str = "1 hour",
                        available_now: bool = True):
    """Hourly query count and credits, tolerating the usage source's 6 h lag."""
    return tumbling_stream(usage_stream, "end_time", width, lag, sink_path, checkpoint,
                           value="credits_attributed_compute", value_name="credits",
                           available_now=available_now)


def stream_source(spark: SparkSession, path_glob: str, schema: T.StructType,
                  mapper: Callable[[DataFrame], DataFrame] | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file stream (directory or glob) with an optional mapping."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(path_glob)
    return mapper(df) if mapper else df
