"""The retail chain as streams: order summary and category totals.

``order_items_stream`` joins two streams, orders and their items, whichever
come first. Both sides wait for their partner for a bounded time by the time
they landed, in files and not in memory.

``category_totals_stream`` keeps sales by category up to date under new items,
new orders and changes of an order's status. Each micro-batch turns into
signed sums per category and bucket; ``compact`` merges the batches' sums into
one base, so a read touches one row per category and bucket and the batches
since. Every table of the store is written per batch and replaced when a batch
is replayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import concat_name
from ..operators.sales import COMPLETED_OR_SHIPPED
from ..operators.sinks import read_back, write_table
from .incremental import _run

ORDER_COLUMNS = ["order_id", "customer_id", "order_date", "status", "total_amount"]
ORDER_PARTIALS = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.TimestampNTZType()), T.StructField("status", T.StringType()),
    T.StructField("total_amount", T.DoubleType()), T.StructField("item_count", T.LongType()),
    T.StructField("batch_id", T.LongType())])


def _folder(store: str, name: str) -> str:
    return f"{store.rstrip('/')}/{name}"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _read_path(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of a store; one that nothing was written to yet is empty."""
    files, folder = _hadoop(spark, path)
    if not files.exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _forget(spark: SparkSession, path: str, batches: list[int]) -> None:
    """Deletes the rows of ``batches``, for which nothing can ask any more."""
    for batch_id in batches:
        files, folder = _hadoop(spark, f"{path}/batch_id={batch_id}")
        files.delete(folder, True)


def order_items_stream(orders: DataFrame, items: DataFrame, partials_path: str, checkpoint: str, wait: str = "6 hours",
                       salts: int = 4, available_now: bool = True):
    """Joins streams of orders and items by ``order_id`` and stores item counts per order and micro-batch.

    Both have ``landed_at``. An order and an item meet if they landed within
    ``wait`` of each other. The watermark trails the latest landing of the
    earlier batches, that of the slower stream, by ``wait``: what landed
    before it is dropped, and what can meet nothing later is forgotten. What
    waits lies in files under ``checkpoint``, not in the executors' memory; a
    batch joins its orders with all waiting items and its items with the
    orders that waited before. Items are dealt over ``salts`` copies of their
    order, so that the work of an order with very many items spreads over as
    many tasks.
    """
    within = F.expr(f"INTERVAL {wait}")
    deal = F.pmod(F.xxhash64(*items.columns), F.lit(salts)).cast("int")
    arrivals = (orders.select(F.lit(True).alias("is_order"), *ORDER_COLUMNS, "landed_at")
                .unionByName(items.select(F.lit(False).alias("is_order"), "order_id", "product_id", "landed_at",
                                          deal.alias("salt")), allowMissingColumns=True)
                .filter("order_id is not null and landed_at is not null"))
    o_columns, i_columns = [*ORDER_COLUMNS, "landed_at"], ["order_id", "product_id", "landed_at", "salt"]
    o_path, i_path = (_folder(f"{checkpoint.rstrip('/')}/waiting", n) for n in ("orders", "items"))
    o_schema, i_schema = (f"{arrivals.select(*c)._jdf.schema().toDDL()}, batch_id bigint" for c in (o_columns, i_columns))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def waiting(path: str, schema: str) -> DataFrame:
            return _read_path(spark, path, schema)

        # one row per waiting batch of either stream
        landed = [waiting(path, schema).filter(F.col("batch_id") < batch_id).groupBy("batch_id")
                  .agg(F.max("landed_at").alias("latest")) for path, schema in ((o_path, o_schema), (i_path, i_schema))]
        ends = [{r.batch_id: r for r in x.select("batch_id", F.unix_micros("latest").alias("latest"),
                                                 F.unix_micros(F.col("latest") + within).alias("reach"),
                                                 F.unix_micros(F.col("latest") - within).alias("mark")).collect()} for x in landed]
        mark = min(max(r.mark for r in x.values()) for x in ends) if all(ends) else None
        if mark is not None:
            batch = batch.filter(F.unix_micros("landed_at") > mark)
            for path, seen in zip((o_path, i_path), ends):
                _forget(spark, path, [n for n, r in seen.items() if r.reach <= mark])
        number = F.lit(batch_id).cast("bigint").alias("batch_id")
        for path, columns, kind in ((o_path, o_columns, "is_order"), (i_path, i_columns, "not is_order")):
            write_table(batch.filter(kind).select(*columns, number), path, partition_by=["batch_id"], rebalance=False)
        now, before = F.col("batch_id") == batch_id, F.col("batch_id") < batch_id
        o, i = waiting(o_path, o_schema), waiting(i_path, i_schema)

        def met(o: DataFrame, i: DataFrame) -> DataFrame:
            o = o.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).alias("o")
            i = i.withColumnRenamed("landed_at", "item_landed_at").alias("i")
            return (o.join(i, (F.col("o.order_id") == F.col("i.order_id")) & (F.col("o.salt") == F.col("i.salt"))
                           & (F.col("item_landed_at") >= F.col("landed_at") - within)
                           & (F.col("item_landed_at") <= F.col("landed_at") + within))
                    .select(*[F.col(f"o.{c}").alias(c) for c in ORDER_COLUMNS], "product_id"))

        pairs = met(o.filter(now), i.filter(now | before)).unionByName(met(o.filter(before), i.filter(now)))
        part = pairs.groupBy(*ORDER_COLUMNS).agg(F.count("product_id").alias("item_count"))
        write_table(part.withColumn("batch_id", F.lit(batch_id).cast("bigint")), partials_path, ORDER_PARTIALS,
                    partition_by=["batch_id"])

    return _run(arrivals.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint), available_now)


def order_summary_from_partials(spark: SparkSession, partials_path: str, customers: DataFrame) -> DataFrame:
    """The order summary of all batches, with the customers as they are now."""
    counted = (read_back(spark, partials_path, ORDER_PARTIALS).groupBy(*ORDER_COLUMNS)
               .agg(F.sum("item_count").alias("item_count")))
    named = customers.select("customer_id", concat_name("first_name", "last_name").alias("customer_name"))
    return (counted.join(named, "customer_id")
            .select("order_id", "customer_name", "order_date", "status", "total_amount", "item_count")
            .orderBy(F.col("order_date").desc_nulls_last(), F.col("order_id")))


# --------------------------------------------------------------------------- category totals
#: What the stream of changes holds: items, and statuses of orders (``seq`` tells which is later).
CHANGE = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()), T.StructField("quantity", T.DoubleType()),
    T.StructField("unit_price", T.DoubleType()), T.StructField("status", T.StringType()),
    T.StructField("seq", T.LongType())])
_ITEMS = "order_id long, product_id long, quantity double, revenue double, part int, batch_id long"
_STATUS = "order_id long, status string, seq long, part int, batch_id long"
_TOTALS = "category string, bucket int, quantity double, revenue double, batch_id long"
_BASE = "category string, bucket int, quantity double, revenue double, generation long"
_COMMITS = "generation long, upto long"
BUCKETS = 16


def _read(spark: SparkSession, store: str, name: str, schema: str) -> DataFrame:
    return _read_path(spark, _folder(store, name), schema)


def _counts(status: str, statuses) -> F.Column:
    return F.coalesce(F.col(status).isin(*statuses), F.lit(False)).cast("int")


def category_deltas(spark: SparkSession, batch: DataFrame, batch_id: int, store: str, products: DataFrame,
                    statuses=COMPLETED_OR_SHIPPED, buckets: int = BUCKETS) -> DataFrame:
    """Signed sums per category and bucket by which a micro-batch changes the totals; its rows are stored on the way.

    New items count if their order qualifies after the batch; items of
    earlier batches count anew, or no longer, if the batch changes whether
    their order qualifies. Orders and items are stored in ``part`` folders by
    their order, and only the orders that the batch touches are looked up.

    Whether an order counted before the batch and counts after it is told in
    one pass over its statuses, by numbers, which are aggregated by hashing;
    items of all batches then meet the orders that count or change once.
    """
    part = F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int").alias("part")
    b = F.lit(batch_id).cast("long").alias("batch_id")
    new_items = (batch.filter("kind = 'item' and order_id is not null").groupBy("order_id", "product_id", part)
                 .agg(F.sum("quantity").alias("quantity"), F.sum(F.col("quantity") * F.col("unit_price")).alias("revenue")))
    new_status = batch.filter("kind = 'order' and order_id is not null").select("order_id", part, "status", "seq")
    write_table(new_items.select("*", b), _folder(store, "items"), partition_by=["batch_id", "part"])
    write_table(new_status.select("*", b), _folder(store, "status"), partition_by=["batch_id", "part"])
    items, status = _read(spark, store, "items", _ITEMS), _read(spark, store, "status", _STATUS)
    now, before = F.col("batch_id") == batch_id, F.col("batch_id") < batch_id
    touched = items.filter(now).select("order_id", "part").unionByName(status.filter(now).select("order_id", "part"))
    counts = _counts("status", statuses)
    qualifies = (status.filter(now | before).join(touched, ["order_id", "part"], "left_semi").groupBy("order_id", "part")
                 .agg(F.coalesce(F.max_by(counts, "seq"), F.lit(0)).alias("after"),
                      F.coalesce(F.max_by(F.when(before, counts), F.when(before, F.col("seq"))), F.lit(0)).alias("before"))
                 .filter("after != 0 or before != 0")
                 .select("order_id", "part", "after", (F.col("after") - F.col("before")).alias("change")))
    sign = F.when(now, F.col("after")).otherwise(F.col("change"))
    signed = (items.filter(now | before).join(qualifies, ["order_id", "part"]).withColumn("sign", sign).filter("sign != 0")
              .select("product_id", "part", (F.col("quantity") * F.col("sign")).alias("quantity"),
                      (F.col("revenue") * F.col("sign")).alias("revenue")))
    per_product = (signed.groupBy("product_id", F.col("part").alias("bucket"))
                   .agg(F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue")))
    return (per_product.join(products.select("product_id", "category"), "product_id").groupBy("category", "bucket")
            .agg(F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue")))


def category_totals_stream(changes: DataFrame, products: DataFrame, store: str, checkpoint: str,
                           statuses=COMPLETED_OR_SHIPPED, buckets: int = BUCKETS, compact_every: int = 0,
                           available_now: bool = True):
    """Keeps the signed sums of ``changes`` (CHANGE) in ``store``, compacted after every so many batches (0: never)."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sums = category_deltas(spark, batch, batch_id, store, products, statuses, buckets)
        write_table(sums.withColumn("batch_id", F.lit(batch_id).cast("long")), _folder(store, "totals"), partition_by=["batch_id"])
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(spark, store, batch_id)

    return _run(changes.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint), available_now)


def _committed(spark: SparkSession, store: str) -> tuple[int, int]:
    """(generation, last batch) of the newest base that was committed; (-1, -1) if none."""
    row = _read(spark, store, "commits", _COMMITS).agg(F.max(F.struct("generation", "upto")).alias("c")).first()
    return (row.c.generation, row.c.upto) if row.c else (-1, -1)


def _rows(spark: SparkSession, store: str, generation: int, upto: int, last: int | None = None) -> DataFrame:
    """Rows of a base and of the batches after it (up to ``last``): what a read of the totals touches."""
    later = _read(spark, store, "totals", _TOTALS).filter(F.col("batch_id") > upto)
    if last is not None:
        later = later.filter(F.col("batch_id") <= last)
    base = _read(spark, store, "base", _BASE).filter(F.col("generation") == generation)
    return base.drop("generation").unionByName(later.drop("batch_id"))


def compact(spark: SparkSession, store: str, upto: int) -> None:
    """Merges the base and the sums of the batches up to ``upto`` into a new base, one row per category and bucket.

    The new base counts from the moment its one-row commit file appears. A
    job that fails before leaves a base that nothing reads, which the next
    one replaces. A batch replayed later rewrites only sums no longer read.
    """
    generation, done = _committed(spark, store)
    if upto <= done:
        return
    merged = (_rows(spark, store, generation, done, upto).groupBy("category", "bucket")
              .agg(F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue")))
    write_table(merged.withColumn("generation", F.lit(generation + 1).cast("long")), _folder(store, "base"),
                partition_by=["generation"])
    commit = spark.createDataFrame([(generation + 1, upto)], _COMMITS)
    commit.coalesce(1).write.mode("append").parquet(_folder(store, "commits"))


def stored_rows(spark: SparkSession, store: str) -> DataFrame:
    return _rows(spark, store, *_committed(spark, store))


def category_totals(spark: SparkSession, store: str) -> DataFrame:
    """Sales by category as of the last batch. A category whose sales were all taken back has sums of about zero."""
    return (stored_rows(spark, store).groupBy("category")
            .agg(F.sum("quantity").alias("total_quantity_sold"), F.sum("revenue").alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("category")))
