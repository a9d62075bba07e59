"""Named queries: each builds a DataFrame from the test tables in ``sf_dir``.

Every query reads whole tables (or tables Spark derives from them); none
samples, caps or filters rows to stay cheap. ``ROUNDING`` lists the double
columns that are fixed to a number of decimals before comparison — the
same list drives the oracle SQL wrapper, so both sides round identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import fix_scale
from ..operators import distinct, people, reports, sales, settings, sinks, timeseries, usage, weather
from ..session import apply_runtime_defaults, scratch_path
from ..sources import bucketed, documents
from ..sources import fixtures as fx
from ..sources.tables import METRICS, WEATHER_ANALYTICS, WEATHER_HISTORICAL, WEATHER_RAW, read_table
from ..streaming import catchup, listings, manifest, orders
from ..streaming import incremental as inc

AS_OF, NOW = fx.AS_OF, fx.NOW
RUN_ID = "manual__2024-01-30T12:00:00"
OTHER_RUN_ID = "scheduled__2024-01-30T00:00:00"
# Usage interval (before the 6 h lag shift); the test data begin earlier and end later.
USAGE_START, USAGE_END = "1996-01-01T06:00:00", "2001-01-01T06:00:00"
# An interval with no queries at all (exercises the empty path).
EMPTY_START, EMPTY_END = "2100-01-01T06:00:00", "2100-01-01T07:00:00"
BACKFILL_START, BACKFILL_END = "2024-01-15", AS_OF
STORED_START = "2024-01-27"  # first analysis date of the stored analytics table
CATCHUP_START = "2024-01-01"
EXPECTED_START = "2023-12-30"  # catch-up is due from here on, before the first reading
LANDED_BATCHES = 4  # micro-batches in which the streams' rows arrive
WAVES = (2, 0, 3, 1)  # the order in which the chain's waves of rows land
# Waves of the watermark query: the usage up to a time, the usage up to another, the rest; late rows come last.
WATERMARK_CUTS = ("1994-06-01 00:00:00", "1997-01-01 00:00:00")
DONE_BEFORE = (("2024-01-18", "2024-01-19"), ("2024-01-23", "2024-01-23"))  # days that the catch-up finds done

# --------------------------------------------------------------------------- shared builders


def _raw(spark, d, spread=False):
    return weather.derive_weather(fx.weather_readings(spark, d, spread),
                                  weather.series_constants_10m(spark), NOW)


def _analytics(spark, d, spread=False):
    return weather.analytics(_raw(spark, d, spread), weather.series_constants_20k(spark), AS_OF, NOW)


_STORED: dict[tuple, str] = {}


def _version(spark, d, *tables) -> tuple:
    """Modification times of the tables' files or folders: a table rewritten at its path is another table."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(f"{d.rstrip('/')}/{t}.parquet") for t in tables]
    return tuple(p.getFileSystem(conf).getFileStatus(p).getModificationTime() for p in paths)


def _stored_analytics(spark, d, spread=False):
    """The analytics table of several analysis dates, written once a session and read back by date.

    Reports filter ``analysis_date`` and so read one partition of it.
    """
    key = (spark.sparkContext.applicationId, d, spread, _version(spark, d, "events", "nation", "region"))
    if key not in _STORED:
        out = weather.analytics_for_dates(
            _raw(spark, d, spread), weather.series_constants_20k(spark),
            weather.date_spine(spark, STORED_START, AS_OF), NOW, first=STORED_START, last=AS_OF)
        path = scratch_path(spark, "weather_analytics")
        sinks.write_table(out, path, WEATHER_ANALYTICS, partition_by=["analysis_date"])
        _STORED[key] = path
    return sinks.read_back(spark, _STORED[key], WEATHER_ANALYTICS)


def _today(spark, d):
    return _stored_analytics(spark, d).filter(F.col("analysis_date") == F.lit(AS_OF).cast("date"))


def _meta(spark, d, start=USAGE_START, end=USAGE_END):
    return usage.dedup_last(usage.external_queries(fx.external_query_documents(spark, d), start, end))


def _people(spark, d):
    return people.with_fallback(spark, people.parse_people(fx.people_documents(spark, d)))


# --------------------------------------------------------------------------- queries


def q_scan_customers(spark, d):
    return sales.scan(fx.retail_customers(spark, d))


def q_scan_products(spark, d):
    return sales.scan(fx.retail_products(spark, d))


def q_order_summary(spark, d):
    return sales.order_summary(fx.retail_orders(spark, d), fx.retail_customers(spark, d),
                               fx.retail_order_items(spark, d))


def q_sales_by_category(spark, d):
    return sales.sales_by_category(fx.retail_order_items(spark, d), fx.retail_products(spark, d),
                                   fx.retail_orders(spark, d))


def q_weather_flatten_json(spark, d):
    """Readings of the configured cities; here the city list is the nations' and a city that has no documents."""
    return weather.flatten_weather_json(fx.geocode_documents(spark, d),
                                        fx.weather_documents(spark, d), NOW, fx.expected_cities(spark, d))


def q_weather_derive(spark, d):
    return _raw(spark, d)


def q_wind_category_counts(spark, d):
    return weather.wind_category_counts(_raw(spark, d))


def q_weather_city_summary(spark, d):
    return weather.city_summary(_raw(spark, d), AS_OF)


def q_weather_analytics(spark, d):
    return _analytics(spark, d)


def q_city_fibonacci(spark, d):
    return weather.city_fibonacci(_today(spark, d), weather.fibonacci(spark))


def q_weather_run_summary(spark, d):
    return weather.run_summary(_stored_analytics(spark, d), AS_OF)


def _report(fn, spread=False):
    def q(spark, d):
        return fn(_stored_analytics(spark, d, spread), AS_OF)
    q.__name__ = f"q_{fn.__name__}"
    return q


def q_usage_external_queries(spark, d):
    ex = usage.external_queries(fx.external_query_documents(spark, d), USAGE_START, USAGE_END)
    return ex.select("queryId", *usage.META)


def q_usage_id_dedup(spark, d):
    return _meta(spark, d)


def _listed(spark, d):
    return usage.external_queries(fx.external_query_documents(spark, d), USAGE_START, USAGE_END)


def q_usage_query_costs(spark, d):
    return usage.query_costs(fx.attribution_history(spark, d), _listed(spark, d))


def q_usage_query_rows(spark, d):
    return usage.query_rows(fx.query_history(spark, d), _listed(spark, d))


def q_usage_cost_metrics(spark, d):
    return usage.cost_metrics(fx.attribution_history(spark, d), _meta(spark, d))


def _metrics(spark, d, by_time=False):
    return usage.all_metrics(fx.attribution_history(spark, d), fx.query_history(spark, d), _meta(spark, d), by_time)


def q_usage_metrics_all(spark, d):
    return _metrics(spark, d)


def q_usage_metric_counts(spark, d):
    return usage.batch_counts(fx.attribution_history(spark, d), fx.query_history(spark, d), _listed(spark, d))


def q_usage_metrics_empty(spark, d):
    meta = _meta(spark, d, EMPTY_START, EMPTY_END)
    return usage.all_metrics(fx.attribution_history(spark, d), fx.query_history(spark, d), meta)


def q_usage_metrics_published(spark, d):
    """Publish the metric batches (partitioned by category/type), read back."""
    path = scratch_path(spark, "metrics")
    sinks.publish(_metrics(spark, d, by_time=True), path, schema=METRICS)
    return sinks.read_back(spark, path, METRICS)


def q_people_explode_format(spark, d):
    return people.people_messages(_people(spark, d))


def q_people_count(spark, d):
    return people.people_count(_people(spark, d))


def q_people_fallback(spark, d):
    """No usable document: the fallback list is formatted instead."""
    return people.people_messages(people.with_fallback(
        spark, people.parse_people(fx.unusable_people_documents(spark, d))))


def q_mask_column(spark, d):
    return settings.mask_column(fx.secrets(spark, d), "secret")


def q_default_missing(spark, d):
    return settings.default_column(fx.secrets(spark, d), "secret")


def _tumbling(width):
    def q(spark, d):
        return timeseries.tumbling(read_table(spark, d, "events"), "ts", width,
                                   keys=["event_type"], value="value")
    return q


def q_missing_days(spark, d):
    return timeseries.missing_intervals(fx.weather_readings(spark, d), "ingestion_date", EXPECTED_START, AS_OF,
                                        keys=["city"], expected=fx.expected_cities(spark, d))


def q_missing_slots_30m(spark, d):
    """Half-hourly ingest slots with no reading, per city (catch-up at the ingest's cadence)."""
    return timeseries.missing_slots(fx.weather_readings(spark, d), "timestamp",
                                    f"{EXPECTED_START} 00:00:00", f"{AS_OF} 23:30:00", "30 minutes",
                                    keys=["city"], expected=fx.expected_cities(spark, d))


def q_weather_raw_roundtrip(spark, d):
    """JSON files -> readings -> derived raw -> partitioned write -> read back."""
    geo, wx = scratch_path(spark, "landed_geocode"), scratch_path(spark, "landed_weather")
    documents.land(fx.geocode_documents(spark, d), geo)
    documents.land(fx.weather_documents(spark, d), wx)
    readings = weather.flatten_weather_json(
        documents.read_landed(spark, geo, "city string, fetched_at string, doc string"),
        documents.read_landed(spark, wx, "city string, observed_at timestamp_ntz, doc string"), NOW)
    raw = weather.derive_weather(readings, weather.series_constants_10m(spark), NOW)
    path = scratch_path(spark, "weather_raw")
    sinks.write_table(raw, path, WEATHER_RAW, partition_by=["ingestion_date"])
    return sinks.read_back(spark, path, WEATHER_RAW)


def q_weather_historical(spark, d):
    """Analytics appended to history by run id, for two runs, the first of them run twice
    (a rerun replaces its own partitions)."""
    path = scratch_path(spark, "weather_historical")
    for run_id in (RUN_ID, OTHER_RUN_ID, RUN_ID):
        hist = _today(spark, d).withColumn("dag_run_id", F.lit(run_id))
        sinks.write_table(hist, path, WEATHER_HISTORICAL, partition_by=["analysis_date", "dag_run_id"])
    return sinks.read_back(spark, path, WEATHER_HISTORICAL)


def q_backfill_range(spark, d):
    """Two overlapping ranges: the second replaces the dates it shares with the first and adds its own."""
    path = scratch_path(spark, "weather_analytics_backfill")
    for first, last in ((BACKFILL_START, "2024-01-22"), ("2024-01-20", BACKFILL_END)):
        out = weather.analytics_for_dates(_raw(spark, d), weather.series_constants_20k(spark),
                                          weather.date_spine(spark, first, last), NOW, first=first, last=last)
        sinks.write_table(out, path, WEATHER_ANALYTICS, partition_by=["analysis_date"])
    return sinks.read_back(spark, path, WEATHER_ANALYTICS)


def q_stream_weather_incremental(spark, d):
    """Raw rows arrive in three waves: some early days, all later ones, the rest of the early days."""
    raw_path, out_path = scratch_path(spark, "stream_weather_raw"), scratch_path(spark, "stream_weather_analytics")
    raw, ckpt = _raw(spark, d), scratch_path(spark, "ckpt")
    early = F.col("ingestion_date") <= F.lit(BACKFILL_START).cast("date")
    late = F.col("winddirection") >= 180
    for mode, wave in (("overwrite", early & ~late), ("append", ~early), ("append", early & late)):
        sinks.write_table(raw.filter(wave), raw_path, WEATHER_RAW, partition_by=["ingestion_date"], mode=mode)
        inc.weather_analytics_stream(spark, raw_path, out_path, ckpt, weather.series_constants_20k(spark),
                                     as_of=AS_OF, now=NOW)
    return sinks.read_back(spark, out_path, WEATHER_ANALYTICS)


def _arriving(spark, d, table, mapper=None):
    """A table's rows as a stream of files in no order, in four micro-batches of as many files as the table has scan tasks."""
    rows, landing = read_table(spark, d, table), scratch_path(spark, f"landed_{table}")
    files = max(1, rows.rdd.getNumPartitions())
    rows.repartition(LANDED_BATCHES * files).write.parquet(landing)
    return inc.stream_source(spark, landing, rows.schema, mapper, max_files_per_trigger=files)


def q_stream_sales_incremental(spark, d):
    """Items stream in four batches; orders and products are joined as they are in the end."""
    path = scratch_path(spark, "stream_sales_partials")
    inc.sales_category_stream(spark, _arriving(spark, d, "lineitem", fx.order_items_from), path,
                              scratch_path(spark, "ckpt"))
    return inc.sales_from_partials(spark, path, fx.retail_products(spark, d), fx.retail_orders(spark, d))


def q_stream_usage_hourly(spark, d):
    """Hourly usage from four batches in no order (windows that ended 6 h before the latest row)."""
    path = scratch_path(spark, "stream_usage_hourly")
    inc.window_partials_stream(_arriving(spark, d, "lineitem", fx.attribution_from), "end_time", "1 hour", path,
                               scratch_path(spark, "ckpt"), value="credits_attributed_compute")
    return (inc.windows_from_partials(spark, path, "1 hour", "6 hours")
            .select("window_start", "window_end", "n", F.col("total").alias("credits")))


def q_stream_tumbling_30m(spark, d):
    """Half-hourly event counts per type from an event stream (closed windows only)."""
    path = scratch_path(spark, "stream_tumbling_30m")
    inc.window_partials_stream(_arriving(spark, d, "events"), "ts", "30 minutes", path,
                               scratch_path(spark, "ckpt"), key="event_type", value="value")
    return (inc.windows_from_partials(spark, path, "30 minutes", "30 minutes")
            .select("window_start", "window_end", F.col("key").alias("event_type"), "n",
                    F.col("total").alias("total_value")))


def _landed(rows, *keys):
    """Rows with the wave in which they land, told by a hash of ``keys``, and their time of landing (an hour a wave)."""
    wave = F.pmod(F.xxhash64(*keys), F.lit(len(WAVES))).cast("int")
    return rows.withColumn("wave", wave).withColumn("landed_at", F.expr("timestampadd(HOUR, wave, TIMESTAMP '2024-01-01 00:00:00')"))


def _land(rows, wave, path):
    rows.filter(F.col("wave") == wave).drop("wave").write.mode("append").parquet(path)


def order_waves(spark, d, waves=WAVES):
    """The order summary from orders and items that land in waves, items before their order as often as after."""
    o = _landed(fx.retail_orders(spark, d).withColumn("order_date", F.col("order_date").cast("timestamp_ntz")), "order_id")
    i = _landed(fx.retail_order_items(spark, d).select("order_id", "product_id"), F.lit("item"), "order_id", "product_id")
    o_path, i_path, out, ckpt = (scratch_path(spark, n) for n in ("landed_orders", "landed_items", "stream_order_items", "ckpt"))
    for wave in waves:
        _land(o, wave, o_path)
        _land(i, wave, i_path)
        inc_orders = inc.stream_source(spark, o_path, o.drop("wave").schema)
        inc_items = inc.stream_source(spark, i_path, i.drop("wave").schema)
        orders.order_items_stream(inc_orders, inc_items, out, ckpt)
    return orders.order_summary_from_partials(spark, out, fx.retail_customers(spark, d))


def q_stream_order_summary(spark, d):
    return order_waves(spark, d)


def category_changes(spark, d):
    """Items, and statuses of orders: every third order was pending first, and of the others every fifth completed."""
    o, none = fx.retail_orders(spark, d), F.lit(None)
    first = F.when(F.pmod("order_id", F.lit(3)) == 0, F.lit("pending")).when(F.pmod("order_id", F.lit(5)) == 0, F.lit("completed"))
    versions = F.explode(F.array(F.struct(first.alias("status"), F.lit(1).alias("seq")),
                                 F.struct(F.col("status").alias("status"), F.lit(2).alias("seq")))).alias("v")
    status = (o.select("order_id", first.isNotNull().alias("changed"), versions).filter("changed or v.seq = 2")
              .select(F.lit("order").alias("kind"), "order_id", none.cast("long").alias("product_id"),
                      none.cast("double").alias("quantity"), none.cast("double").alias("unit_price"),
                      F.col("v.status").alias("status"), F.col("v.seq").cast("long").alias("seq")))
    items = fx.retail_order_items(spark, d).select(
        F.lit("item").alias("kind"), "order_id", "product_id", F.col("quantity").cast("double").alias("quantity"), "unit_price",
        none.cast("string").alias("status"), none.cast("long").alias("seq"))
    return sinks.conform(items, orders.CHANGE).unionByName(sinks.conform(status, orders.CHANGE))


def category_waves(spark, d, waves=WAVES, compact_every=3, store=None):
    """The store of category totals after the waves; every three batches are compacted."""
    rows = _landed(category_changes(spark, d), "kind", "order_id", "product_id", "seq")
    path, ckpt = scratch_path(spark, "landed_changes"), scratch_path(spark, "ckpt")
    store = store or scratch_path(spark, "category_totals")
    for wave in waves:
        _land(rows.drop("landed_at"), wave, path)
        orders.category_totals_stream(inc.stream_source(spark, path, orders.CHANGE), fx.retail_products(spark, d), store, ckpt,
                                      compact_every=compact_every)
    return store


def q_stream_category_totals(spark, d):
    """Keyed running totals under new items, new orders and changed statuses."""
    return orders.category_totals(spark, category_waves(spark, d))


def report_waves(spark, d):
    """The folder of reports that follow the analytics over three waves of raw rows."""
    raw_path, out_path, reports_path, commits, ckpt, ckpt2 = (
        scratch_path(spark, n) for n in ("chain_raw", "chain_analytics", "chain_reports", "chain_manifest", "ckpt", "ckpt"))
    raw = _raw(spark, d)
    early = F.col("ingestion_date") <= F.lit(BACKFILL_START).cast("date")
    late = F.col("winddirection") >= 180
    for mode, wave in (("overwrite", early & ~late), ("append", ~early), ("append", early & late)):
        sinks.write_table(raw.filter(wave), raw_path, WEATHER_RAW, partition_by=["ingestion_date"], mode=mode)
        inc.weather_analytics_stream(
            spark, raw_path, out_path, ckpt, weather.series_constants_20k(spark), as_of=AS_OF, now=NOW,
            published=lambda s, batch_id, dates: manifest.publish(s, commits, "analytics", batch_id, dates))
        manifest.reports_stream(spark, commits, out_path, reports_path, ckpt2)
    return reports_path


def q_stream_weather_reports(spark, d):
    """The summary report of every analysis date, refreshed by the analytics' commits."""
    return sinks.read_back(spark, f"{report_waves(spark, d)}/summary")


def backfill_run(spark, d, path):
    """Writes the analytics of a range of days."""
    def run(first, last):
        out = weather.analytics_for_dates(_raw(spark, d), weather.series_constants_20k(spark),
                                          weather.date_spine(spark, first, last), NOW, first=first, last=last)
        sinks.write_table(out, path, WEATHER_ANALYTICS, partition_by=["analysis_date"])
    return run


def q_catchup_backfill(spark, d):
    """Days that are missing between days already done, found by the ledger and run range by range, in two runs."""
    path, ledger = scratch_path(spark, "catchup_analytics"), scratch_path(spark, "catchup_ledger")
    run = backfill_run(spark, d, path)
    for first, last in DONE_BEFORE:
        catchup.catch_up(spark, ledger, first, last, run, "earlier")
    catchup.catch_up(spark, ledger, BACKFILL_START, "2024-01-24", run, RUN_ID)
    catchup.catch_up(spark, ledger, BACKFILL_START, BACKFILL_END, run, RUN_ID)
    return sinks.read_back(spark, path, WEATHER_ANALYTICS)


def q_stream_usage_id_dedup(spark, d):
    """The last record of each query id, from pages in four waves, each of which sends the one before again."""
    pages = _landed(fx.external_query_documents(spark, d), "page")
    path, out, ckpt = (scratch_path(spark, n) for n in ("landed_pages", "stream_listings", "ckpt"))
    again = None
    for wave in WAVES:
        _land(pages, wave, path)
        if again is not None:
            hour = F.lit(f"2024-01-01 0{wave}:30:00").cast("timestamp")
            pages.filter(F.col("wave") == again).drop("wave").withColumn("landed_at", hour).write.mode("append").parquet(path)
        listings.listings_stream(inc.stream_source(spark, path, pages.drop("wave").schema), out, ckpt, USAGE_START, USAGE_END)
        again = wave
    return listings.last_listings(spark, out)


def q_stream_usage_watermark(spark, d):
    """Hourly usage under a six-hour watermark, appended when closed: in time order, but for a tenth that comes last.

    Late rows count only in windows that are still open then, as the
    contract of an append-only sink says.
    """
    li = read_table(spark, d, "lineitem")
    rows = fx.attribution_from(li).withColumn("late", F.pmod(F.col("query_id").cast("long"), F.lit(10)) == 0)
    cuts = [F.lit(c).cast("timestamp_ntz") for c in WATERMARK_CUTS]
    wave = F.when(F.col("late"), 3).when(F.col("end_time") < cuts[0], 0).when(F.col("end_time") < cuts[1], 1).otherwise(2)
    rows = rows.withColumn("wave", wave).drop("late")
    path, out, ckpt = (scratch_path(spark, n) for n in ("landed_usage", "stream_usage_watermark", "ckpt"))
    for w in range(4):
        _land(rows, w, path)
        inc.usage_hourly_stream(spark, inc.stream_source(spark, path, rows.drop("wave").schema), out, ckpt)
    return sinks.read_back(spark, out, inc.HOURLY_USAGE)


def q_weather_raw_recreated(spark, d):
    """Create-or-replace of the raw table: a first run's other days are gone; the load stamp is the column's default."""
    path, raw = scratch_path(spark, "weather_raw_recreated"), _raw(spark, d).drop("load_timestamp")
    day = F.col("ingestion_date")
    for rows in (raw, raw.filter(day >= F.lit(BACKFILL_START).cast("date"))):
        sinks.write_table(rows, path, WEATHER_RAW, partition_by=["ingestion_date"], replace_all=True)
    return sinks.read_back(spark, path, WEATHER_RAW).select(
        "city", "timestamp", "ingestion_date", "temperature", F.col("load_timestamp").isNotNull().alias("stamped"))


def bucketed_orders(spark, d):
    """(orders, items) stored in sorted buckets of the order."""
    out = []
    for rows in (fx.retail_orders(spark, d), fx.retail_order_items(spark, d)):
        name = bucketed.new_name("orders")
        bucketed.write_bucketed(rows, name, scratch_path(spark, name), ["order_id"], bucketed.bucket_count(spark), sort=True)
        out.append(spark.table(name))
        bucketed.forget(spark, name)
    return out


def q_order_summary_bucketed(spark, d):
    o, i = bucketed_orders(spark, d)
    return sales.order_summary_stored(o, fx.retail_customers(spark, d), i)


def q_weather_rejected(spark, d):
    """Weather documents that can't be used, with the reason; the same write keeps the others in another part."""
    path = scratch_path(spark, "landed_weather")
    weather.land_weather(fx.weather_documents(spark, d), path)
    landed = spark.read.schema(weather.LANDED_WEATHER).parquet(path)
    return landed.filter("part = 'rejected'").select("city", "observed_at", "doc", "reason")


def q_usage_published_counts(spark, d):
    """Rows of each published batch, as counted while they are written."""
    batches = [(usage.COST_CATEGORY, usage.COST_TYPE), *[(usage.USAGE_CATEGORY, t) for t in usage.USAGE_TYPES.values()]]
    return sinks.publish_counted(_metrics(spark, d, by_time=True), scratch_path(spark, "metrics_counted"), batches, METRICS)


def q_weather_inserted(spark, d):
    """A declared raw table filled by INSERT: one half with a column list that omits the load stamp, one by position."""
    name, path = bucketed.new_name("weather_raw"), scratch_path(spark, "weather_raw_inserted")
    raw = _raw(spark, d)
    half = F.col("winddirection") < 180
    columns = ["city", "temperature", "timestamp", "ingestion_date", "wind_category", "weathercode"]
    sinks.create_table(spark, name, path, WEATHER_RAW)
    sinks.insert_columns(raw.filter(half).select(*columns), name)
    sinks.insert_by_position(raw.filter(~half).select(*WEATHER_RAW.names), name)
    table = spark.table(name)
    bucketed.forget(spark, name)
    stamp = F.lit(NOW).cast("timestamp_ntz")
    return table.select(*columns, "windspeed", (F.col("load_timestamp") == stamp).alias("given_stamp"),
                        F.col("load_timestamp").isNotNull().alias("stamped"))


def distinct_history(spark, d):
    """Folder of the cities' and countries' bitmaps by day, stored in three waves, the last of them late and run twice."""
    root, raw = scratch_path(spark, "distinct_history"), fx.weather_readings(spark, d)
    early, late = F.col("ingestion_date") < F.lit(BACKFILL_START).cast("date"), F.col("winddirection") >= 180
    for wave, rows in enumerate((early & ~late, ~early, early & late, early & late)):
        distinct.add_wave(spark, raw.filter(rows), root, min(wave, 2), "ingestion_date", ["city", "country", "weathercode"])
    return root


def q_distinct_over_history(spark, d):
    """Distinct cities, countries and weather codes of every analysis window, and of one, two and four weeks, from bitmaps."""
    maps = distinct.read_bitmaps(spark, distinct_history(spark, d))
    found = distinct.distinct_over(maps, distinct.windows(spark, CATCHUP_START, AS_OF, [1, 8, 14, 28]))
    count = {n: F.coalesce(F.max(F.when(F.col("dimension") == n, F.col("n"))), F.lit(0)) for n in ("city", "country", "weathercode")}
    return found.groupBy("first", "last").agg(count["city"].alias("total_cities"), count["country"].alias("total_countries"),
                                              count["weathercode"].alias("weather_codes"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_customers": q_scan_customers,
    "scan_products": q_scan_products,
    "order_summary": q_order_summary,
    "sales_by_category": q_sales_by_category,
    "weather_flatten_json": q_weather_flatten_json,
    "weather_derive": q_weather_derive,
    "wind_category_counts": q_wind_category_counts,
    "weather_city_summary": q_weather_city_summary,
    "weather_analytics": q_weather_analytics,
    "city_fibonacci": q_city_fibonacci,
    "weather_run_summary": q_weather_run_summary,
    "temp_ranking": _report(reports.temp_ranking),
    "temp_extremes": _report(reports.temp_extremes),
    "climate_distribution": _report(reports.climate_distribution),
    "wind_patterns": _report(reports.wind_patterns),
    "variance_top5": _report(reports.variance_top5, spread=True),
    "variance_category_all": _report(reports.variance_category_all, spread=True),
    "report_summary": _report(reports.report_summary),
    "comfort_top5": _report(reports.comfort_top5),
    "usage_external_queries": q_usage_external_queries,
    "usage_id_dedup": q_usage_id_dedup,
    "usage_query_costs": q_usage_query_costs,
    "usage_query_rows": q_usage_query_rows,
    "usage_cost_metrics": q_usage_cost_metrics,
    "usage_metrics_all": q_usage_metrics_all,
    "usage_metric_counts": q_usage_metric_counts,
    "usage_metrics_empty": q_usage_metrics_empty,
    "usage_metrics_published": q_usage_metrics_published,
    "people_explode_format": q_people_explode_format,
    "people_count": q_people_count,
    "people_fallback": q_people_fallback,
    "mask_column": q_mask_column,
    "default_missing": q_default_missing,
    "tumbling_30m": _tumbling("30 minutes"),
    "tumbling_1h": _tumbling("1 hour"),
    "tumbling_1d": _tumbling("1 day"),
    "missing_days": q_missing_days,
    "missing_slots_30m": q_missing_slots_30m,
    "weather_raw_roundtrip": q_weather_raw_roundtrip,
    "weather_raw_recreated": q_weather_raw_recreated,
    "weather_historical": q_weather_historical,
    "backfill_range": q_backfill_range,
    "stream_weather_incremental": q_stream_weather_incremental,
    "stream_sales_incremental": q_stream_sales_incremental,
    "stream_usage_hourly": q_stream_usage_hourly,
    "stream_tumbling_30m": q_stream_tumbling_30m,
    "stream_order_summary": q_stream_order_summary,
    "stream_category_totals": q_stream_category_totals,
    "stream_weather_reports": q_stream_weather_reports,
    "catchup_backfill": q_catchup_backfill,
    "stream_usage_id_dedup": q_stream_usage_id_dedup,
    "stream_usage_watermark": q_stream_usage_watermark,
    "order_summary_bucketed": q_order_summary_bucketed,
    "weather_rejected": q_weather_rejected,
    "usage_published_counts": q_usage_published_counts,
    "weather_inserted": q_weather_inserted,
    "distinct_over_history": q_distinct_over_history,
}

# Double columns fixed to N decimals in both engines before comparison
# (sums of floats differ in the last bits between engines and plans).
_ANALYTICS_R = {"avg_temperature": 9, "temperature_variance": 9, "avg_windspeed": 9,
                "comfort_score": 9}
_RAW_R = {"temp_fahrenheit": 9, "temp_kelvin": 9, "comfort_index": 9}
_METRIC_R = {"value": 9}
ROUNDING: dict[str, dict[str, int]] = {
    "sales_by_category": {"total_quantity_sold": 2, "total_revenue": 2},
    "weather_derive": _RAW_R,
    "weather_raw_roundtrip": _RAW_R,
    "weather_city_summary": _ANALYTICS_R,
    "weather_analytics": _ANALYTICS_R,
    "weather_historical": _ANALYTICS_R,
    "backfill_range": _ANALYTICS_R,
    "stream_weather_incremental": _ANALYTICS_R,
    "city_fibonacci": {"total_product": 2, "avg_product": 2},
    "weather_run_summary": {"global_avg_temp": 9},
    "usage_query_costs": {"credits_attributed_compute": 9},
    "usage_cost_metrics": _METRIC_R,
    "usage_metrics_all": _METRIC_R,
    "usage_metrics_empty": _METRIC_R,
    "usage_metrics_published": _METRIC_R,
    "tumbling_30m": {"total_value": 4},
    "tumbling_1h": {"total_value": 4},
    "tumbling_1d": {"total_value": 4},
    "stream_sales_incremental": {"total_quantity_sold": 2, "total_revenue": 2},
    "stream_category_totals": {"total_quantity_sold": 2, "total_revenue": 2},
    "catchup_backfill": _ANALYTICS_R,
    "stream_usage_hourly": {"credits": 9},
    "stream_usage_watermark": {"credits": 9},
    "stream_tumbling_30m": {"total_value": 4},
}


def present(name: str, df: DataFrame) -> DataFrame:
    """Apply the comparison rounding for ``name`` (a no-op for most queries)."""
    r = ROUNDING.get(name)
    if not r:
        return df
    return df.select(*[fix_scale(c, r[c]).alias(c) if c in r else F.col(c) for c in df.columns])


def build(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    apply_runtime_defaults(spark)
    return present(name, QUERIES[name](spark, sf_dir))
