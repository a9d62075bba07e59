import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from cumulus.operators import sinks, timeseries
from cumulus.plans import catalog
from cumulus.session import scratch_path
from cumulus.sources import fixtures as fx
from cumulus.sources.tables import WEATHER_HISTORICAL, read_table
from cumulus.streaming import incremental as inc

from .conftest import SF_SMALL, rows


def test_tumbling_epoch_aligned(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 29, 59), "a", 1.0),
                                (dt.datetime(2024, 1, 1, 0, 30, 0), "a", 2.0),
                                (dt.datetime(2024, 1, 1, 0, 45, 0), "a", 3.0)],
                               "ts timestamp_ntz, k string, v double")
    got = rows(timeseries.tumbling(df, "ts", "30 minutes", ["k"], "v"), "window_start", "n", "total_value")
    assert got == [(dt.datetime(2024, 1, 1, 0, 0), 1, 1.0), (dt.datetime(2024, 1, 1, 0, 30), 2, 5.0)]


def test_missing_intervals_per_key(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 1)), ("A", dt.date(2024, 1, 3)),
                                ("B", dt.date(2024, 1, 2))], "city string, d date")
    got = rows(timeseries.missing_intervals(df, "d", "2024-01-01", "2024-01-03", ["city"]))
    assert got == [("A", dt.date(2024, 1, 2)), ("B", dt.date(2024, 1, 1)), ("B", dt.date(2024, 1, 3))]
    overall = rows(timeseries.missing_intervals(df, "d", "2023-12-31", "2024-01-02"))
    assert overall == [(dt.date(2023, 12, 31),)]


def test_dynamic_overwrite_is_idempotent_and_keeps_other_partitions(spark):
    path = scratch_path(spark, "test_hist")
    a = catalog._analytics(spark, SF_SMALL)
    run1 = a.withColumn("dag_run_id", F.lit("r1"))
    sinks.write_table(run1, path, WEATHER_HISTORICAL, partition_by=["analysis_date", "dag_run_id"])
    sinks.write_table(a.withColumn("dag_run_id", F.lit("r2")), path, WEATHER_HISTORICAL,
                      partition_by=["analysis_date", "dag_run_id"])
    sinks.write_table(run1, path, WEATHER_HISTORICAL, partition_by=["analysis_date", "dag_run_id"])
    back = sinks.read_back(spark, path, WEATHER_HISTORICAL)
    n = a.count()
    assert back.count() == 2 * n
    assert back.filter("dag_run_id = 'r1'").count() == n
    assert back.columns == WEATHER_HISTORICAL.names


def test_replace_all_drops_other_partitions(spark):
    path = scratch_path(spark, "test_replace")
    a = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 1, 2), 2.0)], "d date, v double")
    b = spark.createDataFrame([(dt.date(2024, 1, 2), 3.0)], "d date, v double")
    sinks.write_table(a, path, partition_by=["d"])
    sinks.write_table(b, path, partition_by=["d"])
    assert rows(sinks.read_back(spark, path, a.schema)) == [(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 1, 2), 3.0)]
    sinks.write_table(b, path, partition_by=["d"], replace_all=True)
    assert rows(sinks.read_back(spark, path, a.schema)) == [(dt.date(2024, 1, 2), 3.0)]


def test_run_summary_one_row_when_empty(spark):
    from cumulus.operators import weather
    a = catalog._analytics(spark, SF_SMALL).limit(0)
    r = weather.run_summary(a, catalog.AS_OF).collect()
    assert len(r) == 1 and r[0].cities_analyzed == 0 and r[0].global_avg_temp is None


def test_conform_reorders_and_fills(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType()),
                           T.StructField("c", T.DoubleType())])
    out = sinks.conform(df, schema)
    assert out.schema == schema and out.first() == ("x", 1, None)


def test_omitted_column_takes_declared_default(spark):
    from cumulus.sources.tables import WEATHER_RAW
    df = spark.createDataFrame([("A", 1.0)], "city string, temperature double")
    r = sinks.conform(df, WEATHER_RAW).first()
    assert r.load_timestamp is not None and r.comfort_index is None and r.city == "A"


def test_publish_reports_empty_and_nonempty(spark):
    empty = spark.createDataFrame([], "category string, type string, value double")
    assert sinks.publish(empty, scratch_path(spark, "test_publish")) is False
    some = spark.createDataFrame([("COST", "T", 1.0), ("CUSTOM", "U", 2.0)],
                                 "category string, type string, value double")
    path = scratch_path(spark, "test_publish")
    assert sinks.publish(some, path) is True
    assert rows(sinks.read_back(spark, path, some.schema)) == [("COST", "T", 1.0), ("CUSTOM", "U", 2.0)]


def test_stream_usage_equals_batch_closed_windows(spark):
    got = rows(catalog.q_stream_usage_hourly(spark, SF_SMALL), "window_start", "n")
    a = fx.attribution_history(spark, SF_SMALL)
    wm = a.agg(F.max("end_time")).first()[0] - dt.timedelta(hours=6)
    batch = (a.groupBy(F.window("end_time", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("w.end") <= F.lit(wm)).select(F.col("w.start").alias("window_start"), "n"))
    assert got == rows(batch)


def test_stream_weather_equals_backfill(spark):
    inc_rows = rows(catalog.q_stream_weather_incremental(spark, SF_SMALL).drop("processing_timestamp"),
                    "analysis_date", "city", "record_count", "max_temperature")
    dates = catalog.weather.date_spine(spark, catalog.CATCHUP_START, catalog.AS_OF)
    full = catalog.weather.analytics_for_dates(catalog._raw(spark, SF_SMALL),
                                               catalog.weather.series_constants_20k(spark), dates)
    assert inc_rows == rows(full, "analysis_date", "city", "record_count", "max_temperature")


def test_stream_sales_equals_batch(spark):
    got = rows(catalog.q_stream_sales_incremental(spark, SF_SMALL), "category", "total_quantity_sold")
    want = rows(catalog.q_sales_by_category(spark, SF_SMALL), "category", "total_quantity_sold")
    assert got == want


def test_sales_stream_replay_is_idempotent(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    path, ck = scratch_path(spark, "t_sales"), scratch_path(spark, "t_ck")
    for _ in range(2):  # second start finds nothing new; partials unchanged
        items = inc.stream_source(spark, f"{SF_SMALL}/lineitem*.parquet", li.schema, fx.order_items_from)
        inc.sales_category_stream(spark, items, path, ck)
    got = rows(inc.sales_from_partials(spark, path, fx.retail_products(spark, SF_SMALL),
                                       fx.retail_orders(spark, SF_SMALL)), "category", "total_quantity_sold")
    assert got == rows(catalog.q_sales_by_category(spark, SF_SMALL), "category", "total_quantity_sold")


def test_invariants_on_fixture_tables(spark):
    from cumulus.operators import usage, weather
    meta = catalog._meta(spark, SF_SMALL)
    attr, hist = fx.attribution_history(spark, SF_SMALL), fx.query_history(spark, SF_SMALL)
    m = usage.all_metrics(attr, hist, meta)
    n_cost = usage.query_costs(attr, meta).count()
    n_use = usage.query_rows(hist, meta).count()
    assert m.filter("category = 'COST'").count() == n_cost
    assert m.filter("category = 'CUSTOM'").count() == 7 * n_use
    a = catalog._analytics(spark, SF_SMALL)
    fib = weather.city_fibonacci(a, weather.fibonacci(spark))
    per_city = {r.city: r["count"] for r in a.groupBy("city").count().collect()}
    assert {r.city: r.calculations for r in fib.collect()} == {c: 46 * n for c, n in per_city.items()}


def test_weather_stream_with_late_data_equals_full_recompute(spark):
    from cumulus.operators import weather
    from cumulus.sources.tables import WEATHER_ANALYTICS, WEATHER_RAW
    raw = catalog._raw(spark, SF_SMALL)
    early = F.col("ingestion_date") <= F.lit("2024-01-15").cast("date")
    held = F.pmod(F.hash("timestamp", "city"), F.lit(10)) == 0  # test-only split of the arrivals
    raw_path, out_path = scratch_path(spark, "late_raw"), scratch_path(spark, "late_out")
    ckpt, consts = scratch_path(spark, "late_ckpt"), weather.series_constants_20k(spark)
    waves = [raw.filter(early & ~held), raw.filter(~early), raw.filter(early & held)]
    for i, wave in enumerate(waves):
        sinks.write_table(wave, raw_path, WEATHER_RAW, partition_by=["ingestion_date"],
                          mode="append" if i else "overwrite")
        inc.weather_analytics_stream(spark, raw_path, out_path, ckpt, consts,
                                     as_of=catalog.AS_OF, now=catalog.NOW)
    got = sinks.read_back(spark, out_path, WEATHER_ANALYTICS)
    dates = weather.date_spine(spark, catalog.CATCHUP_START, catalog.AS_OF)
    want = weather.analytics_for_dates(raw, consts, dates, catalog.NOW)
    cols = ["analysis_date", "city", "record_count", "min_temperature", "max_temperature"]
    assert rows(got, *cols) == rows(want, *cols)


def test_tumbling_stream_drops_rows_later_than_watermark(spark):
    landing, sink = scratch_path(spark, "late_landing"), scratch_path(spark, "late_sink")
    ckpt = scratch_path(spark, "late_ckpt2")
    schema = "end_time timestamp_ntz, credits_attributed_compute double"
    t = dt.datetime(2024, 1, 1)

    def land(batch, name):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{landing}/{name}")

    def run():
        src = spark.readStream.schema(schema).parquet(f"{landing}/*")
        inc.usage_hourly_stream(spark, src, sink, ckpt)
        return {r.window_start: (r.n, r.credits)
                for r in sinks.read_back(spark, sink, inc.HOURLY_USAGE).collect()}

    land([(t, 1.0), (t + dt.timedelta(minutes=30), 2.0), (t + dt.timedelta(hours=8), 4.0)], "a")
    first = run()  # watermark = 08:00 - 6 h = 02:00 -> the 00:00 and 01:00 windows can close
    assert first == {t: (2, 3.0)}
    # 00:10 is now later than the watermark (dropped); 09:00 moves the watermark to 03:00
    land([(t + dt.timedelta(minutes=10), 100.0), (t + dt.timedelta(hours=9), 8.0)], "b")
    second = run()
    assert second == {t: (2, 3.0)}


def test_sales_stream_many_batches_sum_to_batch_result(spark):
    landing = scratch_path(spark, "items_landing")
    li = read_table(spark, SF_SMALL, "lineitem")
    li.repartition(3, "l_orderkey").write.parquet(landing)  # three files -> three micro-batches
    items = inc.stream_source(spark, landing, li.schema, fx.order_items_from, max_files_per_trigger=1)
    path = scratch_path(spark, "items_partials")
    q = inc.sales_category_stream(spark, items, path, scratch_path(spark, "ck"))
    assert sum(1 for p in q.recentProgress if p["numInputRows"] > 0) == 3
    got = {r.category: (r.total_quantity_sold, round(r.total_revenue, 4))
           for r in inc.sales_from_partials(spark, path, fx.retail_products(spark, SF_SMALL),
                                         fx.retail_orders(spark, SF_SMALL)).collect()}
    want = {r.category: (r.total_quantity_sold, round(r.total_revenue, 4))
            for r in catalog.q_sales_by_category(spark, SF_SMALL).collect()}
    assert got == want


def test_items_before_their_order_and_status_changes_count(spark):
    landing, path, ck = (scratch_path(spark, n) for n in ("waves", "waves_partials", "waves_ck"))
    schema = "order_id long, product_id long, quantity double, unit_price double"
    products = spark.createDataFrame([(1, "A"), (2, "B")], "product_id long, category string")

    def wave(items, name):
        spark.createDataFrame(items, schema).coalesce(1).write.parquet(f"{landing}/{name}")
        inc.sales_category_stream(spark, spark.readStream.schema(schema).parquet(f"{landing}/*"), path, ck)

    def sales_now(orders):
        o = spark.createDataFrame(orders, "order_id long, status string")
        return {r.category: (r.total_quantity_sold, r.total_revenue)
                for r in inc.sales_from_partials(spark, path, products, o).collect()}

    wave([(10, 1, 2.0, 3.0), (11, 2, 1.0, 1.0)], "a")
    assert sales_now([(10, "completed")]) == {"A": (2.0, 6.0)}  # order 11 hasn't come yet
    wave([(10, 1, 1.0, 4.0)], "b")
    assert sales_now([(10, "completed"), (11, "pending")]) == {"A": (3.0, 10.0)}
    assert sales_now([(10, "completed"), (11, "shipped")]) == {"A": (3.0, 10.0), "B": (1.0, 1.0)}


def test_window_partials_do_not_depend_on_order_or_split(spark):
    t = dt.datetime(2024, 1, 1)
    schema = "end_time timestamp_ntz, credits double"
    data = [(t + dt.timedelta(minutes=17 * i), float(i)) for i in range(200)]
    want = None
    for n, order in ((1, data), (5, data[::-1]), (7, data[1::2] + data[::2])):
        landing, path = scratch_path(spark, "order"), scratch_path(spark, "order_out")
        for k in range(n):
            spark.createDataFrame(order[k::n], schema).coalesce(1).write.mode("append").parquet(landing)
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        inc.window_partials_stream(src, "end_time", "1 hour", path, scratch_path(spark, "ck"), value="credits")
        got = rows(inc.windows_from_partials(spark, path, "1 hour", "6 hours"))
        want = want or got
        assert got == want and len(got) > 40


def test_missing_days_of_a_city_that_never_loaded(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, 1))], "city string, d date")
    expected = spark.createDataFrame([("A",), ("Z",)], "city string")
    got = rows(timeseries.missing_intervals(df, "d", "2024-01-01", "2024-01-02", ["city"], expected))
    assert got == [("A", dt.date(2024, 1, 2)), ("Z", dt.date(2024, 1, 1)), ("Z", dt.date(2024, 1, 2))]


def test_reports_read_one_partition_of_the_stored_table(spark):
    for name in ("temp_ranking", "city_fibonacci", "weather_run_summary"):
        plan = catalog.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
        assert "PartitionFilters: [isnotnull(analysis_date" in plan, plan
    assert catalog._stored_analytics(spark, SF_SMALL).select("analysis_date").distinct().count() > 1


def test_cap_of_the_weather_stream_is_the_day_of_the_batch(spark, monkeypatch):
    from cumulus.operators import weather
    from cumulus.sources.tables import WEATHER_ANALYTICS, WEATHER_RAW
    raw_path, out, ck = (scratch_path(spark, n) for n in ("cap_raw", "cap_out", "cap_ck"))
    consts = weather.series_constants_20k(spark)

    class Clock(dt.datetime):
        today = dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc)

        @classmethod
        def now(cls, tz=None):
            return cls.today

    monkeypatch.setattr(inc, "datetime", Clock)
    raw = catalog._raw(spark, SF_SMALL)
    for day in (10, 20):
        Clock.today = dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc)
        sinks.write_table(raw.filter(F.col("ingestion_date") == F.lit(f"2024-01-{day}").cast("date")), raw_path,
                          WEATHER_RAW, partition_by=["ingestion_date"], mode="append")
        inc.weather_analytics_stream(spark, raw_path, out, ck, consts, now=catalog.NOW)
    dates = {r[0] for r in sinks.read_back(spark, out, WEATHER_ANALYTICS).select("analysis_date").distinct().collect()}
    assert dates == {dt.date(2024, 1, 10), dt.date(2024, 1, 20)}


def test_scratch_is_shared_or_refused_and_can_be_cleared(spark):
    from types import SimpleNamespace

    import pytest

    from cumulus import session
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None),
                              sparkContext=SimpleNamespace(master="spark://x:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        session.checkpoint_root(cluster)


def test_arriving_files_grow_with_the_table(spark, tmp_path):
    spark.range(0, 6000, 1, 6).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' AS ts").write.parquet(
        f"{tmp_path}/events.parquet")
    files = read_table(spark, str(tmp_path), "events").rdd.getNumPartitions()
    assert files > 1
    stream, path = catalog._arriving(spark, str(tmp_path), "events"), scratch_path(spark, "t_arriving")
    inc.window_partials_stream(stream, "ts", "1 hour", path, scratch_path(spark, "t_ck"))
    landed = max(glob.glob(f"{scratch_path(spark, 'landed_events').rsplit('-', 1)[0]}-*"), key=os.path.getmtime)
    assert len(glob.glob(f"{landed}/part-*")) == catalog.LANDED_BATCHES * files
    got = sinks.read_back(spark, path, inc.WINDOW_PARTIALS).collect()
    assert len({r.batch_id for r in got}) == catalog.LANDED_BATCHES and sum(r.n for r in got) == 6000
