"""Streams of the retail chain, manifest-driven reports, the catch-up ledger, repeated listings."""

import datetime as dt
import itertools
import json
import os

import pytest
from pyspark.sql import functions as F

from cumulus.operators import reports, sales
from cumulus.plans import catalog as C
from cumulus.session import scratch_path
from cumulus.streaming import catchup, listings, manifest, orders
from cumulus.streaming import incremental as inc

from .conftest import SF_SMALL, rows

T0 = dt.datetime(2024, 1, 1)


def _stream(spark, path, df):
    return inc.stream_source(spark, path, df.schema)


@pytest.mark.parametrize("waves", [(0, 1, 2, 3), (3, 2, 1, 0), (1, 3, 0, 2)])
def test_order_summary_in_any_order_of_files(spark, waves):
    want = rows(sales.order_summary(C.fx.retail_orders(spark, SF_SMALL), C.fx.retail_customers(spark, SF_SMALL),
                                    C.fx.retail_order_items(spark, SF_SMALL)))
    got = C.order_waves(spark, SF_SMALL, waves)
    assert rows(got) == want


def test_order_items_meet_within_the_wait(spark):
    """Nulls, an order without items, an item without order, and an item that comes too late for its order."""
    o_schema = "order_id long, customer_id long, order_date timestamp_ntz, status string, total_amount double, landed_at timestamp"
    i_schema = "order_id long, product_id long, landed_at timestamp"
    day = dt.timedelta(hours=24)
    o1 = spark.createDataFrame([(k, 1, T0, None, 2.0, T0) for k in (1, 2, 3)] + [(None, 1, T0, "x", 1.0, T0)], o_schema)
    i1 = spark.createDataFrame([(1, 7, T0), (1, None, T0), (1, 7, T0), (2, None, T0), (9, 7, T0), (None, 7, T0)], i_schema)
    o2 = spark.createDataFrame([(4, 1, T0, "new", 1.0, T0 + day)], o_schema)
    i2 = spark.createDataFrame([(3, 7, T0 + day), (4, 8, T0 + day)], i_schema)
    customers = spark.createDataFrame([(1, "A", "B")], "customer_id long, first_name string, last_name string")
    op, ip, out, ckpt = (scratch_path(spark, n) for n in "oipc")
    for o, i in ((o1, i1), (o2, i2)):
        o.write.mode("append").parquet(op)
        i.write.mode("append").parquet(ip)
        orders.order_items_stream(_stream(spark, op, o), _stream(spark, ip, i), out, ckpt)
    got = orders.order_summary_from_partials(spark, out, customers).select("order_id", "item_count")
    assert rows(got) == [(1, 2), (2, 0), (4, 1)]


def test_waiting_orders_and_items_lie_in_files(spark):
    """No state in memory; late rows are dropped, batches out of reach are forgotten, a replay replaces itself, hot orders are whole."""
    o_schema = "order_id long, customer_id long, order_date timestamp_ntz, status string, total_amount double, landed_at timestamp"
    i_schema = "order_id long, product_id long, landed_at timestamp"
    hour = [T0 + dt.timedelta(hours=h) for h in range(60)]
    customers = spark.createDataFrame([(1, "A", "B")], "customer_id long, first_name string, last_name string")
    op, ip, out, ckpt = (scratch_path(spark, n) for n in "oipc")
    batches = [([(1, 0), (2, 0)], [(1, 0)] * 50 + [(3, 5)]),  # (order, hour of landing)
               ([(3, 6), (8, 11)], [(2, 6), (1, 7), (1, 1)]),  # 1 and its item of hour 7 are more than 6 hours apart
               ([(4, 30)], [(4, 30), (8, 30)]),
               ([(5, 48), (4, 20)], [(5, 48), (8, 16)])]  # rows of before hour 24 are late
    for o, i in batches:
        o = spark.createDataFrame([(k, 1, T0, "new", 2.0, hour[h]) for k, h in o], o_schema)
        i = spark.createDataFrame([(k, 7, hour[h]) for k, h in i], i_schema)
        o.write.mode("append").parquet(op)
        i.write.mode("append").parquet(ip)
        orders.order_items_stream(_stream(spark, op, o), _stream(spark, ip, i), out, ckpt)
    want = [(1, 51), (2, 1), (3, 1), (4, 1), (5, 1)]

    def got():
        return rows(orders.order_summary_from_partials(spark, out, customers).select("order_id", "item_count"))

    assert got() == want
    assert not os.path.exists(f"{ckpt}/state")
    assert all(sorted(os.listdir(f"{ckpt}/waiting/{kind}"))[-2:] == ["batch_id=2", "batch_id=3"]
               and not os.path.exists(f"{ckpt}/waiting/{kind}/batch_id=0") for kind in ("orders", "items"))
    for name in ("3", ".3.crc"):
        os.remove(f"{ckpt}/commits/{name}")
    orders.order_items_stream(_stream(spark, op, o), _stream(spark, ip, i), out, ckpt)
    assert got() == want


def _totals(spark, store):
    return {r.category: (round(r.total_quantity_sold, 6), round(r.total_revenue, 4)) for r in orders.category_totals(spark, store).collect()}


def test_category_totals_any_order_replay_and_compaction(spark):
    want = {r.category: (round(r.total_quantity_sold, 6), round(r.total_revenue, 4)) for r in sales.sales_by_category(
        C.fx.retail_order_items(spark, SF_SMALL), C.fx.retail_products(spark, SF_SMALL), C.fx.retail_orders(spark, SF_SMALL)).collect()}
    store = C.category_waves(spark, SF_SMALL, (3, 1, 0, 2), compact_every=3)
    assert _totals(spark, store) == want
    C.category_waves(spark, SF_SMALL, (3, 1, 0, 2), compact_every=3, store=store)  # all batches again, onto the same store
    assert _totals(spark, store) == want
    orders.compact(spark, store, 3)
    assert _totals(spark, store) == want
    touched = orders.stored_rows(spark, store)
    assert touched.count() == touched.select("category", "bucket").distinct().count() <= len(want) * orders.BUCKETS


def test_status_changes_are_signed_deltas(spark):
    products = spark.createDataFrame([(1, "a"), (2, "b")], "product_id long, category string")
    store, path, ckpt = (scratch_path(spark, n) for n in "spc")
    none = (None, None, None)
    steps = [
        ([("item", 1, 1, 2.0, 5.0, None, None)], {}),  # no order yet
        ([("order", 1, *none, "shipped", 1), ("item", 1, 2, 1.0, 3.0, None, None)], {"a": 10.0, "b": 3.0}),
        ([("order", 1, *none, "pending", 2), ("item", 1, 1, 1.0, 1.0, None, None)], {"a": 0.0, "b": 0.0}),
        ([("order", 1, *none, "shipped", 1)], {"a": 0.0, "b": 0.0}),  # an old status that comes late changes nothing
        ([("order", 1, *none, None, 3), ("order", None, *none, "shipped", 1)], {"a": 0.0, "b": 0.0}),
        ([("order", 1, *none, "completed", 4)], {"a": 11.0, "b": 3.0}),
    ]
    for change, want in steps:
        df = spark.createDataFrame(change, orders.CHANGE)
        df.write.mode("append").parquet(path)
        orders.category_totals_stream(_stream(spark, path, df), products, store, ckpt, compact_every=2)
        assert {k: v[1] for k, v in _totals(spark, store).items()} == want


def test_deltas_find_statuses_by_hashing(spark):
    """Before and after come from one pass over the statuses; equal rows, null order numbers and null amounts count as they did."""
    products = spark.createDataFrame([(1, "a"), (2, "b")], "product_id long, category string")
    store = scratch_path(spark, "s")
    none = (None, None, None)
    first = [("item", 1, 1, 2.0, 5.0, None, None)] * 2 + [("item", 1, 2, None, 5.0, None, None), ("item", 2, 2, 1.0, 1.0, None, None),
             ("order", 1, *none, "shipped", None), ("order", 2, *none, "shipped", 1), ("order", 2, *none, "shipped", 1)]
    second = [("order", 1, *none, "shipped", 5), ("order", 1, *none, "pending", 4), ("order", 2, *none, "pending", 2)]
    want = [[("b", 1.0, 1.0)], [("a", 4.0, 20.0), ("b", -1.0, -1.0)]]
    for batch_id, (change, sums) in enumerate(zip((first, second), want)):
        got = orders.category_deltas(spark, spark.createDataFrame(change, orders.CHANGE), batch_id, store, products)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "max_by(status" not in plan  # a string would be aggregated by sorting
        assert [tuple(r) for r in got.groupBy("category").agg(F.sum("quantity"), F.sum("revenue")).orderBy("category").collect()] == sums


def test_uncommitted_base_is_not_read(spark):
    products = spark.createDataFrame([(1, "a")], "product_id long, category string")
    store = scratch_path(spark, "s")
    batch = spark.createDataFrame([("item", 1, 1, 1.0, 4.0, None, None), ("order", 1, None, None, None, "shipped", 1)], orders.CHANGE)
    sums = orders.category_deltas(spark, batch, 0, store, products)
    orders.write_table(sums.withColumn("batch_id", F.lit(0).cast("long")), f"{store}/totals", partition_by=["batch_id"])
    stray = spark.createDataFrame([("a", 0, 99.0, 99.0, 0)], orders._BASE)
    orders.write_table(stray, f"{store}/base", partition_by=["generation"])  # a compaction that failed before its commit
    assert _totals(spark, store) == {"a": (1.0, 4.0)}
    orders.compact(spark, store, 0)
    assert _totals(spark, store) == {"a": (1.0, 4.0)} and orders.stored_rows(spark, store).count() == 1


def test_reports_follow_the_analytics(spark):
    path = C.report_waves(spark, SF_SMALL)
    dates = [r.analysis_date for r in spark.read.parquet(f"{path}/summary").select("analysis_date").distinct().collect()]
    assert len(dates) == 30
    whole = C.weather.analytics_for_dates(C._raw(spark, SF_SMALL), C.weather.series_constants_20k(spark),
                                          C.weather.date_spine(spark, min(dates), max(dates)), C.NOW).cache()
    for name, report in manifest.REPORTS.items():
        got = spark.read.parquet(f"{path}/{name}")
        want = report(whole)
        assert rows(got, *sorted(got.columns)) == rows(want, *sorted(want.columns)), name
    day = C.AS_OF
    one = reports.daily_ranking(whole).filter(F.col("analysis_date") == F.lit(day).cast("date")).drop("analysis_date", "place")
    assert rows(one) == rows(reports.temp_ranking(whole, day))


def test_followers_see_each_commit_once_and_resume(spark):
    path, ckpt, seen = scratch_path(spark, "m"), scratch_path(spark, "c"), []
    days = [dt.date(2024, 1, k) for k in range(1, 6)]
    fail = [True]

    def act(s, dates, version):
        if fail[0] and days[3] in dates:
            raise RuntimeError("broken off")
        seen.extend(dates)

    manifest.publish(spark, path, "analytics", 0, days[:2])
    manifest.publish(spark, path, "other", 0, days[4:])
    manifest.follow(spark, path, "analytics", ckpt, act)
    manifest.publish(spark, path, "analytics", 1, days[1:4])
    with pytest.raises(Exception, match="broken off"):
        manifest.follow(spark, path, "analytics", ckpt, act)
    fail[0] = False
    manifest.follow(spark, path, "analytics", ckpt, act)
    manifest.follow(spark, path, "analytics", ckpt, act)
    assert seen == days[:2] + days[1:4]


def test_catch_up_resumes_after_a_failure(spark):
    ledger, ran, broken = scratch_path(spark, "ledger"), [], [True]
    d = lambda k: dt.date(2024, 1, k)

    def run(first, last):
        if broken[0] and d(9) in catchup.day_list(first, last):
            raise RuntimeError("broken off")
        ran.append((first, last))

    assert catchup.catch_up(spark, ledger, d(4), d(5), run, "a") == [(d(4), d(5))]
    assert catchup.catch_up(spark, ledger, d(7), d(7), run, "a") == [(d(7), d(7))]
    with pytest.raises(RuntimeError):
        catchup.catch_up(spark, ledger, d(1), d(12), run, "b", longest=4)
    assert ran[2:] == [(d(1), d(3)), (d(6), d(6))]
    # another run leaves what b has claimed lately; b itself, or any run after the lease, takes it up
    other = catchup.missing_ranges(spark, ledger, d(1), d(12), "c", longest=4)
    assert rows(other) == [(d(12), d(12))]
    mine = rows(catchup.missing_ranges(spark, ledger, d(1), d(12), "b", longest=4))
    assert mine == [(d(12), d(12)), (d(8), d(11))] == rows(catchup.missing_ranges(spark, ledger, d(1), d(12), "c", lease="0 seconds", longest=4))
    broken[0] = False
    catchup.catch_up(spark, ledger, d(1), d(12), run, "b", longest=4)
    assert sorted(itertools.chain(*(catchup.day_list(*r) for r in ran))) == [d(k) for k in range(1, 13)]
    assert catchup.catch_up(spark, ledger, d(1), d(12), run, "b") == []


def test_listings_sent_twice_count_once(spark):
    def doc(*records):
        return json.dumps({"externalQueries": [{"queryId": q, "assetId": a, "queryTime": "1997-01-01T00:00:00"} for q, a in records]})

    schema = "page long, doc string, landed_at timestamp"
    hour = dt.timedelta(hours=1)
    waves = [[(5, doc(("x", "last"), ("y", "only")), T0)], [(1, doc(("x", "first"), ("x", "second")), T0 + hour), (2, "{broken", T0), (3, None, T0)],
             [(5, doc(("x", "last"), ("y", "only")), T0 + 2 * hour), (1, doc(("x", "first"), ("x", "second")), T0 + 2 * hour)]]
    path, out, ckpt = (scratch_path(spark, n) for n in "poc")
    for wave in waves:
        df = spark.createDataFrame(wave, schema)
        df.write.mode("append").parquet(path)
        listings.listings_stream(_stream(spark, path, df), out, ckpt, C.USAGE_START, C.USAGE_END)
    assert rows(listings.last_listings(spark, out), "queryId", "assetId", "listings") == [("x", "last", 3), ("y", "only", 1)]
