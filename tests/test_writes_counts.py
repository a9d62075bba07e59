"""Bucketed tables, documents sorted into accepted and rejected, counts observed on the write, INSERTs."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from cumulus.operators import sales, sinks, usage, weather
from cumulus.plans import catalog as C
from cumulus.session import scratch_path
from cumulus.sources import bucketed
from cumulus.sources import fixtures as fx
from cumulus.sources.tables import METRICS, WEATHER_RAW

from .conftest import SF_SMALL, rows


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_bucketed_orders_join_without_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o, i = C.bucketed_orders(spark, SF_SMALL)
        joined = o.join(i.groupBy("order_id").agg(F.count("product_id").alias("n")), "order_id")
        assert "Exchange" not in _plan(joined)
        plain = C.fx.retail_orders(spark, SF_SMALL).join(
            C.fx.retail_order_items(spark, SF_SMALL).groupBy("order_id").agg(F.count("product_id").alias("n")), "order_id")
        assert "Exchange" in _plan(plain)
        assert rows(joined) == rows(plain)
        customers = C.fx.retail_customers(spark, SF_SMALL)
        stored = sales.order_summary_stored(o, customers, i)
        assert rows(stored) == rows(sales.order_summary(C.fx.retail_orders(spark, SF_SMALL), customers,
                                                        C.fx.retail_order_items(spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_appends_and_partitions(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id", (F.col("id") % 2).alias("p"))
    name, path = bucketed.new_name("t"), scratch_path(spark, "t")
    bucketed.write_bucketed(df.filter("p = 0"), name, path, ["k"], 4, partition_by=["p"])
    bucketed.write_bucketed(df.filter("p = 1"), name, path, ["k"], 4, partition_by=["p"])
    sums = spark.table(name).groupBy("k").agg(F.sum("id").alias("s"))
    assert "Exchange" not in _plan(sums)
    assert rows(sums) == rows(df.groupBy("k").agg(F.sum("id").alias("s")))
    assert spark.table(name).count() == 100
    bucketed.forget(spark, name)
    assert not spark.catalog.tableExists(name) and spark.read.parquet(path).count() == 100


DOCS = [("a", '{"current_weather": {"temperature": 1.5, "windspeed": "7", "weathercode": 3.0}}', None),
        ("b", "{broken", "malformed"), ("c", None, "malformed"), ("d", "[1]", "no object"), ("e", "7", "no object"),
        ("f", '{"current_weather": null}', "null weather"), ("g", '{"current_weather": 5}', "no weather object"),
        ("h", '{"current_weather": [1]}', "no weather object"), ("i", "{}", None), ("j", "", "malformed"),
        ("k", '{"current_weather": {"temperature": null, "windspeed": true, "winddirection": {"x": 1}}}', None)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([(c, None, d) for c, d, _ in DOCS], "city string, observed_at timestamp_ntz, doc string")


def test_each_document_is_accepted_or_rejected(spark, documents):
    path = scratch_path(spark, "landed")
    weather.land_weather(documents, path)
    t = spark.read.schema(weather.LANDED_WEATHER).parquet(path)
    assert t.count() == len(DOCS)
    assert rows(t.filter("part = 'rejected'"), "city", "reason", "doc") == sorted((c, r, d) for c, d, r in DOCS if r)
    good = rows(t.filter("part = 'accepted'"), "city", "doc", "reason")
    assert good == [(c, None, None) for c, _, r in DOCS if not r]


def test_accepted_documents_are_read_as_before(documents):
    got = rows(weather.current_weather(documents, C.NOW), "city", "temperature", "windspeed", "winddirection", "weathercode")
    assert got == [("a", 1.5, 7.0, 0.0, 3), ("i", 0.0, 0.0, 0.0, 0), ("k", None, None, None, 0)]


def test_counts_come_from_the_write(spark):
    df = C.q_usage_metrics_all(spark, SF_SMALL)
    path = scratch_path(spark, "m")
    got = sinks.publish_counted(df, path, [("COST", "SNOWFLAKE_CREDITS"), ("CUSTOM", "SNOWFLAKE_BYTES_SCANNED"), ("NO", "SUCH")], METRICS)
    stored = sinks.read_back(spark, path, METRICS).groupBy("category", "type").count()
    assert rows(got) == rows(stored.filter("type in ('SNOWFLAKE_CREDITS', 'SNOWFLAKE_BYTES_SCANNED')")) and got.count() == 2


def _metric_rows(spark, n, types, parts=4):
    return spark.range(0, n, 1, parts).select(
        F.lit("CUSTOM").alias("category"), F.concat(F.lit("T"), F.pmod("id", F.lit(types))).alias("type"),
        F.col("id").cast("double").alias("value"))


def test_published_rows_are_not_dealt_anew(spark):
    path, tracker = scratch_path(spark, "m"), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("publish-only", "a shuffle would be a second stage")
    try:
        got = sinks.publish_counted(_metric_rows(spark, 999, 3), path, [("CUSTOM", f"T{i}") for i in range(3)])
        stages = [tracker.getJobInfo(j).stageIds for j in tracker.getJobIdsForGroup("publish-only")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and all(len(s) == 1 for s in stages)
    assert rows(got) == [("CUSTOM", f"T{i}", 333) for i in range(3)]
    assert rows(spark.read.parquet(path), "value") == sorted([(float(i),) for i in range(999)], key=repr)


def test_more_batches_than_open_files_are_published_whole(spark):
    path, n = scratch_path(spark, "m"), sinks.OPEN_BATCHES + 7
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    df = _metric_rows(spark, 100 * n, n, 2)
    assert sinks.publish(df, path)
    assert rows(sinks.read_back(spark, path, df.schema)) == rows(df)
    again = df.filter("type = 'T1'").withColumn("value", F.lit(-1.0))  # replaces its batch only
    assert sinks.publish(again, path)
    want = rows(df.filter("type != 'T1'").unionByName(again))
    assert rows(sinks.read_back(spark, path, df.schema)) == want
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == before


def test_published_files_are_in_time_order(spark):
    import pyarrow.dataset as ds
    n = 400
    facts = spark.range(0, n, 1, 3).select(
        F.concat(F.lit("q"), F.pmod("id", F.lit(50))).alias("query_id"),
        F.when(F.col("id") % 40 != 0, F.timestamp_micros(F.pmod(F.col("id") * 7919, F.lit(n)) * 1_000_000_007).cast("timestamp_ntz"))
        .alias("end_time"), F.col("id").cast("double").alias("credits_attributed_compute"), *[F.col("id").alias(m) for m in usage.USAGE_TYPES])
    meta = spark.range(0, 40).select(F.concat(F.lit("q"), "id").alias("queryId"), *[F.concat(F.lit(m), "id").alias(m) for m in usage.META])
    plain = usage.all_metrics(facts, facts, meta)
    assert rows(usage.all_metrics(facts, facts, meta, by_time=True)) == rows(plain)
    path = scratch_path(spark, "m")
    assert sinks.publish(usage.all_metrics(facts, facts, meta, by_time=True), path, schema=METRICS)
    assert rows(sinks.read_back(spark, path, METRICS)) == rows(sinks.conform(plain, METRICS))
    times = [[t or "" for t in f.to_table(columns=["timestamp"])["timestamp"].to_pylist()] for f in ds.dataset(path).get_fragments()]
    assert all(t == sorted(t) for t in times)
    assert sum(map(len, times)) == 8 * 320 and max(map(len, times)) > 1


def test_pages_are_made_of_shuffled_orders(spark, tmp_path):
    import json
    o = spark.createDataFrame(
        [(3, 25, "F", 1.0, dt.datetime(2024, 1, 1, 5), "1-URGENT"), (3, 25, "F", 1.0, dt.datetime(2024, 1, 1, 5), "1-URGENT"),
         (2, None, None, 1.0, None, None), (17, 8, "O", 1.0, dt.datetime(2024, 1, 2), "5-LOW"), (None, 1, "P", 1.0, None, "x")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    o.write.parquet(f"{tmp_path}/orders.parquet")
    pages = fx.external_query_documents(spark, str(tmp_path))
    got = {r.page: json.loads(r.doc)["externalQueries"] for r in pages.collect()}
    urgent = {"queryId": "3", "assetId": "1-URGENT", "deploymentId": "dep-5", "runId": "run-2024-01-01", "dagId": "dag-4",
              "taskId": "F", "namespace": "ns", "queryTime": "2024-01-01T05:00:00.000000"}
    assert got == {
        0: [{"queryId": "2", "namespace": "ns"}, urgent, urgent],
        fx.LATER_PAGES: [urgent | {"assetId": "again 1-URGENT"}] * 2,
        4: [{"queryId": "17", "assetId": "5-LOW", "deploymentId": "dep-8", "runId": "run-2024-01-02", "dagId": "dag-1",
             "taskId": "O", "namespace": "ns", "queryTime": "not yet"}],
        None: [{"assetId": "x", "deploymentId": "dep-1", "dagId": "dag-1", "taskId": "P", "namespace": "ns"}]}
    shuffled = pages._jdf.queryExecution().executedPlan().toString().rpartition("Exchange")[2]
    assert "o_orderkey" in shuffled and "dep-" not in shuffled


def test_insert_forms(spark):
    name, path = bucketed.new_name("t"), scratch_path(spark, "t")
    sinks.create_table(spark, name, path, WEATHER_RAW)
    one = spark.sql("SELECT 'x' AS city, 3 AS weathercode, 1.5D AS temperature")
    sinks.insert_columns(one, name)
    r = spark.table(name).first()
    assert (r.city, r.weathercode, r.temperature, r.country) == ("x", 3, 1.5, None) and r.load_timestamp is not None
    whole = sinks.conform(one, WEATHER_RAW, {})
    sinks.insert_by_position(whole.toDF(*[f"c{i}" for i in range(len(whole.columns))]), name)
    assert spark.table(name).filter("load_timestamp is null").count() == 1
    with pytest.raises(Exception, match="INCOMPATIBLE_DATA_FOR_TABLE|CANNOT_SAFELY_CAST"):
        sinks.insert_columns(spark.sql("SELECT DATE '2024-01-01' AS temperature"), name)
    with pytest.raises(Exception, match="(?i)column"):
        sinks.insert_by_position(one, name)
    bucketed.forget(spark, name)


def test_rewritten_table_gives_fresh_reports(spark, tmp_path):
    import shutil
    for t in ("events", "nation", "region"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    before = C.q_weather_run_summary(spark, str(tmp_path)).first()
    few = spark.read.parquet(f"{SF_SMALL}/events.parquet").filter("user_id % 25 < 3").toPandas()
    few.to_parquet(tmp_path / "events.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    after = C.q_weather_run_summary(spark, str(tmp_path)).first()
    assert before.cities_analyzed > 3 >= after.cities_analyzed > 0
