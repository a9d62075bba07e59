import datetime as dt

from pyspark.sql import functions as F

from cumulus.operators import people as P
from cumulus.operators import sales as S
from cumulus.operators import usage as U

from .conftest import rows

T0 = dt.datetime(2024, 1, 1)


def _retail(spark):
    customers = spark.createDataFrame([(1, "Ann", "Lee"), (2, "Bo", None)],
                                      "customer_id long, first_name string, last_name string")
    orders = spark.createDataFrame([
        (10, 1, T0, "completed", 100.0), (11, 2, T0, "shipped", 50.0),
        (12, 1, T0, None, 10.0), (13, 1, T0, "pending", 5.0)],
        "order_id long, customer_id long, order_date timestamp_ntz, status string, total_amount double")
    items = spark.createDataFrame([
        (10, 100, 2.0, 3.0), (10, None, 1.0, 1.0), (11, 101, 4.0, 2.0), (12, 100, 1.0, 1.0),
        (13, 101, 9.0, 9.0), (99, 100, 1.0, 1.0)],
        "order_id long, product_id long, quantity double, unit_price double")
    products = spark.createDataFrame([(100, "X"), (101, "Y")], "product_id long, category string")
    return customers, orders, items, products


def test_order_summary_edges(spark):
    c, o, i, _ = _retail(spark)
    got = rows(S.order_summary(o, c, i), "order_id", "customer_name", "item_count")
    # order 13 has an item; order 10's NULL product is not counted; NULL last name -> NULL
    assert got == sorted([(10, "Ann Lee", 1), (11, None, 1), (12, "Ann Lee", 1), (13, "Ann Lee", 1)], key=repr)


def test_sales_by_category_status_filter(spark):
    _, o, i, p = _retail(spark)
    got = rows(S.sales_by_category(i, p, o))
    assert got == [("X", 2.0, 6.0), ("Y", 4.0, 8.0)]


def test_sales_multiplicity_matches_direct_join(spark):
    _, o, i, p = _retail(spark)
    o2, p2 = o.unionByName(o.filter("order_id = 10")), p.unionByName(p.filter("product_id = 101"))
    direct = (i.join(p2, "product_id").join(o2, "order_id")
              .filter(F.col("status").isin("completed", "shipped")).groupBy("category")
              .agg(F.sum("quantity").alias("q"), F.sum(F.col("quantity") * F.col("unit_price")).alias("r")))
    assert rows(S.sales_by_category(i, p2, o2)) == rows(direct)


def _pages(spark, recs):
    import json
    docs = [(page, json.dumps({"externalQueries": [
        {"queryId": q, "assetId": a, "deploymentId": "d", "runId": "r", "dagId": "g",
         "taskId": "t", "namespace": "n", "queryTime": tm} for q, a, tm in items]}))
        for page, items in recs]
    return spark.createDataFrame(docs, "page long, doc string")


def test_external_queries_lag_window_and_last_wins(spark):
    pages = _pages(spark, [
        (1, [("q1", "first", "2024-01-01T05:00:00"), ("q2", "x", "2024-01-01T05:30:00")]),
        (2, [("q1", "second", "2024-01-01T05:59:59"), ("q1", "third", "2024-01-01T05:10:00")]),
        (3, [("q3", "late", "2024-01-01T06:00:00"), ("q4", "early", "2024-01-01T04:59:59")]),
    ])
    ex = U.external_queries(pages, "2024-01-01T11:00:00", "2024-01-01T12:00:00")
    assert sorted(r.queryId for r in ex.collect()) == ["q1", "q1", "q1", "q2"]
    meta = {r.queryId: r.assetId for r in U.dedup_last(ex).collect()}
    assert meta == {"q1": "third", "q2": "x"}


def _usage(spark):
    meta = spark.createDataFrame([("q1", "a", "d", "r", "g", "t", "n")],
                                 "queryId string, assetId string, deploymentId string, runId string, "
                                 "dagId string, taskId string, namespace string")
    attr = spark.createDataFrame([("q1", T0, None), ("q1", T0, 2.5), ("zz", T0, 1.0)],
                                 "query_id string, end_time timestamp_ntz, credits_attributed_compute double")
    hist = spark.createDataFrame([("q1", None, None, None, None, None, None, None, T0),
                                  ("q1", 1, 2, 3, 4, 5, 6, 7, T0), ("zz", 1, 1, 1, 1, 1, 1, 1, T0)],
                                 "query_id string, rows_produced long, rows_inserted long, rows_updated long, "
                                 "rows_deleted long, rows_unloaded long, total_elapsed_time long, "
                                 "bytes_scanned long, end_time timestamp_ntz")
    return meta, attr, hist


def test_metrics_nulls_and_counts(spark):
    meta, attr, hist = _usage(spark)
    m = U.all_metrics(attr, hist, meta)
    cost = rows(m.filter("category = 'COST'"), "value")
    assert cost == sorted([(None,), (2.5,)], key=repr)  # NULL credit stays NULL; unlisted id dropped
    custom = m.filter("category = 'CUSTOM'")
    assert custom.count() == 7 * 2
    zeros = custom.filter("value = 0").count()
    assert zeros == 7  # the all-NULL history row publishes seven zeros
    assert {r.timestamp for r in m.collect()} == {"2024-01-01T00:00:00.000000Z"}
    counts = {(r.category, r.type): r.n for r in U.metric_counts(m).collect()}
    assert counts[("COST", "SNOWFLAKE_CREDITS")] == 2 and len(counts) == 8


def test_empty_id_set_gives_empty_metrics_with_schema(spark):
    meta, attr, hist = _usage(spark)
    m = U.all_metrics(attr, hist, meta.limit(0))
    assert m.isEmpty()
    assert m.columns == ["category", "type", "value", *U.META, "timestamp"]


def test_people_fallback_and_messages(spark):
    bad = spark.createDataFrame([(1, 0, "not json")], "doc_id long, part long, doc string")
    parsed = P.with_fallback(spark, P.parse_people(bad))
    msgs = P.people_messages(parsed).collect()
    assert len(msgs) == 12
    assert msgs[0].message == "Oleg Kononenko is currently in space flying on the ISS! Hello! :)"
    cnt = P.people_count(parsed).first()
    assert (cnt.number, cnt.listed, cnt.consistent) == (12, 12, True)


def test_salted_join_is_exact_under_skew(spark):
    from cumulus.operators.joins import salted_join
    big = spark.range(0, 3000).select((F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id") % 50))
                                      .alias("k"), F.col("id").alias("v"))
    small = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    assert rows(salted_join(big, small, "k")) == rows(big.join(small, "k"))
    assert rows(salted_join(big, small, "k", "left")) == rows(big.join(small, "k", "left"))
    assert rows(salted_join(big, small, "k", "left_semi")) == rows(big.join(small, "k", "left_semi"))


def test_hot_key_spreads_over_the_salts(spark):
    from cumulus.operators.joins import SALTS, salted_join
    big = spark.range(0, 8000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(1, 10)], "k int, w int").hint("merge")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = [n for n in salted_join(big, small, "k").rdd.glom().map(len).collect() if n]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(parts) == 8000 and len(parts) > 1 and max(parts) < 8000 * 6 / SALTS


def test_building_usage_and_people_queries_starts_no_job(spark):
    from cumulus.plans import catalog

    from .conftest import SF_SMALL
    spark.sparkContext.setJobGroup("build-only", "plans are built, not run")
    try:
        for name in ("usage_cost_metrics", "usage_metric_counts", "people_count", "people_fallback"):
            catalog.QUERIES[name](spark, SF_SMALL)
        # reading a table's footer for its schema is a job of its own kind, so only joins and scans count here
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build-only")
        stages = [spark.sparkContext.statusTracker().getJobInfo(j).stageIds for j in jobs]
        assert all(len(s) == 1 for s in stages)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unreadable_query_time_is_dropped(spark):
    pages = _pages(spark, [(1, [("q1", "a", "soon"), ("q2", "b", "2024-01-01T05:30:00")])])
    got = U.external_queries(pages, "2024-01-01T11:00:00", "2024-01-01T12:00:00").collect()
    assert [r.queryId for r in got] == ["q2"]


def test_batch_counts_equal_counted_metrics(spark):
    meta, attr, hist = _usage(spark)
    want = rows(U.metric_counts(U.all_metrics(attr, hist, meta)), "category", "type", "n")
    assert rows(U.batch_counts(attr, hist, meta), "category", "type", "n") == want
    assert U.batch_counts(attr, hist, meta.limit(0)).isEmpty()


def _final_plan(df):
    """The rows, and the plan as it was run."""
    got = df.collect()
    return got, df._jdf.queryExecution().executedPlan().toString()


def _json_meta(spark, n):
    pages = _pages(spark, [(i, [(f"q{i}", f"a{i}", "2024-01-01T05:00:00")]) for i in range(n)])
    return U.external_queries(pages, "2024-01-01T11:00:00", "2024-01-01T12:00:00")


def test_metrics_dont_broadcast_the_metadata(spark):
    listed = _json_meta(spark, 5)
    _, attr, hist = _usage(spark)
    attr = attr.unionByName(attr.limit(1).withColumn("query_id", F.lit(None).cast("string")))
    got, plan = _final_plan(U.all_metrics(attr, hist, U.dedup_last(listed)))
    assert "Broadcast" not in plan and "Generate explode" not in plan
    assert len(got) == 2 + 7 * 2 and {r.assetId for r in got} == {"a1"}


def test_hot_id_is_split_when_metrics_are_built(spark):
    attr = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") < 30000, F.lit("q1")).otherwise(F.concat(F.lit("q"), F.col("id") % 50)).alias("query_id"),
        F.lit(T0).cast("timestamp_ntz").alias("end_time"), F.rand(1).alias("credits_attributed_compute"))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got, plan = _final_plan(U.cost_metrics(attr, U.dedup_last(_json_meta(spark, 50))))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == 40000 and "skew=true" in plan


def test_listed_ids_are_not_broadcast(spark):
    listed = _json_meta(spark, 5)
    _, attr, hist = _usage(spark)
    got, plan = _final_plan(U.query_costs(attr, listed))
    assert len(got) == 2 and "Broadcast" not in plan
    got, plan = _final_plan(U.query_rows(hist, listed))
    assert len(got) == 2 and "Broadcast" not in plan
    got, plan = _final_plan(U.batch_counts(attr, hist, listed))
    assert {r.n for r in got} == {2} and len(got) == 8 and "Broadcast" not in plan
