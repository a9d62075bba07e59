"""Map the driver's TPC-H-ish test tables onto the pipelines' tables.

Every mapping is a projection (plus joins to the 25-row nation / 5-row
region dimensions), so the derived tables grow 1:1 with the inputs and
Catalyst prunes every column the pipeline does not use. The oracle SQL
in ``cumulus.plans.oracle`` spells the same mappings for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Fixed analysis day for the event data (events span 2024-01-01..2024-01-30).
AS_OF = "2024-01-30"
# Fixed processing / load stamp so reruns and the oracle agree.
NOW = "2024-01-30 12:00:00"

STATUS = {"F": "completed", "O": "shipped", "P": "pending"}


# --------------------------------------------------------------------------- retail
def retail_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        c.c_custkey.alias("customer_id"),
        F.split_part(c.c_name, F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(c.c_name, F.lit("#"), F.lit(2)).alias("last_name"),
        c.c_nationkey.alias("nation_id"), c.c_acctbal.alias("balance"), c.c_mktsegment.alias("segment"))


def retail_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(p.p_partkey.alias("product_id"), p.p_type.alias("category"), p.p_name.alias("name"),
                    p.p_brand.alias("brand"), p.p_size.alias("size"), p.p_retailprice.alias("price"))


def retail_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    status = None
    for code, name in STATUS.items():
        cond = o.o_orderstatus == code
        status = F.when(cond, name) if status is None else status.when(cond, name)
    return o.select(
        o.o_orderkey.alias("order_id"), o.o_custkey.alias("customer_id"),
        o.o_orderdate.alias("order_date"), status.alias("status"),
        o.o_totalprice.alias("total_amount"))


def retail_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_items_from(read_table(spark, sf_dir, "lineitem"))


def order_items_from(li: DataFrame) -> DataFrame:
    """lineitem rows (batch or stream) -> order_items."""
    return li.select(
        li.l_orderkey.alias("order_id"), li.l_partkey.alias("product_id"),
        li.l_quantity.alias("quantity"),
        (li.l_extendedprice / li.l_quantity).alias("unit_price"))


# --------------------------------------------------------------------------- weather
def _city_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 cities (one per nation) with their fixed coordinates and country."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        n.n_nationkey.alias("city_key"), n.n_name.alias("city"), r.r_name.alias("country"),
        ((n.n_nationkey - 12) * 7.0).alias("latitude"),
        (n.n_nationkey * 15.0 - 180).alias("longitude"))


def expected_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city list of the ingest: one city per nation, and one per region that never loads."""
    n, r = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    return n.select(n.n_name.alias("city")).unionByName(r.select(F.concat(r.r_name, F.lit(" CITY")).alias("city")))


def _events_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.withColumn("city_key", F.pmod(e.user_id, F.lit(25)).cast("int"))


def _measures(j: DataFrame, spread: bool = False) -> list:
    """Reading measures of an events-x-cities row (shared by table and JSON forms)."""
    temp = j.value / 10 - 5
    if spread:
        temp = temp * (F.lit(0.05) + F.lit(0.1) * F.pmod(j.city_key, F.lit(5)))
    return [temp.alias("temperature"),
            (F.get_json_object(j.props, "$.k").cast("double") * 0.5).alias("windspeed"),
            F.pmod(j.event_id * 37, F.lit(360)).cast("double").alias("winddirection"),
            F.pmod(j.event_id, F.lit(100)).cast("int").alias("weathercode")]


def weather_readings(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The ten reading columns, one row per event.

    ``spread`` scales temperature by a per-city factor so the sample variances
    fall into all three variance classes, and adds a city per region with one
    reading without a wind speed, whose variance is NULL (used by the variance
    reports).
    """
    j = _events_by_city(spark, sf_dir).join(_city_dim(spark, sf_dir), "city_key")
    out = j.select("city", "country", "latitude", "longitude", *_measures(j, spread),
                   j.ts.alias("timestamp"), F.to_date(j.ts).alias("ingestion_date"))
    if not spread:
        return out
    r, at = read_table(spark, sf_dir, "region"), F.lit(f"{AS_OF} 06:00:00").cast("timestamp_ntz")
    lone = r.select(F.concat(r.r_name, F.lit(" CITY")).alias("city"), r.r_name.alias("country"),
                    (r.r_regionkey * 10.0).alias("latitude"), F.lit(0.0).alias("longitude"),
                    (r.r_regionkey * 5.0).alias("temperature"), F.lit(None).cast("double").alias("windspeed"),
                    F.lit(0.0).alias("winddirection"), F.lit(0).alias("weathercode"),
                    at.alias("timestamp"), F.to_date(at).alias("ingestion_date"))
    return out.unionByName(lone)


def geocode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(city, fetched_at, doc)``: two geocode responses per city, as JSON text.

    The first run's answers lie elsewhere (latitude and longitude swapped in
    sign); the second run's count. Defects of these on purpose: key % 5 = 0
    has ``{"results": []}``, key % 5 = 1 omits ``country`` (defaults to
    'Unknown'), key 7 has a null country (stays NULL), key 8 no latitude,
    key 13 a null longitude (both skipped), key 24 is not JSON.
    """
    c = _city_dim(spark, sf_dir)
    k = F.pmod(c.city_key, F.lit(5))

    def results(*cols, **options):
        return F.to_json(F.struct(F.array(F.struct(*cols)).alias("results")), options)

    good = ("latitude", "longitude", "country")
    doc = (F.when(c.city_key == 24, F.lit('{"results": [{"latitude": 1.0,'))
           .when(c.city_key == 7, results("latitude", "longitude", F.lit(None).cast("string").alias("country"),
                                          ignoreNullFields="false"))
           .when(c.city_key == 8, results("longitude", "country"))
           .when(c.city_key == 13, results("latitude", F.lit(None).cast("double").alias("longitude"), "country",
                                           ignoreNullFields="false"))
           .when(k == 0, F.lit('{"results": []}'))
           .when(k == 1, results("latitude", "longitude"))
           .otherwise(results(*good)))
    old = results((-c.latitude).alias("latitude"), (-c.longitude).alias("longitude"), "country")
    runs = F.explode(F.array(F.struct(F.lit("2024-01-01T00:00:00").alias("fetched_at"), old.alias("doc")),
                             F.struct(F.lit("2024-01-29T00:00:00").alias("fetched_at"), doc.alias("doc"))))
    return c.select("city", runs.alias("r")).select("city", F.col("r.fetched_at").alias("fetched_at"), "r.doc")


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(city, observed_at, doc)``: one current-weather response per event.

    Defects on purpose, the first that applies: event_id % 13 = 0 is truncated
    (malformed) JSON, % 19 = 0 has a null ``current_weather`` (skipped), % 11
    = 0 has none at all (zeros), % 7 = 0 omits temperature (zero), % 17 = 0
    has it null (stays NULL), % 23 = 0 sends numbers as text and the code with
    a decimal point, % 29 = 0 a temperature that is no number (NULL); % 31 = 0
    lacks the time of observation (the processing time counts).
    """
    j = _events_by_city(spark, sf_dir).join(_city_dim(spark, sf_dir), "city_key")
    seen = F.when(F.pmod(j.event_id, F.lit(31)) != 0, j.ts)
    rr = j.select("event_id", "city", seen.alias("observed_at"), *_measures(j))
    full = F.struct("temperature", "windspeed", "winddirection", "weathercode")
    no_temp = F.struct("windspeed", "winddirection", "weathercode")
    eid = rr.event_id
    null_temp = F.struct(F.lit(None).cast("double").alias("temperature"), "windspeed", "winddirection", "weathercode")
    as_text = F.struct(F.col("temperature").cast("string").alias("temperature"), "windspeed",
                       F.col("winddirection").cast("string").alias("winddirection"),
                       F.col("weathercode").cast("double").alias("weathercode"))
    bad_temp = F.struct(F.lit("mild").alias("temperature"), "windspeed", "winddirection", "weathercode")

    def wrapped(weather, **options):
        return F.to_json(F.struct(weather.alias("current_weather")), options)

    def every(n):
        return F.pmod(eid, F.lit(n)) == 0

    doc = (F.when(every(13), F.lit('{"current_weather": {"temperature": 1.0,'))
           .when(every(19), F.lit('{"current_weather": null}'))
           .when(every(11), F.lit('{"elevation": 10.0}'))
           .when(every(7), wrapped(no_temp))
           .when(every(17), wrapped(null_temp, ignoreNullFields="false"))
           .when(every(23), wrapped(as_text))
           .when(every(29), wrapped(bad_temp))
           .otherwise(F.to_json(F.struct(full.alias("current_weather")))))
    return rr.select("city", "observed_at", doc.alias("doc"))


# --------------------------------------------------------------------------- usage
LATER_PAGES = 1_000_000_000  # repeated listings come on pages after all others


def external_query_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page, doc)``: API pages ``{"externalQueries": [...]}`` as JSON text.

    Four orders a page; ``page`` is the page sequence number (source order).
    Every third order is listed again on a later page with another asset
    (the last listing counts), and every 17th has a time that can't be read.
    """
    o = read_table(spark, sf_dir, "orders")
    again = F.when(F.pmod(o.o_orderkey, F.lit(3)) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    o = o.withColumn("again", F.explode(again))
    page = F.floor(F.col("o_orderkey") / 4).cast("bigint") + F.col("again") * LATER_PAGES

    def rec(x):
        time = F.when(F.pmod(x["o_orderkey"], F.lit(17)) == 0, F.lit("not yet")).otherwise(
            F.date_format(x["o_orderdate"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        asset = F.when(x["again"] == 1, F.concat(F.lit("again "), x["o_orderpriority"])).otherwise(x["o_orderpriority"])
        return F.struct(
            x["o_orderkey"].cast("string").alias("queryId"),
            asset.alias("assetId"),
            F.concat(F.lit("dep-"), F.pmod(x["o_custkey"], F.lit(10)).cast("string")).alias("deploymentId"),
            F.concat(F.lit("run-"), F.to_date(x["o_orderdate"]).cast("string")).alias("runId"),
            F.concat(F.lit("dag-"), F.pmod(x["o_custkey"], F.lit(7)).cast("string")).alias("dagId"),
            x["o_orderstatus"].alias("taskId"),
            F.lit("ns").alias("namespace"),
            time.alias("queryTime"))

    # The orders are shuffled as they are; their records, twice as large, are made on the page.
    row = F.struct("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "again")
    listed = o.select(page.alias("page"), row.alias("row")).groupBy("page").agg(F.collect_list("row").alias("rows"))  # at most four
    items = F.sort_array(F.transform("rows", lambda x: F.struct(x["o_orderkey"].alias("k"), rec(x).alias("rec"))))
    doc = F.to_json(F.struct(F.transform(items, lambda x: x["rec"]).alias("externalQueries")))
    return listed.select("page", F.explode(F.array(doc)).alias("doc"))  # a generator, so that no filter makes the text again


def _usage_end_time(li: DataFrame):
    return (li.l_shipdate
            + F.make_dt_interval(F.lit(0), F.pmod(li.l_orderkey, F.lit(24)).cast("int"),
                                 (li.l_linenumber * 7).cast("int"), F.lit(0)))


def attribution_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution_from(read_table(spark, sf_dir, "lineitem"))


def attribution_from(li: DataFrame) -> DataFrame:
    """lineitem rows (batch or stream) -> query attribution history."""
    credits = F.when((li.l_returnflag == "N") & (li.l_linestatus == "O"), F.lit(None)) \
        .otherwise(li.l_extendedprice * li.l_discount / 1000)
    return li.select(li.l_orderkey.cast("string").alias("query_id"),
                     _usage_end_time(li).alias("end_time"),
                     credits.cast("double").alias("credits_attributed_compute"))


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    all_null = (li.l_returnflag == "R") & (li.l_linestatus == "F")

    def m(expr, extra_null=None):
        cond = all_null if extra_null is None else (all_null | extra_null)
        return F.when(cond, F.lit(None)).otherwise(expr).cast("bigint")

    return li.select(
        li.l_orderkey.cast("string").alias("query_id"),
        m(li.l_quantity).alias("rows_produced"),
        m(li.l_linenumber).alias("rows_inserted"),
        m(F.floor(li.l_extendedprice), li.l_returnflag == "R").alias("rows_updated"),
        m(F.round(li.l_discount * 100), li.l_returnflag == "R").alias("rows_deleted"),
        m(F.round(li.l_tax * 100)).alias("rows_unloaded"),
        m(F.floor(li.l_extendedprice) * 10 + li.l_linenumber).alias("total_elapsed_time"),
        m(li.l_orderkey * 1024 + li.l_linenumber, li.l_returnflag == "A").alias("bytes_scanned"),
        _usage_end_time(li).alias("end_time"))


# --------------------------------------------------------------------------- people / secrets
PEOPLE_PAGE = 8  # turns in one part of a conversation's people document


def people_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, part, doc)``: ``{"number": n, "people": [{craft, name}]}``.

    A conversation's document comes in parts of 8 turns, so no aggregation
    group grows with conversation length; ``number`` declares the length of
    the whole conversation in every part (one too many where conv_id % 5 = 0).
    """
    c = read_table(spark, sf_dir, "conversations")
    page = F.floor(c.turn / PEOPLE_PAGE).cast("bigint")
    wrong = F.when(F.pmod(F.col("doc_id"), F.lit(5)) == 0, 1).otherwise(0)
    whole = c.groupBy(c.conv_id.alias("doc_id")).agg(F.count(F.lit(1)).alias("turns")).select(
        "doc_id", (F.col("turns") + wrong).alias("number"))
    grouped = c.groupBy(c.conv_id.alias("doc_id"), page.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct(
            c.turn.alias("turn"), c.role.alias("craft"),
            F.concat(F.lit("t"), c.turn.cast("string")).alias("name")))).alias("items"))
    people = F.transform("items", lambda x: F.struct(x["craft"].alias("craft"), x["name"].alias("name")))
    return grouped.join(whole, "doc_id").select(
        "doc_id", "part", F.to_json(F.struct("number", people.alias("people"))).alias("doc"))


def unusable_people_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, part, doc)`` whose documents are no people documents at all: the texts of the messages."""
    c = read_table(spark, sf_dir, "conversations")
    return c.select(c.conv_id.alias("doc_id"), c.turn.alias("part"), c.text.alias("doc"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, secret)`` strings of length 3, 8, 9 and 18, and NULLs."""
    c = read_table(spark, sf_dir, "customer")
    k = F.pmod(c.c_custkey, F.lit(4))
    s = (F.when(F.pmod(c.c_custkey, F.lit(10)) == 0, F.lit(None).cast("string"))
         .when(k == 0, c.c_name)
         .when(k == 1, F.substring(c.c_mktsegment, 1, 3))
         .when(k == 2, F.substring(c.c_mktsegment, 1, 8))
         .otherwise(F.substring(c.c_mktsegment, 1, 9)))
    return c.select(c.c_custkey.alias("id"), s.alias("secret"))
