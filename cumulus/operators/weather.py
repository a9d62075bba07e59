"""Weather: JSON flattening, derived raw measures, per-city analytics.

Chain: documents -> readings -> raw (derived) -> per-city analytics ->
reports. The reference pads each statement with synthetic "load" queries
whose only effect on the data is a tiny constant (series sums scaled by
1e-5); those constants are computed here exactly, without materialising
the cross products (see ``series_constants_*``).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..sources import documents as docs
from .joins import salted_join

GROUP_KEYS = ["city", "country", "latitude", "longitude"]

# The configured city list of the ingest (in configured order).
DEFAULT_CITIES = [
    "New York", "London", "Tokyo", "Paris", "Sydney",
    "Mumbai", "Singapore", "Dubai", "Toronto", "Berlin",
    "Moscow", "Beijing", "Seoul", "Bangkok", "Cairo",
    "Istanbul", "Rome", "Madrid", "Amsterdam", "Vienna",
]
UNKNOWN_COUNTRY = "Unknown"
LOOKBACK_DAYS = 7
CENTRE = 15.0  # a usual temperature; any constant gives the same variance, a near one loses fewer digits
FIB_TERMS = 46  # n = 0..45


# --------------------------------------------------------------------------- constants
def series_constants_10m(spark: SparkSession) -> DataFrame:
    """One row ``(total_calc, avg_calc, std_calc)`` of
    ``sin(a)*cos(b)*tan(c/100)`` over a in 1..10000, b in 1..100, c in 1..10.

    The product of independent factors sums as the product of the factor
    sums, and likewise for squares, so one pass over 10,000 integers
    replaces the 10,000,000-row cross product (equal up to float rounding;
    checked against the brute-force form in the tests).
    """
    n = F.col("id")
    sums = spark.range(1, 10001).agg(
        F.sum(F.sin(n)).alias("sa"), F.sum(F.sin(n) ** 2).alias("qa"),
        F.sum(F.when(n <= 100, F.cos(n))).alias("sb"), F.sum(F.when(n <= 100, F.cos(n) ** 2)).alias("qb"),
        F.sum(F.when(n <= 10, F.tan(n / 100.0))).alias("sc"),
        F.sum(F.when(n <= 10, F.tan(n / 100.0) ** 2)).alias("qc"))
    rows = 10000 * 100 * 10
    total = F.col("sa") * F.col("sb") * F.col("sc")
    sq = F.col("qa") * F.col("qb") * F.col("qc")
    return sums.select(
        total.alias("total_calc"), (total / rows).alias("avg_calc"),
        F.sqrt((sq - total * total / rows) / (rows - 1)).alias("std_calc"))


def series_constants_20k(spark: SparkSession) -> DataFrame:
    """One row ``(total_calc, avg_calc)`` of ``sin(a/1000)*cos(b/1000)``,
    a in 1..1000, b in 1..20 (20,000 products), computed as a product of sums."""
    n = F.col("id")
    sums = spark.range(1, 1001).agg(F.sum(F.sin(n / 1000.0)).alias("sa"),
                                    F.sum(F.when(n <= 20, F.cos(n / 1000.0))).alias("sb"))
    total = F.col("sa") * F.col("sb")
    return sums.select(total.alias("total_calc"), (total / 20000).alias("avg_calc"))


def fibonacci(spark: SparkSession, terms: int = FIB_TERMS) -> DataFrame:
    """``(n, fib_n, fib_n_plus_1)`` for n = 0..terms-1, BIGINT.

    Each row folds the recurrence over an n-element array inside one
    expression — no recursive plan, no per-level job.
    """
    step = F.aggregate(
        F.array_repeat(F.lit(0), F.col("id").cast("int")),
        F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(1).cast("bigint").alias("b")),
        lambda acc, _: F.struct(acc["b"].alias("a"), (acc["a"] + acc["b"]).alias("b")))
    return spark.range(0, terms).select(
        F.col("id").alias("n"), step["a"].alias("fib_n"), step["b"].alias("fib_n_plus_1"))


# --------------------------------------------------------------------------- ingest
def city_seed(spark: SparkSession, cities=tuple(DEFAULT_CITIES)) -> DataFrame:
    """The configured cities as a one-column dimension (bounded by the config)."""
    return spark.createDataFrame([(c,) for c in cities], "city string")


def locations(geo_docs: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """``(city, country, latitude, longitude)`` from geocode documents.

    One row per city: the latest document (``fetched_at``, if there is such a
    column) decides, whatever it holds. Drops cities whose document is
    malformed, has no ``results``, or lacks a readable latitude or longitude;
    takes the first result; a missing country becomes 'Unknown', a null one
    stays NULL. ``cities`` (a one-column seed) restricts the output to
    configured cities.
    """
    if cities is not None:
        geo_docs = geo_docs.join(cities.select("city"), "city", "left_semi")
    when = F.col("fetched_at") if "fetched_at" in geo_docs.columns else F.lit("")
    latest = geo_docs.groupBy("city").agg(F.max_by("doc", F.struct(when, "doc")).alias("doc"))
    g = docs.parse_objects(latest, "doc", keep=["city"])
    results = F.from_json(F.col("fields")["results"], T.ArrayType(docs.OBJECT))
    g = g.select("city", F.explode(F.array(F.get(results, 0))).alias("first")).filter(F.col("first").isNotNull())
    first = F.col("first")
    country = F.when(F.map_contains_key(first, "country"), first["country"]).otherwise(UNKNOWN_COUNTRY)
    return g.select("city", country.alias("country"), first["latitude"].try_cast("double").alias("latitude"),
                    first["longitude"].try_cast("double").alias("longitude")
                    ).filter("latitude is not null and longitude is not null")


def current_weather(wx_docs: DataFrame, now=None) -> DataFrame:
    """``(city, temperature, windspeed, winddirection, weathercode, timestamp)``
    from current-weather documents. Malformed documents, and those whose
    ``current_weather`` is null or no object, are dropped; missing fields (or
    a missing ``current_weather``) default to 0; a null or unreadable field
    is NULL. The reading time is the document's ``observed_at``, else ``now``."""
    return _accepted(_judged_weather(wx_docs), now)


def _judged_weather(wx_docs: DataFrame, keep=("city", "observed_at")) -> DataFrame:
    """``keep``, ``v`` (the parsed document), ``cw`` (its current weather, NULL if there is none) and ``reason``, why it
    can't be used: NULL for those that can."""
    w = docs.parse_variant(wx_docs, "doc", keep=keep)
    w = w.withColumn("cw", F.try_variant_get("v", "$.current_weather", "variant"))
    reason = (F.when(F.col("v").isNull(), "malformed").when(~docs.is_object(F.col("v")), "no object")
              .when(F.is_variant_null("cw"), "null weather")
              .when(F.col("cw").isNotNull() & ~docs.is_object(F.col("cw")), "no weather object"))
    return w.withColumn("reason", reason)


def _accepted(judged: DataFrame, now=None) -> DataFrame:
    def field(name):  # missing (SQL NULL) and null (a Variant) differ; other types are cast where they can be
        value = F.try_variant_get("cw", f"$.{name}", "string").try_cast("double")
        return F.when(F.try_variant_get("cw", f"$.{name}", "variant").isNull(), 0.0).otherwise(value)

    return judged.filter(F.col("reason").isNull()).select(
        "city", field("temperature").alias("temperature"), field("windspeed").alias("windspeed"),
        field("winddirection").alias("winddirection"), field("weathercode").cast("int").alias("weathercode"),
        F.coalesce(F.col("observed_at").cast("timestamp_ntz"), X.as_timestamp(now)).alias("timestamp"))


def land_weather(wx_docs: DataFrame, path: str) -> None:
    """One parse, two outputs: each document goes, with its reason, to the ``accepted`` or ``rejected`` part of a table.

    Every document ends up in exactly one part; accepted ones keep their
    parsed form, rejected ones their text.
    """
    judged = _judged_weather(wx_docs, keep=("city", "observed_at", "doc"))
    out = judged.select("city", "observed_at", F.when(F.col("reason").isNotNull(), F.col("doc")).alias("doc"),
                        F.when(F.col("reason").isNull(), F.to_json("v")).alias("parsed"), "reason",
                        F.when(F.col("reason").isNull(), "accepted").otherwise("rejected").alias("part"))
    out.write.mode("overwrite").partitionBy("part").parquet(path)


LANDED_WEATHER = "city string, observed_at timestamp_ntz, doc string, parsed string, reason string, part string"


def flatten_weather_json(geo_docs: DataFrame, wx_docs: DataFrame, now=None,
                         cities: DataFrame | None = None) -> DataFrame:
    """Readings (the ten declared columns) from the two JSON sources.

    The location table has one row per city, so every reading stays one; it
    is an aggregate, so the join is salted (Spark broadcasts it when small).
    A city without a usable location contributes nothing (as a failed
    lookup skips the city).
    """
    loc = locations(geo_docs, cities)
    wx = current_weather(wx_docs, now)
    j = salted_join(wx, loc, "city")
    return j.select(
        "city", "country", "latitude", "longitude", "temperature", "windspeed",
        "winddirection", "weathercode", "timestamp", F.to_date("timestamp").alias("ingestion_date"))


def derive_weather(readings: DataFrame, constants: DataFrame, load_timestamp=None) -> DataFrame:
    """The declared raw table: readings + load stamp + derived measures.

    ``constants`` is the one-row ``series_constants_10m``; its values enter
    as scalar subqueries (computed once, merged into a single subquery by
    the optimizer) — no join with the readings at all.
    """
    total, avg, std = (constants.select(c).scalar() for c in ("total_calc", "avg_calc", "std_calc"))
    t, ws = F.col("temperature"), F.col("windspeed")
    return readings.select(
        "city", "country", "latitude", "longitude", "temperature", "windspeed",
        "winddirection", "weathercode", "timestamp", "ingestion_date",
        X.as_timestamp(load_timestamp).alias("load_timestamp"),
        (X.c_to_f(t) + total * 0.00001).alias("temp_fahrenheit"),
        (X.c_to_k(t) + avg * 0.00001).alias("temp_kelvin"),
        X.wind_category(ws).alias("wind_category"),
        X.comfort_index(t, ws, "latitude", std).alias("comfort_index"))


def wind_category_counts(raw: DataFrame) -> DataFrame:
    return raw.groupBy("wind_category").agg(F.count(F.lit(1)).alias("readings"))


# --------------------------------------------------------------------------- analytics
def _summary_aggs():
    return [F.avg("temperature").alias("avg_temperature"),
            F.min("temperature").alias("min_temperature"),
            F.max("temperature").alias("max_temperature"),
            F.var_samp("temperature").alias("temperature_variance"),
            F.avg("windspeed").alias("avg_windspeed"),
            F.max("windspeed").alias("max_windspeed"),
            F.avg("comfort_index").alias("comfort_score"),
            F.count(F.lit(1)).alias("record_count")]


def city_summary(raw: DataFrame, as_of, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Per (city, country, latitude, longitude) over ``ingestion_date >= as_of - days``.

    Lower bound inclusive, no upper bound. Sample variance (NULL for one
    row). Partial aggregation runs before the shuffle, so the exchange
    carries one row per city per task however skewed the cities are.
    """
    r = raw.filter(F.col("ingestion_date") >= F.date_sub(X.as_date(as_of), days))
    return (r.groupBy(*GROUP_KEYS).agg(*_summary_aggs())
            .withColumn("climate_zone", X.climate_zone("latitude")))


def _analytics_columns(summary: DataFrame, constants: DataFrame, analysis_date: Column, now) -> DataFrame:
    total, avg = (constants.select(c).scalar() for c in ("total_calc", "avg_calc"))
    return summary.select(
        analysis_date.alias("analysis_date"), "city", "country", "latitude", "longitude",
        (F.col("avg_temperature") + avg * 0.00001).alias("avg_temperature"),
        "min_temperature", "max_temperature", "temperature_variance",
        "avg_windspeed", "max_windspeed",
        (F.col("comfort_score") + total * 0.00001).alias("comfort_score"),
        "climate_zone", F.col("record_count").cast("bigint").alias("record_count"),
        X.as_timestamp(now).alias("processing_timestamp"))


def analytics(raw: DataFrame, constants: DataFrame, as_of, now=None,
              days: int = LOOKBACK_DAYS) -> DataFrame:
    """The declared analytics table for one analysis date."""
    return _analytics_columns(city_summary(raw, as_of, days), constants, X.as_date(as_of), now)


def analytics_for_dates(raw: DataFrame, constants: DataFrame, dates: DataFrame, now=None,
                        days: int = LOOKBACK_DAYS, first=None, last=None, listed=None) -> DataFrame:
    """Analytics for every date in ``dates`` (column ``analysis_date``) at once.

    Each analysis date d covers raw rows with ingestion_date in [d-days, d].
    Raw rows are reduced once to daily moments per city — count, mean and
    centred sum of squares (M2) of temperature, min/max, sums — and only
    those small daily rows are fanned out to the ``days + 1`` analysis dates
    they belong to, then merged by the sums of n, n * c and n * c^2, with c
    the daily mean less CENTRE so that the squares stay small. The raw table is scanned once whatever the
    number of dates.

    ``first`` / ``last`` (the earliest / latest analysis date, when known)
    become literal bounds on ``ingestion_date`` so only the partitions in
    [first - days, last] are read; ``listed`` (a short list of analysis dates)
    reads just the days of their windows.
    """
    t = F.col("temperature")
    if first is not None:
        raw = raw.filter(F.col("ingestion_date") >= F.date_sub(X.as_date(first), days))
    if last is not None:
        raw = raw.filter(F.col("ingestion_date") <= X.as_date(last))
    if listed is not None:
        needed = sorted({d - timedelta(days=k) for d in listed for k in range(days + 1)})
        raw = raw.filter(F.col("ingestion_date").isin(needed))
    daily = raw.groupBy(*GROUP_KEYS, "ingestion_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(t).alias("n_t"), F.avg(t).alias("mean_t"),
        (F.var_pop(t) * F.count(t)).alias("m2_t"), F.min(t).alias("min_t"), F.max(t).alias("max_t"),
        F.sum("windspeed").alias("s_ws"), F.count("windspeed").alias("n_ws"),
        F.max("windspeed").alias("max_ws"),
        F.sum("comfort_index").alias("s_ci"), F.count("comfort_index").alias("n_ci"))
    fan = daily.select("*", F.explode(F.sequence(F.col("ingestion_date"),
                                                 F.date_add("ingestion_date", days))).alias("analysis_date"))
    fan = fan.join(dates.select("analysis_date").distinct(), "analysis_date", "left_semi")
    fan = fan.withColumn("mean_t", F.col("mean_t") - CENTRE)
    n, s1 = F.sum("n_t"), F.sum(F.col("n_t") * F.col("mean_t"))
    merged = fan.groupBy("analysis_date", *GROUP_KEYS).agg(
        n.alias("n"), s1.alias("s1"),
        F.sum(F.col("n_t") * F.col("mean_t") * F.col("mean_t")).alias("s2"),
        F.sum("m2_t").alias("m2"),
        F.min("min_t").alias("min_temperature"), F.max("max_t").alias("max_temperature"),
        (F.sum("s_ws") / F.sum("n_ws")).alias("avg_windspeed"),
        F.max("max_ws").alias("max_windspeed"),
        (F.sum("s_ci") / F.sum("n_ci")).alias("comfort_score"),
        F.sum("n_rows").alias("record_count"))
    mean = F.try_divide(F.col("s1"), F.col("n"))
    m2 = F.col("m2") + F.col("s2") - F.col("s1") * mean
    var = F.when(F.col("n") > 1, F.greatest(m2, F.lit(0.0)) / (F.col("n") - 1))
    summary = merged.select(
        "analysis_date", *GROUP_KEYS, (mean + CENTRE).alias("avg_temperature"), "min_temperature",
        "max_temperature", var.alias("temperature_variance"), "avg_windspeed", "max_windspeed",
        "comfort_score", "record_count", X.climate_zone("latitude").alias("climate_zone"))
    return _analytics_columns(summary, constants, F.col("analysis_date"), now)


def date_spine(spark: SparkSession, start, end) -> DataFrame:
    """``analysis_date`` for every day in [start, end]."""
    return spark.range(1).select(F.explode(F.sequence(X.as_date(start), X.as_date(end))).alias("analysis_date"))


def city_fibonacci(analytics_df: DataFrame, fib: DataFrame) -> DataFrame:
    """Per city: ``COUNT(*)``, ``SUM`` and ``AVG`` of ``avg_temperature * fib_n``
    over every (analytics row, Fibonacci term) pair.

    Since the pair product factorises, the sums are taken per city and over
    the term set (a scalar subquery) and multiplied; no pairs are emitted.
    """
    fib_sum = fib.select(F.sum("fib_n").cast("double")).scalar()
    terms = fib.select(F.count(F.lit(1))).scalar()
    per_city = analytics_df.groupBy("city").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("avg_temperature").alias("t_sum"),
        F.count("avg_temperature").alias("t_cnt"))
    total = F.col("t_sum") * fib_sum
    return per_city.select(
        "city", (F.col("rows") * terms).alias("calculations"),
        total.alias("total_product"),
        F.try_divide(total, F.col("t_cnt") * terms).alias("avg_product"))


def run_summary(analytics_df: DataFrame, as_of) -> DataFrame:
    a = analytics_df.filter(F.col("analysis_date") == X.as_date(as_of))
    return a.agg(
        F.count_distinct("city").alias("cities_analyzed"),
        F.avg("avg_temperature").alias("global_avg_temp"),
        F.min("min_temperature").alias("global_min_temp"),
        F.max("max_temperature").alias("global_max_temp"),
        F.sum("record_count").alias("total_records"))
