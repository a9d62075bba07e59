import datetime as dt
import math

from pyspark.sql import functions as F

from cumulus.operators import weather as W
from cumulus.sources.tables import WEATHER_RAW

from .conftest import rows

D = dt.date


def _raw(spark, recs):
    """recs: (city, lat, temperature, windspeed, comfort, ingestion_date)."""
    data = [(c, "X", lat, 0.0, t, ws, 0.0, 0, dt.datetime.combine(d, dt.time()), d, None,
             None, None, None, ci) for c, lat, t, ws, ci, d in recs]
    return spark.createDataFrame(data, WEATHER_RAW)


def test_series_constants_match_brute_force(spark):
    fast = W.series_constants_10m(spark).first()
    n1 = spark.range(1, 10001).select(F.col("id").alias("a"))
    n2 = spark.range(1, 101).select(F.col("id").alias("b"))
    n3 = spark.range(1, 11).select(F.col("id").alias("c"))
    v = F.sin("a") * F.cos("b") * F.tan(F.col("c") / 100.0)
    slow = n1.crossJoin(n2).crossJoin(n3).agg(F.sum(v), F.avg(v), F.stddev_samp(v)).first()
    assert math.isclose(fast.total_calc, slow[0], rel_tol=1e-9)
    assert math.isclose(fast.avg_calc, slow[1], rel_tol=1e-9)
    assert math.isclose(fast.std_calc, slow[2], rel_tol=1e-9)
    f20 = W.series_constants_20k(spark).first()
    a = spark.range(1, 1001).select(F.col("id").alias("a"))
    b = spark.range(1, 21).select(F.col("id").alias("b"))
    v2 = F.sin(F.col("a") / 1000.0) * F.cos(F.col("b") / 1000.0)
    s20 = a.crossJoin(b).agg(F.sum(v2), F.avg(v2)).first()
    assert math.isclose(f20.total_calc, s20[0], rel_tol=1e-12)
    assert math.isclose(f20.avg_calc, s20[1], rel_tol=1e-12)


def test_fibonacci_46_terms(spark):
    f = W.fibonacci(spark).orderBy("n").collect()
    assert len(f) == 46
    assert (f[0].n, f[0].fib_n, f[0].fib_n_plus_1) == (0, 0, 1)
    assert (f[10].fib_n, f[45].fib_n, f[45].fib_n_plus_1) == (55, 1134903170, 1836311903)


def test_city_summary_window_and_single_row_variance(spark):
    as_of = D(2024, 1, 30)
    raw = _raw(spark, [
        ("A", 10.0, 1.0, 1.0, 50.0, as_of - dt.timedelta(days=7)),   # kept (inclusive bound)
        ("A", 10.0, 3.0, 3.0, 60.0, as_of),
        ("A", 10.0, 99.0, 9.0, 0.0, as_of - dt.timedelta(days=8)),   # dropped
        ("B", 70.0, 5.0, 2.0, 40.0, as_of + dt.timedelta(days=1)),   # no upper bound
    ])
    s = {r.city: r for r in W.city_summary(raw, as_of).collect()}
    assert s["A"].record_count == 2 and s["A"].avg_temperature == 2.0
    assert s["A"].temperature_variance == 2.0 and s["A"].max_temperature == 3.0
    assert s["A"].climate_zone == "Tropical" and s["B"].climate_zone == "Polar"
    assert s["B"].temperature_variance is None and s["B"].record_count == 1


def test_analytics_for_dates_equals_per_date_recompute(spark):
    import random
    rnd = random.Random(7)
    base = D(2024, 1, 1)
    recs = [(rnd.choice("ABC"), rnd.choice([10.0, 45.0]), rnd.uniform(-5, 40), rnd.uniform(0, 40),
             rnd.uniform(0, 100), base + dt.timedelta(days=rnd.randrange(20))) for _ in range(400)]
    raw = _raw(spark, recs)
    consts = W.series_constants_20k(spark)
    dates = W.date_spine(spark, "2024-01-05", "2024-01-19")
    merged = {(r.analysis_date, r.city, r.latitude): r for r in W.analytics_for_dates(raw, consts, dates, "2024-01-30 00:00:00").collect()}
    for day in range(5, 20):
        d = D(2024, 1, day)
        window = raw.filter(F.col("ingestion_date") <= F.lit(d))
        for r in W.analytics(window, consts, d, "2024-01-30 00:00:00").collect():
            m = merged.pop((d, r.city, r.latitude))
            for c in ["avg_temperature", "temperature_variance", "avg_windspeed", "comfort_score",
                      "min_temperature", "max_temperature", "max_windspeed"]:
                a, b = getattr(m, c), getattr(r, c)
                assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), c
            assert m.record_count == r.record_count and m.climate_zone == r.climate_zone
    assert not merged


def test_city_fibonacci_equals_cross_join(spark):
    a = spark.createDataFrame([("A", 1.5), ("A", -2.0), ("B", None), ("C", 3.25)],
                              "city string, avg_temperature double")
    fib = W.fibonacci(spark)
    got = {r.city: r for r in W.city_fibonacci(a, fib).collect()}
    p = a.crossJoin(fib).withColumn("p", F.col("avg_temperature") * F.col("fib_n"))
    want = {r.city: r for r in p.groupBy("city").agg(
        F.count(F.lit(1)).alias("calculations"), F.sum("p").alias("total_product"),
        F.avg("p").alias("avg_product")).collect()}
    assert set(got) == set(want)
    for c in want:
        assert got[c].calculations == want[c].calculations
        for k in ["total_product", "avg_product"]:
            x, y = got[c][k], want[c][k]
            assert (x is None and y is None) or math.isclose(x, y, rel_tol=1e-12)


def test_flatten_json_defects(spark):
    geo = spark.createDataFrame([
        ("ok", '{"results":[{"latitude":10.0,"longitude":20.0,"country":"Z"}]}'),
        ("nocountry", '{"results":[{"latitude":1.0,"longitude":2.0}]}'),
        ("empty", '{"results":[]}'), ("missing", "{}"), ("bad", '{"results":[{'),
    ], "city string, doc string")
    ts = dt.datetime(2024, 1, 2, 3, 4, 5)
    wx = spark.createDataFrame([
        ("ok", ts, '{"current_weather":{"temperature":5.5,"windspeed":3.0,"winddirection":90.0,"weathercode":2}}'),
        ("ok", ts, '{"current_weather":{"windspeed":3.0}}'),
        ("ok", None, '{"elevation":1}'),
        ("ok", ts, '{"current_weather":{"temperature":'),
        ("nocountry", ts, '{"current_weather":{"temperature":1.0}}'),
        ("empty", ts, '{"current_weather":{"temperature":1.0}}'),
        ("bad", ts, '{"current_weather":{"temperature":1.0}}'),
    ], "city string, observed_at timestamp_ntz, doc string")
    out = W.flatten_weather_json(geo, wx, now="2024-01-05 00:00:00")
    got = rows(out, "city", "country", "temperature", "windspeed", "weathercode", "timestamp", "ingestion_date")
    assert got == sorted([
        ("nocountry", "Unknown", 1.0, 0.0, 0, ts, D(2024, 1, 2)),
        ("ok", "Z", 0.0, 0.0, 0, dt.datetime(2024, 1, 5), D(2024, 1, 5)),
        ("ok", "Z", 0.0, 3.0, 0, ts, D(2024, 1, 2)),
        ("ok", "Z", 5.5, 3.0, 2, ts, D(2024, 1, 2)),
    ], key=repr)


def test_derive_weather_schema_and_values(spark):
    readings = spark.createDataFrame(
        [("A", "X", 30.0, 0.0, 22.0, None, 0.0, 0, dt.datetime(2024, 1, 1), D(2024, 1, 1))],
        "city string, country string, latitude double, longitude double, temperature double, "
        "windspeed double, winddirection double, weathercode int, timestamp timestamp_ntz, "
        "ingestion_date date")
    consts = spark.createDataFrame([(0.0, 0.0, 0.0)], "total_calc double, avg_calc double, std_calc double")
    r = W.derive_weather(readings, consts, "2024-01-01 00:00:00").first()
    assert r.temp_fahrenheit == 22.0 * 9 / 5 + 32 and r.temp_kelvin == 22.0 + 273.15
    assert r.wind_category == "Very Strong" and r.comfort_index is None
    assert [f.name for f in W.derive_weather(readings, consts).schema.fields] == WEATHER_RAW.names


def test_city_seed_restricts_locations(spark):
    geo = spark.createDataFrame([
        ("London", '{"results":[{"latitude":51.5,"longitude":-0.1,"country":"United Kingdom"}]}'),
        ("Nowhere", '{"results":[{"latitude":0.0,"longitude":0.0}]}')], "city string, doc string")
    seed = W.city_seed(spark)
    assert seed.count() == 20
    got = rows(W.locations(geo, seed))
    assert got == [("London", "United Kingdom", 51.5, -0.1)]


def test_json_lines_file_source(spark):
    import os
    from cumulus.session import scratch_path
    from cumulus.sources import documents as docs
    path = scratch_path(spark, "landing").replace("file:", "")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "geo.jsonl"), "w") as f:
        f.write('{"city":"A","doc":"{\\"results\\":[{\\"latitude\\":1.5,\\"longitude\\":2.5,\\"country\\":\\"Z\\"}]}"}\n')
        f.write('{"city":"B","doc":"{\\"results\\":["}\n')
        f.write('{"city":"C","doc":"{\\"results\\":[]}"}\n')
    landed = docs.read_landed(spark, path, "city string, doc string")
    assert landed.count() == 3
    assert rows(W.locations(landed)) == [("A", "Z", 1.5, 2.5)]


def test_latest_geocode_counts_once_per_city(spark):
    def geo(lat):
        return '{"results":[{"latitude":%s,"longitude":2,"country":"Z"}]}' % lat
    docs = spark.createDataFrame([("A", "2024-01-01", geo(1)), ("A", "2024-01-03", geo(3)), ("A", "2024-01-02", geo(2)),
                                  ("B", "2024-01-01", geo(1)), ("B", "2024-01-02", '{"results":[]}')],
                                 "city string, fetched_at string, doc string")
    wx = spark.createDataFrame([("A", None, '{"current_weather":{"temperature":1}}'),
                                ("B", None, '{"current_weather":{"temperature":1}}')],
                               "city string, observed_at timestamp_ntz, doc string")
    assert rows(W.flatten_weather_json(docs, wx, "2024-01-05 00:00:00"), "city", "latitude") == [("A", 3.0)]


def test_null_is_not_missing_and_types_are_cast(spark):
    geo = spark.createDataFrame([
        ("null country", '{"results":[{"latitude":"1.5","longitude":2,"country":null}]}'),
        ("no latitude", '{"results":[{"name":"x"}]}'), ("null latitude", '{"results":[{"latitude":null,"longitude":1}]}'),
        ("text", '{"results":[{"latitude":"north","longitude":1}]}'), ("null results", '{"results":null}'),
    ], "city string, doc string")
    assert rows(W.locations(geo)) == [("null country", None, 1.5, 2.0)]
    wx = spark.createDataFrame([(i, None, d) for i, d in enumerate([
        '{"current_weather":{"temperature":"5.5","windspeed":3,"weathercode":3.0}}',
        '{"current_weather":{"temperature":null,"windspeed":3}}',
        '{"current_weather":null}', '{"current_weather":7}', '{}', '[]', 'null', '',
        '{"current_weather":{"temperature":"mild"}}'])], "city int, observed_at timestamp_ntz, doc string")
    got = rows(W.current_weather(wx, "2024-01-05 00:00:00"), "city", "temperature", "windspeed", "weathercode")
    assert got == sorted([(0, 5.5, 3.0, 3), (1, None, 3.0, 0), (4, 0.0, 0.0, 0), (8, None, 0.0, 0)], key=repr)


def test_variance_of_a_large_mean_with_a_small_spread(spark):
    from cumulus.sources.tables import WEATHER_RAW as SCHEMA
    base = dict.fromkeys(SCHEMA.names)
    data = [base | {"city": "A", "country": "Z", "latitude": 1.0, "longitude": 1.0, "windspeed": 1.0, "comfort_index": 1.0,
                    "temperature": 1e6 + (d % 2) * 1e-3, "ingestion_date": D(2024, 1, d)} for d in range(1, 9)]
    raw = spark.createDataFrame([tuple(r[c] for c in SCHEMA.names) for r in data], SCHEMA)
    dates = spark.createDataFrame([(D(2024, 1, 8),)], "analysis_date date")
    consts = spark.createDataFrame([(0.0, 0.0)], "total_calc double, avg_calc double")
    v = W.analytics_for_dates(raw, consts, dates).first().temperature_variance
    assert 0 <= v < 0.01
