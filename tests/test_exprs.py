import datetime as dt

from pyspark.sql import functions as F

from cumulus.functions import exprs as X


def _one(spark, values, fn, typ="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_wind_category_boundaries(spark):
    got = _one(spark, [4.99, 5.0, 14.99, 15.0, 25.0, 34.99, 35.0, None], X.wind_category)
    assert got == ["Calm", "Light", "Light", "Moderate", "Strong", "Strong", "Very Strong",
                   "Very Strong"]


def test_climate_zone_boundaries(spark):
    got = _one(spark, [23.5, 23.51, -40.0, 40.01, 60.0, -60.01, None, 0.0], X.climate_zone)
    assert got == ["Tropical", "Subtropical", "Subtropical", "Temperate", "Temperate", "Polar",
                   "Tropical", "Tropical"]


def test_variance_category_branches(spark):
    got = _one(spark, [None, 2.0, 2.01, 5.0, 5.01, 0.0], X.variance_category)
    assert got == ["No Data", "Low Variability", "Moderate Variability", "Moderate Variability",
                   "High Variability", "Low Variability"]


def test_mask_lengths(spark):
    got = _one(spark, ["abc", "abcdefgh", "abcdefghi", None], X.mask_secret, "string")
    assert got == ["abc*********", "abcd*********", "abcd*****fghi", None]


def test_default_missing(spark):
    assert _one(spark, ["x", None], X.default_missing, "string") == ["x", "Not found"]


def test_round_half_up_and_conversions(spark):
    assert _one(spark, [1.005, 2.25, -2.25, 0.04999999999999999], lambda c: X.round_half_up(c, 2)) \
        == [1.01, 2.25, -2.25, 0.05]
    assert _one(spark, [2.2499997, 2.25, -2.25], lambda c: X.round_half_up(c, 1)) == [2.2, 2.3, -2.3]
    assert _one(spark, [100.0, -40.0], X.c_to_f) == [212.0, -40.0]
    assert _one(spark, [0.0], X.c_to_k) == [273.15]


def test_comfort_index_formula(spark):
    df = spark.createDataFrame([(22.0, 10.0, 30.0)], "t double, w double, lat double")
    v = df.select(X.comfort_index("t", "w", "lat")).first()[0]
    import math
    assert abs(v - (100 - 0 - 5 + math.sin(math.radians(30)) * 10)) < 1e-12


def test_rfc3339_micros_no_zone_shift(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 123456),)], "ts timestamp_ntz")
    assert df.select(X.rfc3339("ts")).first()[0] == "2024-01-02T03:04:05.123456Z"


def test_concat_name_null(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "f string, l string")
    assert [r[0] for r in df.select(X.concat_name("f", "l")).collect()] == ["a b", None]
