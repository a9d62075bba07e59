"""Distinct counts from stored bitmaps: late and repeated waves, nulls, values beyond one block."""

from cumulus.operators import distinct as D
from cumulus.session import scratch_path

from .conftest import rows

SCHEMA = "day string, city string, code int"


def waves(spark, parts, root=None):
    root = root or scratch_path(spark, "distinct-test")
    for i, part in enumerate(parts):
        D.add_wave(spark, spark.createDataFrame(part, SCHEMA), root, i, "day", ["city", "code"])
    return root


def brute(data, ranges):
    out = []
    for first, last in ranges:
        for at, name in ((1, "city"), (2, "code")):
            n = len({r[at] for r in data if r[0] and first <= r[0] <= last and r[at] is not None})
            if n:
                out.append((first, last, name, n))
    return sorted(out)


def over(spark, root, ranges):
    asked = spark.createDataFrame(ranges, "first string, last string").selectExpr("date(first) first", "date(last) last")
    found = D.distinct_over(D.read_bitmaps(spark, root), asked)
    return rows(found.selectExpr("string(first)", "string(last)", "dimension", "n"))


def test_any_range_from_waves_with_late_and_repeated_rows(spark):
    data = [(f"2024-01-{1 + i % 9:02d}", f"c{i * i % 23}", i % 7 if i % 5 else None) for i in range(200)]
    data += [("2024-01-03", None, 3), (None, "never", 1), ("2024-01-20", "", 0)]
    parts = [data[:60], [], data[150:] + data[:20], data[60:150]]
    root = waves(spark, parts)
    ranges = [("2024-01-01", "2024-01-09"), ("2024-01-03", "2024-01-03"), ("2024-01-02", "2024-01-20"),
              ("2024-01-10", "2024-01-19"), ("2024-01-09", "2024-01-01")]
    assert over(spark, root, ranges) == brute(data, ranges)
    D.add_wave(spark, spark.createDataFrame(parts[3], SCHEMA), root, 3, "day", ["city", "code"])  # run again
    assert over(spark, root, ranges) == brute(data, ranges)
    names = spark.read.schema(D.DICTIONARY).parquet(f"{root}/dictionary")
    assert names.count() == names.select("dimension", "value").distinct().count() == names.select("number").distinct().count()


def test_more_values_than_a_block(spark):
    root = scratch_path(spark, "distinct-test")
    many = spark.range(100_000).selectExpr("'2024-01-01' as day", "string(id) as city", "int(id % 3) as code")
    for wave in range(2):
        D.add_wave(spark, many.filter(f"code >= {1 - wave}"), root, wave, "day", ["city", "code"])
    assert over(spark, root, [("2024-01-01", "2024-01-01")]) == [
        ("2024-01-01", "2024-01-01", "city", 100_000), ("2024-01-01", "2024-01-01", "code", 3)]
    assert D.read_bitmaps(spark, root).groupBy("dimension").count().filter("dimension = 'city'").first()["count"] > 3


def test_nothing_to_count(spark):
    root = waves(spark, [[], []])
    assert over(spark, root, [("2024-01-01", "2024-02-01")]) == []
