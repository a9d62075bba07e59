"""Exact distinct counts over history from stored bitmaps.

A dictionary numbers the distinct values once and for all; new values get
numbers of their own when they first appear. A day's values are then bits:
per day and block of numbers one bitmap of fixed size (4 KB), written when
the day is. The distinct count over any range of days is the union of its
days' bitmaps, so no earlier row is read again, whatever the range; a plain
distinct count over overlapping ranges would read every row once a range.

Bitmaps are exact, unlike sketches. They unite map-side, and what is
shuffled per range is one bitmap a block and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_date

DICTIONARY = "dimension string, value string, number long, wave int"
BITMAPS = "dimension string, block long, bits binary, wave int, day date"
WAVE, PART = 48, 32  # a number: the wave that brought the value, the task that numbered it, its place there


def values_of(rows: DataFrame, day: str, dimensions: list[str]) -> DataFrame:
    """Distinct (day, dimension, value), nulls left out as by COUNT(DISTINCT): one pass for all dimensions."""
    named = F.explode(F.map_from_arrays(F.array(*map(F.lit, dimensions)),
                                        F.array(*[F.col(c).cast("string") for c in dimensions])))
    return (rows.select(F.col(day).cast("date").alias("day"), named.alias("dimension", "value"))
            .filter("value is not null").distinct())


def number_new(known: DataFrame, seen: DataFrame, wave: int) -> DataFrame:
    """Dictionary rows of the values of ``seen`` that ``known`` doesn't have.

    Each task counts its own values in order, so no task sees all of them and
    numbers need not follow each other; those of different waves and tasks
    never meet.
    """
    new = seen.select("dimension", "value").distinct().join(known, ["dimension", "value"], "left_anti")
    dealt = new.repartitionByRange("dimension", "value").withColumn("task", F.spark_partition_id().cast("long"))
    place = F.row_number().over(Window.partitionBy("task").orderBy("dimension", "value"))
    return dealt.select("dimension", "value",
                        (F.shiftleft(F.lit(wave).cast("long"), WAVE) + F.shiftleft(F.col("task"), PART) + place).alias("number"),
                        F.lit(wave).alias("wave"))


def bitmaps(seen: DataFrame, dictionary: DataFrame, wave: int) -> DataFrame:
    """A row per day, dimension and block of numbers: the bitmap of the values seen that day."""
    numbered = seen.join(dictionary.select("dimension", "value", "number"), ["dimension", "value"])
    return (numbered.groupBy("dimension", F.bitmap_bucket_number("number").alias("block"), "day")
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
            .select("dimension", "block", "bits", F.lit(wave).alias("wave"), "day"))


def add_wave(spark: SparkSession, rows: DataFrame, root: str, wave: int, day: str, dimensions: list[str]) -> None:
    """Numbers what is new in ``rows`` and stores the wave's bitmaps under ``root``.

    A day may come in several waves (late rows); its bitmaps unite on read.
    Both tables are replaced wave by wave, so a wave that is run again, by
    itself the last one, changes nothing. Rows without a day are left out.
    """
    seen_path, names, maps = f"{root}/seen/wave={wave}", f"{root}/dictionary", f"{root}/bitmaps"
    values_of(rows.filter(F.col(day).isNotNull()), day, dimensions).write.mode("overwrite").parquet(seen_path)
    seen = spark.read.schema("day date, dimension string, value string").parquet(seen_path)
    known = (spark.read.schema(DICTIONARY).parquet(names).filter(F.col("wave") < wave) if wave
             else spark.createDataFrame([], DICTIONARY))
    only = {"partitionOverwriteMode": "dynamic"}
    number_new(known, seen, wave).write.partitionBy("wave").options(**only).mode("overwrite").parquet(names)
    dictionary = spark.read.schema(DICTIONARY).parquet(names)
    (bitmaps(seen, dictionary, wave).repartition("day").write.partitionBy("wave", "day").options(**only)
     .mode("overwrite").parquet(maps))


def read_bitmaps(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(BITMAPS).parquet(f"{root}/bitmaps")


def distinct_over(maps: DataFrame, ranges: DataFrame) -> DataFrame:
    """(first, last, dimension, n): distinct values in each range of days, ends included.

    Ranges name their days, so they meet the bitmaps by equality. A range
    without rows, or of no days, has no row here.
    """
    days = ranges.select("first", "last", F.explode(F.sequence("first", "last")).alias("day")).filter("first <= last")
    united = (maps.join(days, "day").groupBy("first", "last", "dimension", "block")
              .agg(F.bitmap_or_agg("bits").alias("bits")))
    return united.groupBy("first", "last", "dimension").agg(F.sum(F.bitmap_count("bits")).alias("n"))


def windows(spark: SparkSession, first, last, lengths: list[int]) -> DataFrame:
    """(first, last): for each day from ``first`` to ``last`` the ranges of so many days that end there."""
    day = spark.range(1).select(F.explode(F.sequence(as_date(first), as_date(last))).alias("last"))
    return (day.withColumn("length", F.explode(F.array(*map(F.lit, lengths))))
            .select(F.date_sub("last", F.col("length") - 1).alias("first"), "last"))
