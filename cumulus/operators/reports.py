"""The seven weather reports over the analytics table (one analysis date).

Top-k reports are ``orderBy(...).limit(k)`` — planned as a single
``TakeOrderedAndProject`` (per-partition top-k, then a k-row merge), never
a full sort. Every ordering has a unique tie-breaker (city, country) and
explicit NULL placement so results do not depend on the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_date, c_to_f, round_half_up, variance_category



def _tie():
    return [F.col("city").asc_nulls_last(), F.col("country").asc_nulls_last()]


def _today(a: DataFrame, as_of) -> DataFrame:
    return a.filter(F.col("analysis_date") == as_date(as_of))


def temp_ranking(a: DataFrame, as_of, k: int = 10) -> DataFrame:
    return (_today(a, as_of).orderBy(F.col("avg_temperature").desc_nulls_last(), *_tie()).limit(k)
            .select("city", "country",
                    round_half_up("avg_temperature", 1).alias("avg_temp_c"),
                    round_half_up(c_to_f("avg_temperature"), 1).alias("avg_temp_f"),
                    round_half_up("avg_windspeed", 1).alias("avg_wind_kmh"),
                    "climate_zone"))


def temp_extremes(a: DataFrame, as_of) -> DataFrame:
    t = _today(a, as_of)

    def branch(label, col, order):
        return (t.orderBy(order, *_tie()).limit(1)
                .select(F.lit(label).alias("category"), "city", "country",
                        round_half_up(col, 1).alias("temperature_c"),
                        round_half_up(c_to_f(col), 1).alias("temperature_f")))

    hot = branch("Hottest City", "max_temperature", F.col("max_temperature").desc_nulls_last())
    cold = branch("Coldest City", "min_temperature", F.col("min_temperature").asc_nulls_last())
    return hot.unionByName(cold)


def climate_distribution(a: DataFrame, as_of) -> DataFrame:
    return (_today(a, as_of).groupBy("climate_zone")
            .agg(F.count_distinct("city").alias("city_count"),
                 round_half_up(F.avg("avg_temperature"), 1).alias("avg_temp"),
                 round_half_up(F.avg("comfort_score"), 1).alias("avg_comfort"))
            .orderBy(F.col("city_count").desc(), F.col("climate_zone")))


def wind_patterns(a: DataFrame, as_of) -> DataFrame:
    t = _today(a, as_of)

    def branch(label, col, order):
        return (t.orderBy(order, *_tie()).limit(1)
                .select(F.lit(label).alias("category"), "city", "country",
                        round_half_up(col, 1).alias("wind_speed_kmh")))

    windy = branch("Windiest City", "max_windspeed", F.col("max_windspeed").desc_nulls_last())
    # "calmest" is by the average, as in the source report
    calm = branch("Calmest City", "avg_windspeed", F.col("avg_windspeed").asc_nulls_last())
    return windy.unionByName(calm)


def _variance_columns(t: DataFrame) -> DataFrame:
    return t.select("city", "country",
                    round_half_up(F.coalesce("temperature_variance", F.lit(0.0)), 2).alias("temp_variance"),
                    round_half_up("avg_temperature", 1).alias("avg_temp"),
                    variance_category("temperature_variance").alias("variance_category"))


def variance_top5(a: DataFrame, as_of, k: int = 5) -> DataFrame:
    t = _today(a, as_of).filter(F.col("temperature_variance").isNotNull())
    return _variance_columns(t.orderBy(F.col("temperature_variance").desc(), *_tie()).limit(k))


def variance_category_all(a: DataFrame, as_of) -> DataFrame:
    """Every city's variance class, NULL variances included ('No Data')."""
    return _variance_columns(_today(a, as_of))


def _summary_columns() -> list:
    return [F.count_distinct("city").alias("total_cities"),
            F.count_distinct("country").alias("total_countries"),
            F.count_distinct("climate_zone").alias("climate_zones"),
            F.sum("record_count").alias("total_records"),
            round_half_up(F.avg("avg_temperature"), 1).alias("global_avg_temp_c"),
            round_half_up(F.min("min_temperature"), 1).alias("global_min_temp"),
            round_half_up(F.max("max_temperature"), 1).alias("global_max_temp"),
            round_half_up(F.avg("comfort_score"), 1).alias("avg_comfort_score")]


def report_summary(a: DataFrame, as_of) -> DataFrame:
    return _today(a, as_of).agg(*_summary_columns())


def comfort_top5(a: DataFrame, as_of, k: int = 5) -> DataFrame:
    return (_today(a, as_of).orderBy(F.col("comfort_score").desc_nulls_last(), *_tie()).limit(k)
            .select("city", "country",
                    round_half_up("comfort_score", 1).alias("comfort"),
                    round_half_up("avg_temperature", 1).alias("avg_temp"),
                    round_half_up("avg_windspeed", 1).alias("avg_wind")))


# --------------------------------------------------------------------------- all dates at once
def daily_summary(a: DataFrame) -> DataFrame:
    """``report_summary`` of every analysis date."""
    return a.groupBy("analysis_date").agg(*_summary_columns())


def daily_climate(a: DataFrame) -> DataFrame:
    """``climate_distribution`` of every analysis date."""
    return a.groupBy("analysis_date", "climate_zone").agg(
        F.count_distinct("city").alias("city_count"), round_half_up(F.avg("avg_temperature"), 1).alias("avg_temp"),
        round_half_up(F.avg("comfort_score"), 1).alias("avg_comfort"))


def daily_ranking(a: DataFrame, k: int = 10) -> DataFrame:
    """``temp_ranking`` of every analysis date, with the place; a limit within the window keeps k rows a date and task."""
    best = Window.partitionBy("analysis_date").orderBy(F.col("avg_temperature").desc_nulls_last(), *_tie())
    top = a.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)
    return top.select("analysis_date", "place", "city", "country", round_half_up("avg_temperature", 1).alias("avg_temp_c"),
                      round_half_up(c_to_f("avg_temperature"), 1).alias("avg_temp_f"),
                      round_half_up("avg_windspeed", 1).alias("avg_wind_kmh"), "climate_zone")
