"""Table access and declared schemas.

Tables are Parquet; reading through ``spark.read.parquet`` keeps predicate
pushdown, column pruning and partition pruning in Catalyst's hands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test-data table: ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
TS_NTZ, DATE = T.TimestampNTZType(), T.DateType()

# The ten columns a reading carries before derivation.
WEATHER_READING = _schema(
    ("city", S), ("country", S), ("latitude", D), ("longitude", D), ("temperature", D),
    ("windspeed", D), ("winddirection", D), ("weathercode", I), ("timestamp", TS_NTZ),
    ("ingestion_date", DATE))

# Declared raw table: readings + load stamp + four derived measures.
WEATHER_RAW = _schema(*[(f.name, f.dataType) for f in WEATHER_READING.fields],
                      ("load_timestamp", TS_NTZ), ("temp_fahrenheit", D), ("temp_kelvin", D),
                      ("wind_category", S), ("comfort_index", D))

WEATHER_ANALYTICS = _schema(
    ("analysis_date", DATE), ("city", S), ("country", S), ("latitude", D), ("longitude", D),
    ("avg_temperature", D), ("min_temperature", D), ("max_temperature", D),
    ("temperature_variance", D), ("avg_windspeed", D), ("max_windspeed", D),
    ("comfort_score", D), ("climate_zone", S), ("record_count", L),
    ("processing_timestamp", TS_NTZ))

WEATHER_HISTORICAL = _schema(*[(f.name, f.dataType) for f in WEATHER_ANALYTICS.fields],
                             ("dag_run_id", S))

# Declared column defaults (``DEFAULT CURRENT_TIMESTAMP()``): a write whose
# input omits the column fills it with the load time, as an INSERT with an
# explicit column list does.
COLUMN_DEFAULTS = {
    "load_timestamp": "localtimestamp()",
    "processing_timestamp": "localtimestamp()",
}

METRICS = _schema(
    ("category", S), ("type", S), ("value", D), ("assetId", S), ("deploymentId", S),
    ("runId", S), ("dagId", S), ("taskId", S), ("namespace", S), ("timestamp", S))

USAGE_MEASURES = ("rows_produced", "rows_inserted", "rows_updated", "rows_deleted",
                  "rows_unloaded", "total_elapsed_time", "bytes_scanned")
