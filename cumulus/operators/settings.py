"""Configuration values shown to operators: masked secrets, defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import default_missing, mask_secret


def mask_column(df: DataFrame, col: str, out: str = "masked") -> DataFrame:
    return df.withColumn(out, mask_secret(col))


def default_column(df: DataFrame, col: str, out: str = "shown") -> DataFrame:
    return df.withColumn(out, default_missing(F.col(col)))
