"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: White space of the contracts: space and \x09-\x0D. ``bytes.split()`` cuts on exactly these.
WORD_SQL = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage in storage that outlives any executor, and gives later
    joins a plain scan, so that adaptive execution can split skewed keys.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(folds: int, fold: int, col: str = "doc_id"):
    """crc32 of the id as text, modulo ``folds``, equals ``fold`` (null id: of an empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def hashed_share(hash_value, wanted: int, total: int):
    """True for about ``wanted`` of ``total`` rows, told by a 64-bit hash: the same rows each time, without a sort."""
    if total <= wanted:
        return F.lit(True)
    return hash_value < F.lit((1 << 64) * wanted // total - (1 << 63))
