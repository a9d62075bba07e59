"""Tables stored in buckets of their join or grouping key.

A bucketed table is shuffled once, when it is written. Joins and groupings on
the bucket key then read it without an exchange. Each table lies under a path
of the caller's (the shared folder), and is known to the session's catalogue
under a generated name until ``forget`` drops that name; the files stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def new_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:12]}"


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as the session has shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_bucketed(df: DataFrame, name: str, path: str, keys, buckets: int, partition_by=(), sort: bool = False,
                   dealt: bool = False, mode: str = "append") -> None:
    """Writes ``df`` in ``buckets`` buckets of ``keys`` (sorted by them in each file if ``sort``).

    Rows are dealt by the bucket key first, so that a bucket is one file of a
    write and not one per task; ``dealt`` says that they already are.
    """
    out = df if dealt else df.repartition(buckets, *keys)
    w = out.write.format("parquet").mode(mode).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(name)


def forget(spark: SparkSession, name: str) -> None:
    """The catalogue forgets the table; its files stay where they are, also for frames that read it already, but for
    partitioned tables, whose partitions the catalogue lists."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
