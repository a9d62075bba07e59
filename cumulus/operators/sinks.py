"""Table writes: declared schemas, idempotent partition overwrite, publish.

Writes use dynamic partition overwrite: a rerun replaces exactly the
partitions it produces and leaves every other partition untouched, so a
retried task or a rerun of the same run id never duplicates rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import COLUMN_DEFAULTS

OPEN_BATCHES = 16  # files that a task which publishes keeps open
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: Published files: an open one holds its row group in memory, so row groups are smaller than Parquet's 128 MB.
_PUBLISHED = {"compression": "zstd", "parquet.block.size": str(32 << 20)}


def conform(df: DataFrame, schema: T.StructType, defaults: dict[str, str] | None = None) -> DataFrame:
    """Select the declared columns by name, in declared order, cast to declared types.

    A column the input lacks takes its declared default (``COLUMN_DEFAULTS``,
    e.g. the load time) or else NULL of the declared type — an INSERT with
    an explicit column list. Reordering by name first makes a positional
    insert safe.
    """
    defaults = COLUMN_DEFAULTS if defaults is None else defaults
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            c = F.col(f.name)
        elif f.name in defaults:
            c = F.expr(defaults[f.name])
        else:
            c = F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, schema: T.StructType | None = None,
                partition_by: list[str] | tuple[str, ...] = (), mode: str = "overwrite",
                rebalance: bool = True, replace_all: bool = False, options: dict[str, str] | None = None) -> None:
    """Write Parquet; with ``partition_by`` an overwrite only replaces the
    partitions present in ``df`` — unless ``replace_all`` (create-or-replace:
    the whole table is replaced, partitions absent from ``df`` included).

    Partitioned writes are rebalanced on the partition columns first (AQE
    ``REBALANCE``): rows of one partition value go to few tasks, so each
    output partition gets a few large files instead of one small file per
    task, and a value holding a large share of rows is split across tasks
    rather than landing in one.
    """
    out = conform(df, schema) if schema is not None else df
    if partition_by and rebalance:
        out = out.hint("rebalance", *partition_by)
    w = out.write.mode(mode).options(**(options or {}))
    w = w.option("partitionOverwriteMode", "static" if replace_all else "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_back(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a written table; with ``schema`` the columns come back typed and in order."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


@contextmanager
def _open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Meanwhile a task that writes several partition values keeps up to ``most`` files open and doesn't sort its rows
    by them; those of further values are sorted."""
    before = spark.conf.get(_OPEN_FILES, None)
    spark.conf.set(_OPEN_FILES, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_OPEN_FILES)
        else:
            spark.conf.set(_OPEN_FILES, before)


def _write_batches(df: DataFrame, path: str, partition_by: list[str], schema: T.StructType | None) -> None:
    """Every task writes its rows of each batch as they come: they are neither dealt anew nor sorted.

    A metric row repeats its run's metadata, so the rows are several times as
    large as what they were made of; a shuffle of them would need more disk than all
    others and the table together. A batch gets one file from each task that has rows of it.
    """
    with _open_files(df.sparkSession, OPEN_BATCHES):
        write_table(df, path, schema, partition_by=partition_by, rebalance=False, options=_PUBLISHED)


def publish(df: DataFrame, path: str, partition_by=("category", "type"), schema: T.StructType | None = None) -> bool:
    """Publish metric rows partitioned by batch (category, type).

    No emptiness probe runs before the write (that would evaluate the plan
    twice): an empty id set already collapses the joins to an empty relation
    at runtime (AQE), and an empty write leaves no data files. Whether
    anything was published is read back from the written table, which
    touches at most one row group.
    """
    _write_batches(df, path, list(partition_by), schema)
    return not read_back(df.sparkSession, path, schema or df.schema).isEmpty()


def publish_counted(df: DataFrame, path: str, batches: list[tuple[str, str]], schema: T.StructType | None = None) -> DataFrame:
    """Publishes like ``publish`` and returns the rows of each (category, type) batch, counted by the write itself.

    The counts are observed on the rows as they pass to the writer, so the
    published table isn't read again; a batch without rows has none. ``batches``
    names those that can occur: one counter each.
    """
    seen = Observation("published")
    is_batch = [(F.col("category") == c) & (F.col("type") == t) for c, t in batches]
    counted = df.observe(seen, *[F.count_if(b).alias(f"n{i}") for i, b in enumerate(is_batch)])
    _write_batches(counted, path, ["category", "type"], schema)
    n = seen.get
    rows = [(*b, n[f"n{i}"]) for i, b in enumerate(batches) if n[f"n{i}"]]
    return df.sparkSession.createDataFrame(rows, "category string, type string, n long")


def create_table(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_by=(),
                 defaults: dict[str, str] | None = None) -> None:
    """A catalogue table at ``path`` with the declared columns and DEFAULTs (``COLUMN_DEFAULTS``)."""
    defaults = COLUMN_DEFAULTS if defaults is None else defaults
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {defaults[f.name]}" if f.name in defaults else "")
                        for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {parts} LOCATION '{path}'")


def insert_columns(df: DataFrame, name: str) -> None:
    """INSERT with the list of the columns that ``df`` has: the table's others take their DEFAULT, else NULL.

    Values are stored under the strict assignment of ANSI: one that doesn't
    fit the column's type fails the insert.
    """
    df.sparkSession.sql(f"INSERT INTO {name} ({', '.join(f'`{c}`' for c in df.columns)}) SELECT * FROM {{rows}}", rows=df)


def insert_by_position(df: DataFrame, name: str) -> None:
    """INSERT without a column list: the n-th column of ``df`` goes into the table's n-th, whatever their names."""
    df.sparkSession.sql(f"INSERT INTO {name} SELECT * FROM {{rows}}", rows=df)
