"""JSON document sources with explicit schemas.

Documents arrive as JSON text (files read with ``spark.read.text`` /
``spark.read.json``, or a string column). Parsing is ``from_json`` in
PERMISSIVE mode with a corrupt-record column, so a malformed document is
a row we can see and drop — never a failed job and never a Python loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

#: A JSON object as its keys and the text of their values: a missing key and
#: a null differ, and a value of another type than expected loses nothing.
OBJECT = T.MapType(T.StringType(), T.StringType())

EXTERNAL_QUERIES = T.StructType([
    T.StructField("externalQueries", T.ArrayType(T.StructType([
        T.StructField("queryId", T.StringType()),
        T.StructField("assetId", T.StringType()),
        T.StructField("deploymentId", T.StringType()),
        T.StructField("runId", T.StringType()),
        T.StructField("dagId", T.StringType()),
        T.StructField("taskId", T.StringType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("queryTime", T.StringType()),  # ISO-8601; cast after parsing
    ]))),
    T.StructField(CORRUPT, T.StringType()),
])

PEOPLE = T.StructType([
    T.StructField("number", T.LongType()),
    T.StructField("people", T.ArrayType(T.StructType([
        T.StructField("craft", T.StringType()),
        T.StructField("name", T.StringType()),
    ]))),
    T.StructField(CORRUPT, T.StringType()),
])

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def parse(doc: Column | str, schema: T.StructType) -> Column:
    """Parse a JSON text column; malformed text sets ``_corrupt_record``."""
    c = F.col(doc) if isinstance(doc, str) else doc
    return F.from_json(c, schema, _OPTS)


def parse_valid(df: DataFrame, doc: str, schema: T.StructType, keep=()) -> DataFrame:
    """``keep`` columns + the schema's top-level fields, well-formed documents only.

    The parse runs inside a generator (``inline`` of a one-element array), so
    it is evaluated exactly once per document: a filter on the parsed value
    cannot be pushed below it and re-run the parser, and every later
    projection reads the generator's output columns.
    """
    parsed = df.filter(F.col(doc).isNotNull()).select(*keep, F.inline(F.array(parse(doc, schema))))
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def parse_objects(df: DataFrame, doc: str, keep=()) -> DataFrame:
    """``keep`` columns + ``fields``, the document as an ``OBJECT``; documents that are none are dropped."""
    parsed = df.filter(F.col(doc).isNotNull()).select(
        *keep, F.explode(F.array(F.from_json(F.col(doc), OBJECT, _OPTS))).alias("fields"))
    return parsed.filter(F.col("fields").isNotNull())


def parse_variant(df: DataFrame, doc: str, keep=()) -> DataFrame:
    """``keep`` columns + ``v``, the document as a Variant, NULL if it is malformed. Parsed once, whatever is read of it."""
    return df.select(*keep, F.explode(F.array(F.try_parse_json(F.col(doc)))).alias("v"))


def is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def land(df: DataFrame, path: str) -> None:
    """Documents with their columns as JSON lines, as a landing folder holds them."""
    df.write.mode("overwrite").option("timestampNTZFormat", MICROS).json(path)


def read_landed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents of a landing folder."""
    return spark.read.schema(schema).option("timestampNTZFormat", MICROS).json(path)
