"""People documents: explode the list, one formatted line per person."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import documents as docs

# The message template's greeting and the fallback list used
# when no valid document is available (number 12, craft / name pairs).
GREETING = "Hello! :)"
FALLBACK_NUMBER = 12
FALLBACK_PEOPLE = [
    ("ISS", "Oleg Kononenko"), ("ISS", "Nikolai Chub"), ("ISS", "Tracy Caldwell Dyson"),
    ("ISS", "Matthew Dominick"), ("ISS", "Michael Barratt"), ("ISS", "Jeanette Epps"),
    ("ISS", "Alexander Grebenkin"), ("ISS", "Butch Wilmore"), ("ISS", "Sunita Williams"),
    ("Tiangong", "Li Guangsu"), ("Tiangong", "Li Cong"), ("Tiangong", "Ye Guangfu"),
]


def parse_people(pages: DataFrame) -> DataFrame:
    """``(doc_id, part, number, people)`` for well-formed documents."""
    p = docs.parse_valid(pages, "doc", docs.PEOPLE, keep=["doc_id", "part"])
    return p.filter(F.col("people").isNotNull()).select("doc_id", "part", "number", "people")


def fallback(spark: SparkSession) -> DataFrame:
    people = [{"craft": c, "name": n} for c, n in FALLBACK_PEOPLE]
    return spark.createDataFrame(
        [(0, 0, FALLBACK_NUMBER, people)],
        "doc_id bigint, part bigint, number bigint, people array<struct<craft:string,name:string>>")


def with_fallback(spark: SparkSession, parsed: DataFrame) -> DataFrame:
    """The parsed documents, or the fallback list when there are none.

    Whether there are any is a scalar subquery over one row at most, so
    nothing runs before the query does.
    """
    found = parsed.limit(1).select(F.count(F.lit(1)).alias("n")).scalar()
    return parsed.unionByName(fallback(spark).filter(found == 0))


def people_messages(parsed: DataFrame, greeting: str = GREETING) -> DataFrame:
    """One row per person: ``{name} is currently in space flying on the {craft}! {greeting}``."""
    e = parsed.select("doc_id", "part", F.posexplode("people").alias("pos", "p"))
    msg = F.format_string("%s is currently in space flying on the %s! %s",
                          F.col("p.name"), F.col("p.craft"), F.lit(greeting))
    return e.select("doc_id", "part", "pos", F.col("p.craft").alias("craft"),
                    F.col("p.name").alias("name"), msg.alias("message"))


def people_count(parsed: DataFrame) -> DataFrame:
    """Per document: declared ``number`` beside the length of the ``people`` list, all parts together."""
    per_doc = parsed.groupBy("doc_id").agg(F.max("number").alias("number"),
                                           F.sum(F.size("people").cast("bigint")).alias("listed"))
    return per_doc.withColumn("consistent", F.col("number") == F.col("listed"))
