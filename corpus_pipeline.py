"""Corpus pipeline: toxicity, quality rules, SimHash near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet in the shared checkpoint folder and rereads it as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cumulus.llm import mixing, packing, quality_rules, simhash, toxicity
from cumulus.llm.common import held_out, read, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), usable=~held_out(4, 2))
    return toxicity.keep_clean(docs, model)


def drop_outliers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and lie within their group's MCD ellipsoid."""
    return quality_rules.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (three-word shingles, two bits)."""
    return simhash.keep_one(docs, k=3, bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents placed in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_outliers),
    ("simhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained and iterated stages have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
