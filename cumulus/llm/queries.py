"""The operators bound to the test tables: one query per operator.

Each query reads its whole table, applies its operator with production
parameters and derives the contract's columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, html_main, language_id, license_scan, mixing, packing, quality_classifier, quality_rules, quotation, rp_forest, simhash, toxicity, whitening
from .common import held_out, read


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(read(spark, sf_dir, "documents"), ["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "distance")


def op2_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.link(read(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan(read(spark, sf_dir, "documents")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), usable=~held_out(4, 2))
    return (toxicity.score(docs, model)
            .select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted"))


def op7_quotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation.linked(read(spark, sf_dir, "conversations"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    vectors = quality_classifier.scaled(quality_classifier.contexts(docs))
    net = quality_classifier.train(docs, read(spark, sf_dir, "labels"), vectors, usable=~held_out(5, 0))
    return (quality_classifier.score(docs, vectors, net)
            .select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted"))


def op9_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return html_main.main_text(pages, html_main.learn(pages))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), k=3, bits=2)
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language_id.train(docs, usable=~held_out(4, 2))
    return language_id.predict(docs, model, ["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), held_out(4, 2, "row.doc_id").alias("held_out"), "lang_pred", "score")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"), ["vec_id"]).select(
        F.col("row.vec_id").alias("vec_id"), "component", "n", "deviation", "whitened", "explained", "identity_error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_rp_forest": op2_rp_forest,
    "op3_mixing": op3_mixing,
    "op4_packing": op4_packing,
    "op5_license_scan": op5_license_scan,
    "op6_toxicity": op6_toxicity,
    "op7_quotation": op7_quotation,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_html_main": op9_html_main,
    "op10_simhash": op10_simhash,
    "op11_collocations": op11_collocations,
    "op12_language_id": op12_language_id,
    "op13_whitening": op13_whitening,
}
ORACLE_SQL: dict[str, str] = {
    "op2_rp_forest": rp_forest.ORACLE,
    "op3_mixing": mixing.ORACLE,
    "op7_quotation": quotation.ORACLE,
    "op11_collocations": collocations.ORACLE,
}
