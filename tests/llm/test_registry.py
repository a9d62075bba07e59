"""Registered queries and the pipeline on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from cumulus.llm import queries as Q
from cumulus.llm.common import stored
from cumulus.sources.tables import TEST_TABLES
from tests.conftest import SF_SMALL


def test_all_are_registered():
    import corpus_pipeline
    assert [n.split("_")[0] for n in Q.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(Q.QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(Q.ORACLE_SQL) <= set(E.oracle_sql()) and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_oracle(spark, name):
    duck = duckdb.connect()
    for t in TEST_TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    rel = duck.sql(Q.ORACLE_SQL[name])
    idx = [rel.columns.index(c) for c in cols]
    assert got == sorted((tuple(r[i] for i in idx) for r in rel.fetchall()), key=repr)


def test_pipeline_stages(spark):
    """Every stage's decisions take effect on what its predecessor kept."""
    import corpus_pipeline as P
    docs = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet"))
    columns, seen = docs.columns, [docs.count()]
    for name, stage in P.STAGES[:4]:
        docs = stored(stage(spark, docs, SF_SMALL), "test-stage")
        assert docs.columns == columns, name
        seen.append(docs.count())
    assert seen[0] > seen[1] > seen[2] >= seen[3]
    last = P.STAGES[4][1](spark, docs, SF_SMALL)
    assert last.filter("piece = 0").count() == seen[4]


def test_pipeline_keeps_clean_rows_unchanged(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet"))
    kept = P.STAGES[0][1](spark, docs, SF_SMALL)
    assert kept.subtract(docs).count() == 0
