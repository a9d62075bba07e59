import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: Names that operators use inside, given to extra columns.
CLASH = ["fp", "component_id", "row", "key", "v", "kept", "_size", "_key", "size", "cut", "epochs", "norm", "found",
         "n_words", "score", "predicted", "piece", "length", "c0"]


def prose(rng: random.Random, n: int) -> str:
    syllables = "an er tion ou le re ment th ing ed st on".split()
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words)).capitalize()


def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    same = prose(rng, 40)
    texts = [None, "", " \t\n", "word", same, same, same + " x", long, long, "é ü \U0001f600 日本", "a" * 5000,
             "<|endoftext|> 1 2 3 $$$", prose(rng, 500)]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 4}" if i % 5 else None, i) for i, t in enumerate(texts)]
    return rows + [rows[4], rows[4], (None, same, None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(edge):
    from pyspark.sql import functions as F
    return edge.withColumns({c: F.lit(c) for c in CLASH})
