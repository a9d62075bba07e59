"""Equi-joins that stay balanced when one key holds a large share of rows.

Adaptive execution splits skewed partitions of a sort-merge join only when
both inputs are plain shuffles. When the small side is an aggregate (one row
per key, as for deduplicated run metadata) that rule does not apply, so the
join is salted: at any size, for every key, without looking at the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 8  # a key's rows go to this many tasks; the small side is repeated as often


def salted_join(big: DataFrame, small_unique: DataFrame, key: str, how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """``big`` joined to ``small_unique`` (at most one row per ``key``) on ``key``.

    ``how`` is "inner", "left" or "left_semi". A row's salt is a hash of its
    other columns; the small side carries every salt. Spark still broadcasts
    the small side when its size is under the threshold.
    """
    others = [F.col(c) for c in big.columns if c != key]
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*others) if others else F.lit(0), F.lit(salts)).cast("int"))
    right = small_unique.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"], how).drop("_salt")
