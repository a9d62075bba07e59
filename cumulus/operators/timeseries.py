"""Time buckets and catch-up (which intervals have not been loaded yet)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_date, as_timestamp


def tumbling(df: DataFrame, ts: str, width: str, keys=(), value: str | None = None) -> DataFrame:
    """Fixed, non-overlapping, epoch-aligned windows of ``width`` per key.

    ``count(*)`` and (when ``value`` is given) ``sum(value)`` per
    (window, keys); partial aggregation before the shuffle.
    """
    w = F.window(F.col(ts), width)
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(value).alias("total_value"))
    g = df.groupBy(w.alias("w"), *keys).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, *[a for a in ["n", "total_value"] if a in g.columns])


def _keys(loaded: DataFrame, keys, expected: DataFrame | None) -> DataFrame:
    """The keys whose intervals are expected: those of a dimension, which also names keys that never loaded."""
    return (loaded if expected is None else expected).select(*keys).distinct()


def missing_intervals(loaded: DataFrame, day_col: str, start, end, keys=(),
                      expected: DataFrame | None = None) -> DataFrame:
    """Days in [start, end] with no loaded rows, per key (or overall).

    The spine is one exploded date sequence per key of ``expected`` (a
    dimension; without one, of the loaded rows); the loaded side is reduced
    to distinct (key, day) before the anti join.
    """
    have = loaded.select(*keys, F.col(day_col).alias("day")).distinct()
    days = F.explode(F.sequence(as_date(start), as_date(end))).alias("day")
    if keys:
        spine = _keys(loaded, keys, expected).select(*keys, days)
    else:
        spine = loaded.sparkSession.range(1).select(days)
    return spine.join(have, [*keys, "day"], "left_anti")


def missing_slots(loaded: DataFrame, ts_col: str, start, end, width: str, keys=(),
                  expected: DataFrame | None = None) -> DataFrame:
    """Fixed-width time slots (e.g. the half-hourly ingest runs) in
    [start, end] with no loaded rows, per key.

    Slot starts are epoch-aligned like ``tumbling``; the spine is one
    exploded timestamp sequence per key of ``expected`` (bounded by calendar x
    keys; without one, of the loaded rows), the loaded side is reduced to distinct (key, slot) first.
    """
    have = loaded.select(*keys, F.window(F.col(ts_col), width)["start"].alias("slot")).distinct()
    slots = F.explode(F.sequence(as_timestamp(start), as_timestamp(end),
                                 F.expr(f"INTERVAL {width}"))).alias("slot")
    if keys:
        spine = _keys(loaded, keys, expected).select(*keys, slots)
    else:
        spine = loaded.sparkSession.range(1).select(slots)
    return spine.join(have, [*keys, "slot"], "left_anti")
