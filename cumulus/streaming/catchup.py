"""Catch-up: a ledger of runs, and the running of what is missing.

The ledger is an append-only table of marks (day, state, run_id, at). A day is
done once it has a success. Days that are not done and that no other run has
claimed lately are put together into ranges (gaps and islands over the
calendar) and run range by range, each claimed before and marked after. A run
that fails leaves its claims; the same run started again, or another one after
the lease, takes up exactly the days without success.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_date

LEDGER = "day date, state string, run_id string, at timestamp"
CLAIMED, SUCCESS = "claimed", "success"


def mark(spark: SparkSession, ledger: str, first: date, last: date, state: str, run_id: str) -> None:
    """Appends one mark per day of [first, last], all in one file that appears when it is whole."""
    days = spark.range(1).select(F.explode(F.sequence(as_date(first), as_date(last))).alias("day"))
    row = days.select("day", F.lit(state).alias("state"), F.lit(run_id).alias("run_id"), F.current_timestamp().alias("at"))
    row.coalesce(1).write.mode("append").parquet(ledger)


def marks(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger; one that was never written to is empty."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def missing_ranges(spark: SparkSession, ledger: str, start, end, run_id: str, lease: str = "2 hours",
                   longest: int = 31) -> DataFrame:
    """(first, last) of the runs of days in [start, end] that are to be done, each of at most ``longest`` days.

    Days in a row differ from their rank by the same number: that names the
    island. The calendar's days, however long it is, are few.
    """
    held = marks(spark, ledger)
    other = (F.col("state") == CLAIMED) & (F.col("run_id") != run_id) & (F.col("at") > F.current_timestamp() - F.expr(f"INTERVAL {lease}"))
    taken = held.filter((F.col("state") == SUCCESS) | other).select("day").distinct()
    days = spark.range(1).select(F.explode(F.sequence(as_date(start), as_date(end))).alias("day"))
    todo = days.join(taken, "day", "left_anti")
    island = F.date_sub("day", F.row_number().over(Window.orderBy("day")))
    placed = todo.select("day", island.alias("island"))
    place = F.row_number().over(Window.partitionBy("island").orderBy("day")) - 1
    return (placed.select("day", "island", F.floor(place / longest).alias("piece")).groupBy("island", "piece")
            .agg(F.min("day").alias("first"), F.max("day").alias("last")).select("first", "last").orderBy("first"))


def catch_up(spark: SparkSession, ledger: str, start, end, run: Callable[[date, date], None], run_id: str,
             lease: str = "2 hours", longest: int = 31) -> list[tuple[date, date]]:
    """Runs ``run(first, last)`` for what is missing in [start, end]; returns the ranges done.

    ``run`` replaces the days it writes, so that a day run twice (claimed,
    written, but not marked) is the same as a day run once.
    """
    done = []
    for r in missing_ranges(spark, ledger, start, end, run_id, lease, longest).collect():
        mark(spark, ledger, r.first, r.last, CLAIMED, run_id)
        run(r.first, r.last)
        mark(spark, ledger, r.first, r.last, SUCCESS, run_id)
        done.append((r.first, r.last))
    return done


def day_list(first: date, last: date) -> list[date]:
    return [first + timedelta(days=k) for k in range((last - first).days + 1)]
