"""Stages that follow each other by a manifest of commits.

A stage that has written the partitions of some dates publishes one row
(stage, version, dates). It appears as one file when its write commits, whole
or not at all. The next stage reads the manifest as a stream, recomputes what
those dates touch, and publishes in turn; its checkpoint tells which commits it
has seen, so it goes on where it stopped. A commit that is published again
after a failure only repeats work that replaces its own results.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reports
from ..operators.sinks import read_back, write_table
from ..sources.tables import WEATHER_ANALYTICS
from .incremental import _run

COMMITS = "stage string, version long, dates array<date>"


def publish(spark: SparkSession, manifest: str, stage: str, version: int, dates: list[date]) -> None:
    row = spark.createDataFrame([(stage, version, sorted(dates))], COMMITS)
    row.coalesce(1).write.mode("append").parquet(manifest)


def follow(spark: SparkSession, manifest: str, stage: str, checkpoint: str,
           act: Callable[[SparkSession, list[date], int], None], available_now: bool = True):
    """Calls ``act(spark, dates, version)`` with the dates of the stage's commits that came since the last time."""
    commits = spark.readStream.schema(COMMITS).parquet(manifest).filter(F.col("stage") == stage)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        dates = batch.select(F.explode("dates").alias("d")).distinct().collect()  # calendar days
        if dates:
            act(batch.sparkSession, sorted(r.d for r in dates), batch_id)

    return _run(commits.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint), available_now)


#: Report tables by name: each takes analytics rows and gives rows per analysis date.
REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "summary": reports.daily_summary,
    "climate": reports.daily_climate,
    "ranking": reports.daily_ranking,
}


def reports_stream(spark: SparkSession, manifest: str, analytics_path: str, reports_path: str, checkpoint: str,
                   available_now: bool = True):
    """Replaces the reports of the dates that the analytics stage has committed, and publishes them as stage ``reports``."""
    def act(s: SparkSession, dates: list[date], version: int) -> None:
        analytics = read_back(s, analytics_path, WEATHER_ANALYTICS).filter(F.col("analysis_date").isin(dates))
        for name, report in REPORTS.items():
            write_table(report(analytics), f"{reports_path}/{name}", partition_by=["analysis_date"])
        publish(s, manifest, "reports", version, dates)

    return follow(spark, manifest, "analytics", checkpoint, act, available_now)
