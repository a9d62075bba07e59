"""cumulus — Spark-native analytics pipelines.

Retail sales summaries, weather ingestion / analytics / reporting and
query-usage attribution, each written as plain DataFrame-to-DataFrame
functions over Spark's own joins, aggregates, windows and streams.

Layout:
  sources/    table readers, JSON documents, test-data mappings
  functions/  column expressions (CASE classes, conversions, masks)
  operators/  the pipelines themselves (sales, weather, reports, usage, ...)
  plans/      the named query registry used by ``__spark_entry__`` and bench
  streaming/  incremental (Structured Streaming) variants
"""

__version__ = "0.1.0"
