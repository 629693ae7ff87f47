"""pitchstar: league-results analytics as plain Spark DataFrame jobs.

Layers:
  sources/    raw tables in and out (CSV/Parquet/catalog), driver fixtures
  functions/  column expressions (keys, text parsing, casts)
  operators/  reusable table operators (numbering, lookups, upsert, checks,
              page extraction, top-N)
  plans/      the star-schema models, the analytic questions, publishing
  streaming/  incremental raw-batch ingest with Structured Streaming
"""

__all__ = ["session"]
