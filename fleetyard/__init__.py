"""fleetyard — Spark-native reports for fleet maintenance, purchasing and yard data.

Layout:
  functions/  column-level helpers (ids, dates, label waterfalls)
  operators/  reusable DataFrame operators (latest row per key, text lookup,
              status roll-up, key-set restriction, two-level roll-ups)
  sources/    table sources (Parquet / JDBC), test-data adapters, delivery sinks
  plans/      the report pipelines and data-quality checks
  streaming/  incremental (Structured Streaming) form of the yard state
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]
