"""medistar: a Spark-native sales-and-inventory star schema.

Layers:
  sources/    raw readers (parquet/jdbc/csv), calendar generator, driver-table adapter
  functions/  column-expression helpers (safe casts, waterfall, bands, lookups, fixed values)
  operators/  dimension / fact conforming, key resolution, upserts, uploads
  plans/      star build, query library, monitoring, data-quality suite
  streaming/  incremental upload ingestion with Structured Streaming
"""

from medistar.params import Params

__all__ = ["Params"]
