"""tessera: data jobs re-expressed as Spark DataFrame operators.

Sub-packages:
  sources    readers and writers (text, CSV, typed CSV, Parquet, binary files)
  functions  Column -> Column helpers (scalar semantics, geohash, version parsers)
  operators  DataFrame -> DataFrame building blocks (joins, aggregates, prefix sums,
             tabular coding, metrics, blending, boosted trees, create-only copy)
  plans      complete jobs and the registered queries over the driver tables
  streaming  Structured Streaming forms of the incremental jobs
"""

from tessera.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
