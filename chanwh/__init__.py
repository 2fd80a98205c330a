"""chanwh — a Spark-native warehouse for chat-channel messages and image detections.

Layers:
  sources/    file lakes, CSV, test-data adapter, coercion (S1-S4, S9-S12)
  functions/  Column-expression helpers (rounding, keys, calendar, patterns)
  operators/  loads, enrichment, channel rules, quality checks, profiles
  plans/      star-schema models (M1-M6), reports (N1-N4), pipeline (N5)
  streaming/  incremental lake ingest (S14)

Everything is DataFrame / Spark SQL; there are no Python UDFs.
"""

__all__ = ["session"]
