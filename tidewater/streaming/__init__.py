"""Structured Streaming jobs: the telemetry functions on streams, file-source
staging for replay/tests, parquet/keyed-upsert/dead-letter/archive sinks."""
