"""Sources and sinks: files (batch + incremental ingest), wire framing."""
